"""Quality rules on odd texts and tables of own rules."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from barsmith.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated(text, width=8):
    w = WORD.findall(text)
    grams = [tuple(w[i : i + width]) for i in range(len(w) - width + 1)]
    often = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(width)})


def test_counts_of_random_texts(spark):
    rng = random.Random(8)
    texts = [None, "", "\n\n", " \t", "é" * 9, "a\x00b c"]
    for _ in range(300):
        texts.append("".join(rng.choice(["a", "b", "a b a b a b a b ", " ", "\n", "#", "!!", "|", "é ", "\x0b"]) for _ in range(rng.randrange(90))))
    texts.append("word " * 30_000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("kept", F.lit("mine")).withColumn("n_words", F.lit(-1))
    for r in qr.apply_rules(df).collect():
        text = texts[r["doc_id"]] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeated(text), text[:200]
        assert r["base_failed"] == (len(words) < 20 or 100 * repeated(text) > 30 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_own_table_and_plan(spark):
    rules = (qr.Rule("word_count", "n_words", low=2), qr.Rule("repeated_windows", "repeat_ratio", high=1.0), qr.Rule("long", "mean_word_chars", low=4))
    df = spark.createDataFrame([(1, "tall trees"), (2, "a b"), (3, "x"), (3, "x")], "doc_id long, text string")
    got = [(r["doc_id"], r["kept"], r["failed_rules"]) for r in qr.apply_rules(df, rules).orderBy("doc_id").collect()]
    assert got == [(1, True, ""), (2, False, "long"), (3, False, "word_count,long"), (3, False, "word_count,long")]
    assert [r["doc_id"] for r in qr.keep_passing(df, rules).collect()] == [1]
    assert qr.apply_rules(df.limit(0)).count() == 0
    plan = qr.apply_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_working_names_that_the_table_has(spark):
    df = spark.createDataFrame([(1, "two words", "mine", 5, 6)], "doc_id long, text string, _M string, _ok int, _ok_ int")
    got = qr.apply_rules(df)
    assert got.columns[:5] == df.columns
    assert tuple(got.first())[:5] == (1, "two words", "mine", 5, 6)
    assert got.first()["n_words"] == 2
