"""Spelling variants against plain comparison of all words, and against SQL."""

import random
import re
import zlib
from collections import Counter

import pytest

from barsmith.llm import oracles, variants

from ..compare import connect, differences

SCHEMA = "doc_id long, text string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    form, beside = {}, {}
    for w, n in counts.items():
        beside[w] = [x for x in counts if near(w, x)]
        best = min(beside[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(beside[w]), counts.get(form[w])))
    return out


def odd_rows():
    chain = "abcdefg " * 6000 + "abcdefx " * 450 + "abcdxfx " * 30 + "abddxfx abddxfx "
    walk = random.Random(3)
    repeats = " ".join("".join(walk.choice("aab") for _ in range(walk.randint(6, 10))) for _ in range(3000))
    return [
        (1, None), (2, ""), (3, chain), (None, "Straßen Éclairs éclairs ÉCLAIRS éclairs"), (None, "Straßen Éclairs éclairs ÉCLAIRS éclairs"),
        (4, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa aaaaaaaaa aaaaaaaaa baaaaaaa baaaaaaa"), (5, repeats),
        (9007199254740993, "wonderful " * 40 + "wonderfull wonderfull wonder-ful x\U0001f600wonderful"), (6, "k" * 50_000 + " " + "k" * 50_000),
    ]


def test_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as n", "'x' as word", "'y' as run").repartition(3)
    got = variants.group_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == plain(rows)
    by_word = {r[0]: r for r in found}
    assert by_word["abddxfx"][2] == "abcdefg" and by_word["abddxfx"][1] == "abcdxfx"
    assert variants.group_variants(df.limit(0)).count() == 0


def test_odd_rows_by_sql(spark):
    rows = [r for r in odd_rows() if len(r[1] or "") < 100_000]
    con = connect("/root/testdata/sf0.001")
    con.execute("CREATE TABLE odd (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO odd VALUES (?, ?)", rows)
    assert differences(variants.group_variants(spark.createDataFrame(rows, SCHEMA)), con, oracles.spelling_variants("odd")) is None


def test_long_words(spark):
    walk = random.Random(1)
    for size in (62, 63, 64, 65, 66, 5000):
        base = "".join(walk.choice("ab") for _ in range(size))
        words = [base, base[1:], "b" + base, base + "bb", base[:9] + "c" + base[10:], base[:9] + "d" + base[10:], base[:20] + base[21:]]
        rows = [(i, f"{w} " * 30) for i, w in enumerate(words)]
        got = [tuple(r) for r in variants.group_variants(spark.createDataFrame(rows, SCHEMA)).collect()]
        assert len(got) == len(set(got)) and set(got) == plain(rows), size


@pytest.mark.parametrize("seed", range(2))
def test_dense_neighbourhoods(spark, seed):
    walk = random.Random(seed)
    words = ["".join(walk.choice("abc") for _ in range(walk.randint(7, 9))) for _ in range(150)]
    rows = [(i, " ".join(walk.choices(words, k=60))) for i in range(40)] + [(99, f"{words[0]} " * 900)]
    got = {tuple(r) for r in variants.group_variants(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain(rows)
