"""Spaced-seed overlaps against all alignments, substitutions, and odd inputs."""

import itertools
import re

import pytest

from barsmith.llm import decontaminate as dc
from barsmith.llm.common import documents

SF = "/root/testdata/sf0.001"


def tokens(text):
    return re.findall(r"[^ \t\n\x0b\f\r!-/:-@\[-`{-~]+", (text or "").lower())


def plain_pairs(docs, bench):
    """Pairs with a window in which all but the allowed tokens agree: every alignment, no seeds."""
    out = set()
    for item_id, text in bench:
        b = tokens(text)
        width = min(dc.WINDOW, len(b))
        need = width - min(dc.MISSES, dc.MISSES * width // 9)
        for doc_id, doc in docs:
            a = tokens(doc)
            # A window with a match has some common token, which gives the alignment.
            where = {}
            for q, x in enumerate(a):
                where.setdefault(x, []).append(q)
            for shift in {q - p for p, x in enumerate(b) for q in where.get(x, ())}:
                same = [0 <= shift + k < len(a) and a[shift + k] == b[k] for k in range(len(b))]
                if any(sum(same[s : s + width]) >= need for s in range(len(b) - width + 1)):
                    out.add((doc_id, item_id))
    return out


def pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.collect()}


def test_query_equals_all_alignments(spark):
    docs = documents(spark, SF)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = plain_pairs([tuple(r) for r in docs.collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert want and pairs(dc.find_overlaps(docs, bench)) == want
    assert pairs(dc.find_overlaps(docs, bench, block_seeds=500)) == want


def test_masks_withstand_any_two_substitutions():
    for gone in itertools.combinations(range(dc.WINDOW), 2):
        assert any(not {s + o for o in m} & set(gone) for m in dc.MASKS for s in range(dc.WINDOW - m[-1]))


@pytest.mark.parametrize("n", range(1, 13))
def test_masks_of_short_items_withstand_what_they_may_miss(n):
    shapes, gone = dc.short_masks(n), dc.allowed(n)
    assert gone == (0 if n < 5 else 1 if n < 9 else 2)
    for lost in itertools.combinations(range(n), gone):
        assert any(not {s + o for o in m} & set(lost) for m in shapes for s in range(n - m[-1]))


def test_short_items_with_every_substitution(spark):
    bench = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 13)]
    docs, want = [], set()
    for n, text in bench:
        for lost in (0, 1, 2, 3):
            for places in itertools.combinations(range(n), lost):
                words = [f"x{k}" if k in places else w for k, w in enumerate(text.split())]
                docs.append((len(docs), "before " * (len(docs) % 3) + " ".join(words) + " after" * (len(docs) % 2)))
                if lost <= dc.allowed(n):
                    want.add((docs[-1][0], n))
    got = dc.find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"))
    assert pairs(got) == want == plain_pairs(docs, bench)


def test_long_texts_and_items_and_repeated_items(spark):
    words = [f"w{i}" for i in range(6000)]
    bench = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (2, "w " * 3000)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a " * 50_000 + " ".join(words[70:90])), (2, "b " * 50_000)], "doc_id long, text string")
    got = dc.find_overlaps(docs, bench, block_seeds=5000).collect()
    assert [(r["doc_id"], r["item_id"], r["best_match"], r["first_token"]) for r in got] == [(1, 1, 13, 50_000)]
    near = dc.item_seeds(bench.select("item_id", dc.token_hashes(bench["text"]).alias("tokens")), {m: [] for m in dc.MASKS})
    assert near.selectExpr("max(size(near))").first()[0] == 2 * dc.WINDOW - 1


def test_substitutions_short_items_and_odd_rows(spark):
    words = [f"w{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "just three words"), (3, None), (4, " .. ")], "item_id long, text string")
    hit = [*words[5:18]]
    two, three = hit.copy(), hit.copy()
    two[2] = two[9] = "x"
    three[1] = three[6] = three[11] = "x"
    rows = [
        (1, "a b " + " ".join(two).upper() + ", c"), (2, "a " + " ".join(three) + " b"), (3, "well JUST, three\nwords!"), (4, "just three"),
        (5, None), (6, ""), (7, " ".join(words[:10])), (None, " ".join(hit)), (None, "harmless"), (8, " ".join(hit)), (8, " ".join(hit)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as seed", "2 as item")
    assert pairs(dc.find_overlaps(docs, bench)) == {(1, 1), (3, 2), (8, 1), (None, 1)}
    left = dc.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "4", "5", "6", "7", "None"]
    assert dc.find_overlaps(docs.limit(0), bench).count() == dc.find_overlaps(docs, bench.limit(0)).count() == 0
