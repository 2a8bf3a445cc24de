"""Pairwise ranking: held-out accuracy, its parts, and odd inputs."""

import numpy as np

from barsmith.llm import ranking
from barsmith.llm.common import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_clean_documents(spark):
    docs, labels = documents(spark, SF), spark.read.parquet(f"{SF}/labels.parquet")
    rows = ranking.classify(docs, ranking.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert 40 < len(held) < len(rows) / 3
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.97
    assert np.mean([r["predicted"] for r in held if r["quality"] == 1]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_pairs_recover_an_order():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    good = x @ np.array([2.0, -1.0, 0.0]) + rng.normal(size=600) * 0.1 > 0.3
    w = ranking.fit_pairs(x, good)
    assert w[0] > 0 > w[1] and abs(w[2]) < 0.2 * w[0]
    cut = ranking.quantile_cut(x @ w, good)
    assert np.mean((x @ w >= cut) == good) > 0.95


def test_cut_keeps_ties_together_and_one_sided_labels():
    s, good = np.array([1.0, 1.0, 1.0, 2.0]), np.array([False, True, False, True])
    assert ranking.quantile_cut(s, good) == 1.5
    assert ranking.quantile_cut(s, np.array([True] * 4)) < 1
    assert (ranking.fit_pairs(np.ones((2, 3)), np.array([True, True])) == 0).all()


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 5), (2, "a b", 5), (2, "a b", 5), (3, "x " * 50_000, 5)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    got = ranking.classify(docs, ranking.fit(docs, labels)).collect()
    assert len(got) == 5 and {r["doc_id"]: r["held_out"] for r in got}[None] is False
    assert len({r["score"] for r in got if r["doc_id"] == 2}) == 1
    untrained = ranking.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in ranking.classify(docs, untrained).collect()} == {1}
    assert ranking.classify(docs.limit(0), untrained).count() == 0
