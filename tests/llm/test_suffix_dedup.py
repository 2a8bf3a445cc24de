"""Repeated byte strings against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from barsmith.llm import suffix_dedup
from barsmith.llm.common import documents
from barsmith.llm.suffix_sort import Suffixes, equal_classes, units, window_minima

SF = "/root/testdata/sf0.001"
N = suffix_dedup.LENGTH


def plain(docs):
    first = {}
    for doc_id, text in docs:
        raw = (text or "").encode()
        if doc_id is not None:
            for i in range(len(raw) - N + 1):
                w = raw[i : i + N]
                first[w] = min(doc_id, first.get(w, doc_id))
    out = []
    for doc_id, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        if doc_id is not None:
            for i in range(len(raw) - N + 1):
                if first[raw[i : i + N]] < doc_id:
                    gone[i : i + N] = True
        left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc_id, len(raw), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_a_dictionary_of_windows(spark):
    docs = documents(spark, SF)
    assert rows(suffix_dedup.remove_repeats(docs)) == plain([tuple(r) for r in docs.collect()])


@pytest.mark.parametrize("bucket_bytes", [3000, 1 << 20])
def test_patchwork_of_shared_strings(spark, bucket_bytes):
    rng = random.Random(7)
    pieces = ["".join(rng.choice("ab é") for _ in range(rng.choice([5, 30, 49, 50, 51, 80, 200]))) for _ in range(25)]
    docs = [(rng.randrange(40), "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 6)))) for _ in range(60)]
    docs += [(3, "ab" * 400), (9, "ab" * 300), (1, "x" * 1000), (2, "x" * 60), (50, None), (51, ""), (None, "x" * 80), (None, "x" * 80)]
    docs += [(60, docs[0][1]), (60, docs[0][1]), (61, "y" * N), (62, "y" * N), (63, "y" * (N - 1)), (64, "z" + "y" * N)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as key", "2 as flags")
    assert rows(suffix_dedup.remove_repeats(df, bucket_bytes)) == plain(docs)


def test_empty_table_and_remaining_bytes(spark):
    df = spark.createDataFrame([(1, "k" * 70), (2, "q" * 30 + "k" * 60 + "r")], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    got = {r["doc_id"]: r["kept_bytes"] for r in suffix_dedup.remove_repeats(df, keep_bytes=True).collect()}
    assert bytes(got[2]) == b"q" * 30 + b"r"


def test_suffix_order_and_classes():
    rng = random.Random(3)
    data = np.frombuffer(bytes(rng.choice(b"ab") for _ in range(900)), np.uint8)
    starts = np.arange(850)
    group = np.sort(np.array([rng.randrange(4) for _ in starts]))
    raw = data.tobytes()
    order = Suffixes(data, starts, 50).order(group)
    assert order.tolist() == sorted(range(850), key=lambda i: (group[i], raw[i : i + 50], i))
    order, class_ = equal_classes(data, starts, group, 12)
    key = [(group[i], raw[i : i + 12]) for i in starts]
    assert sorted(order) == [i for i in starts if key.count(key[i]) > 1]
    keys = [key[i] for i in order]
    assert keys == sorted(keys) and len(set(keys)) == class_[-1] + 1
    assert all((a == b) == (x == y) for a, b, x, y in zip(keys, keys[1:], class_, class_[1:]))
    assert window_minima(np.array([3, 1, 2, 5, 4]), 3).tolist() == [1, 1, 2]


def test_units_cover_every_window_once():
    texts = [b"", b"short", b"abc" * 60, bytes(range(256)) * 3]
    text, start, windows, anchor, unit = units(texts, 50, 18)
    for i, t in enumerate(texts):
        covered = [s for a, b, n in zip(text, start, windows) if a == i for s in range(b, b + n)]
        assert covered == list(range(max(0, len(t) - 49)))
