"""Removal of repeated byte strings by hash-compared suffix sorting.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document with a smaller
id. The steps:

1. Texts equal to an earlier one go as a whole. Of those that a task has in one batch only the
   first goes on, so a large group of copies costs a row for each batch.
2. A text is cut into units, runs of windows with the same least gram hash (the anchor). Only
   the units' hashes are dealt out by anchor, 16 bytes for 14 bytes of text. A unit whose
   bytes an earlier document has as well is covered; one whose anchor other documents have, with
   other bytes, is undecided.
3. The bytes of undecided units, a few from each changed place, are dealt out by anchor. All
   their suffixes are sorted, with hash-found common extensions and verified on the bytes, and a
   suffix is covered if its class of equal strings has an earlier document.
4. Texts with covered bytes are put together with what covers them, and what remains is hashed.

A unit is recognised by 104 bits, 40 of its anchor's hash and 64 of its own.

Defined cases: null texts count as empty, texts shorter than ``LENGTH`` lose nothing; a row
without an id has no place in the order: it loses nothing and covers nothing; rows that repeat
an id aren't smaller than each other; an empty table gives an empty result; columns other than
the two named ones are not read. Units of one anchor meet in one task, with 16 bytes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, stash, whole_text
from .hashing import chunks
from .suffix_sort import equal_classes, units

LENGTH = 50
GRAM = 24
#: Bytes of text whose units make one bucket; the number of buckets follows the input.
BUCKET_BYTES = 8 << 20
#: Bytes of text whose units a task holds at once.
PAYLOAD_BYTES = 8 << 20

#: Ids, keys, units of each; then of every unit its start and 40 bits of its anchor, both in a low
#: and a high part of which the second compresses well, and its own hash.
UNIT_PARTS = (np.int64, np.int64, np.int64, np.uint16, np.uint16, np.uint32, np.uint8, np.uint64)
BYTE_PARTS = (np.int64, np.int64, np.uint64, np.uint32, np.uint32, np.uint8)


def pack(arrays, kinds) -> bytes:
    """Arrays as bytes, each after its length."""
    return b"".join(np.int64(len(a)).tobytes() + np.asarray(a, k).tobytes() for a, k in zip(arrays, kinds))


def unpack(payload: bytes, kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        n = int(np.frombuffer(payload, np.int64, 1, at)[0])
        out.append(np.frombuffer(payload, kind, n, at + 8))
        at += 8 + n * np.dtype(kind).itemsize
    return out


def by_bucket(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its members), members in their order."""
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(n + 1))
    for b in range(n):
        if edge[b] < edge[b + 1]:
            yield b, order[edge[b] : edge[b + 1]]


def deal_units(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, payload): the units of each document, by anchor."""

    def deal(strings: list[str], ids: np.ndarray, keys: np.ndarray) -> pd.DataFrame:
        texts = [t.encode("utf-8", "replace") for t in strings]
        parts = []
        for part in chunks(texts):
            text, start, _, anchor, unit = units(texts[part], LENGTH, GRAM)
            parts.append((text + part.start, start, anchor, unit))
        text, start, anchor, unit = (np.concatenate(x) for x in zip(*parts))
        out = []
        for b, at in by_bucket((anchor % np.uint64(buckets)).astype(np.int64), buckets):
            first = np.flatnonzero(np.concatenate([[True], text[at][1:] != text[at][:-1]]))
            count = np.diff(np.concatenate([first, [len(at)]]))
            who = text[at][first]
            s, a = start[at], anchor[at] >> np.uint64(24)
            out.append((b, pack((
                ids[who], keys[who], count, s & 0xFFFF, s >> 16, a & np.uint64(0xFFFFFFFF), a >> np.uint64(32), unit[at]), UNIT_PARTS)))
        return pd.DataFrame(out, columns=["bucket", "payload"])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.sort_values("doc_id", kind="stable")
            batch = batch[~batch.duplicated("text")]
            all_ids, all_keys = batch["doc_id"].to_numpy(np.int64), batch["key"].to_numpy(np.int64)
            for piece in chunks(batch["text"].tolist(), PAYLOAD_BYTES):
                yield deal(batch["text"].iloc[piece].tolist(), all_ids[piece], all_keys[piece])

    return docs.mapInPandas(rows, "bucket int, payload binary")


def decide_units(dealt: DataFrame) -> DataFrame:
    """(doc_id, key, start, covered) of units that are covered, or undecided (covered is false)."""

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = []
        for payload in pdf["payload"]:
            ids, keys, count, low, high, a_low, a_high, unit = unpack(payload, UNIT_PARTS)
            start = low.astype(np.int64) | high.astype(np.int64) << 16
            anchor = a_low.astype(np.uint64) | a_high.astype(np.uint64) << np.uint64(32)
            columns.append((np.repeat(ids, count), np.repeat(keys, count), start, anchor, unit))
        doc, key, start, anchor, unit = (np.concatenate(x) for x in zip(*columns))
        order = np.lexsort((doc, unit, anchor))
        d, a, u = doc[order], anchor[order], unit[order]
        new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
        new_class = new_anchor | np.concatenate([[True], u[1:] != u[:-1]])
        least = d[new_class][np.cumsum(new_class) - 1]  # sorted by id within the class
        covered = d > least
        group = np.cumsum(new_anchor) - 1
        bounds = np.flatnonzero(new_anchor)
        low, high = np.minimum.reduceat(least, bounds), np.maximum.reduceat(least, bounds)
        undecided = ~covered & (low < high)[group]
        keep = order[covered | undecided]
        return pd.DataFrame({"doc_id": doc[keep], "key": key[keep], "start": start[keep].astype(np.int64), "covered": covered[covered | undecided]})

    return dealt.groupBy("bucket").applyInPandas(decide, "doc_id long, key long, start long, covered boolean")


def deal_undecided(flagged: DataFrame, buckets: int) -> DataFrame:
    """(bucket, payload): the bytes of undecided units, by anchor."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode("utf-8", "replace") for t in batch["text"]]
            ids, keys, flags = batch["doc_id"].tolist(), batch["key"].tolist(), batch["flags"].tolist()
            found: list[list] = [[] for _ in range(buckets)]
            for part in chunks(texts):
                text, start, windows, anchor, _ = units(texts[part], LENGTH, GRAM)
                edge = np.searchsorted(text, np.arange(part.stop - part.start + 1))
                for i in range(part.start, part.stop):
                    mine = slice(edge[i - part.start], edge[i - part.start + 1])
                    wanted = np.array([s >> 1 for s in flags[i] if not s & 1], np.int64)
                    for k in mine.start + np.flatnonzero(np.isin(start[mine], wanted)):
                        s, n = int(start[k]), int(windows[k]) + LENGTH - 1
                        found[int(anchor[k] % np.uint64(buckets))].append((ids[i], keys[i], anchor[k], s, n, texts[i][s : s + n]))
            out = []
            for b, members in enumerate(found):
                if members:
                    *columns, raw = zip(*members)
                    out.append((b, pack((*columns, np.frombuffer(b"".join(raw), np.uint8)), BYTE_PARTS)))
            yield pd.DataFrame(out, columns=["bucket", "payload"])

    return flagged.mapInPandas(rows, "bucket int, payload binary")


def sort_undecided(dealt: DataFrame) -> DataFrame:
    """(doc_id, key, start, end): stretches whose every window an earlier document has."""

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = [unpack(p, BYTE_PARTS) for p in pdf["payload"]]
        doc, key, anchor, start, size, data = (np.concatenate(x) for x in zip(*columns))
        n = size.astype(np.int64) - LENGTH + 1
        record = np.repeat(np.arange(len(doc)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(np.cumsum(size.astype(np.int64)) - size, n) + offset
        order, class_ = equal_classes(data, at, anchor[record], LENGTH)
        none = pd.DataFrame({"doc_id": [], "key": [], "start": [], "end": []}).astype("int64")
        if not len(order):
            return none
        least = np.minimum.reduceat(doc[record[order]], np.flatnonzero(np.concatenate([[True], class_[1:] != class_[:-1]])))
        covered = np.zeros(len(at), bool)
        covered[order] = doc[record[order]] > least[class_]
        hit = np.flatnonzero(covered)
        if not len(hit):
            return none
        first = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(record[hit]) > 0)])
        last = np.concatenate([first[1:], [True]])
        r = record[hit[first]]
        return pd.DataFrame({
            "doc_id": doc[r], "key": key[r], "start": start[r] + offset[hit[first]],
            "end": start[r] + offset[hit[last]] + LENGTH})

    return dealt.groupBy("bucket").applyInPandas(decide, "doc_id long, key long, start long, end long")


def removal(texts: DataFrame) -> DataFrame:
    """(doc_id, key, text) and the covering unit starts and stretches to counts, digest and what is left."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = [t.encode("utf-8", "replace") for t in batch["text"]]
            flags, spans = batch["flags"].tolist(), batch["spans"].tolist()
            out = []
            for part in chunks(raw):
                text, start, windows, _, _ = units(raw[part], LENGTH, GRAM)
                edge = np.searchsorted(text, np.arange(part.stop - part.start + 1))
                for i in range(part.start, part.stop):
                    mine = slice(edge[i - part.start], edge[i - part.start + 1])
                    step = np.zeros(len(raw[i]) + 1, np.int64)
                    whole = mine.start + np.flatnonzero(np.isin(start[mine], np.array([s >> 1 for s in flags[i] if s & 1], np.int64)))
                    np.add.at(step, start[whole], 1)
                    np.add.at(step, start[whole] + windows[whole] + LENGTH - 1, -1)
                    for s in spans[i] if spans[i] is not None else ():
                        step[s["start"]] += 1
                        step[s["end"]] -= 1
                    gone = np.cumsum(step[:-1]) > 0
                    left = np.frombuffer(raw[i], np.uint8)[~gone].tobytes()
                    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    out.append((int(gone.sum()), runs, hashlib.sha256(left).hexdigest(), left))
            done = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", "kept_bytes"])
            yield pd.concat([batch[["doc_id", "key"]].reset_index(drop=True), done], axis=1)

    return texts.mapInPandas(
        rows, "doc_id long, key long, n_removed long, n_spans long, kept_sha256 string, kept_bytes binary")


def remove_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), and what is left of each text if asked for."""
    text = whole_text("text")
    key = F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("long")
    keyed = shipped(docs).select("doc_id", text.alias("text"), key.alias("key"))
    narrow = stash(keyed.select(
        "doc_id", "key", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"), F.octet_length("text").cast("long").alias("n_bytes")), "texts")
    # The whole digest tells texts apart, its start only names rows of one id.
    earliest = stash(narrow.filter(F.col("doc_id").isNotNull()).groupBy("sha").agg(
        F.min("doc_id").alias("first"), F.min("n_bytes").alias("bytes")), "first-texts")
    total = earliest.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    repeated = narrow.filter(F.col("n_bytes") >= LENGTH).join(earliest.select("sha", "first"), "sha").filter(
        F.col("doc_id") > F.col("first")).select("doc_id", "key").distinct()
    dealt = deal_units(keyed.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH)), buckets)
    decided = stash(decide_units(dealt), "unit-flags")
    # Texts that go as a whole need no unit of theirs.
    flags = decided.join(repeated, ["doc_id", "key"], "left_anti").groupBy("doc_id", "key").agg(F.collect_list(
        F.col("start") * 2 + F.col("covered").cast("long")).alias("flags"))
    flagged = stash(keyed.join(flags, ["doc_id", "key"]), "flagged-texts")
    stretches = stash(sort_undecided(deal_undecided(flagged, buckets)), "stretches").groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", "end")).alias("spans"))
    cut = removal(flagged.join(stretches, ["doc_id", "key"], "left"))
    if not keep_bytes:
        cut = cut.drop("kept_bytes")

    # Repeated rows give equal lines; one of them is joined with every row.
    cut = cut.dropDuplicates(["doc_id", "key"])
    rows = narrow.join(cut, ["doc_id", "key"], "left").join(repeated.withColumn("again", F.lit(True)), ["doc_id", "key"], "left")
    again = F.col("again").isNotNull()
    out = rows.select(
        "doc_id", "n_bytes",
        F.when(again, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(again, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(again, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *([F.when(again, F.lit(b"")).otherwise(F.col("kept_bytes")).alias("kept_bytes")] if keep_bytes else []))
    return out
