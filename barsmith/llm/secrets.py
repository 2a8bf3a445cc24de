"""Secret scans with formats learned by grammar inference.

Three fixed patterns label credentials. The labelled values of each kind, a bounded sample of
distinct ones taken in the order of a hash, are the strings from which a probabilistic automaton
is inferred by merging compatible prefix-tree states. Every other run of credential characters
as long as the shortest credential, or what spans leave of it, is then scored: it is added where
the automaton and the spread of the sample's lengths find it about as likely as the sample, and far
likelier than ordinary runs. No length is ruled out. How likely a run is as an ordinary one comes from all distinct runs.

Texts are scanned for labels, then for the counts of ordinary runs, then for spans; only labelled values, distinct runs and counts are shuffled.

Defined cases: null and empty texts have no spans; equal texts get equal spans, repeated rows
stay; rows without an id are scanned like others; kinds without a labelled value add nothing; an
empty table gives an empty result; other columns are not read. Places count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shipped, stash
from .grammar import Format, Pairs

KINDS = ("assign", "access", "hex")
# The patterns and their least lengths (fixed values).
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Least length of runs that are scored and counted as ordinary ones: that of the shortest credential.
RUN_LEAST = min(ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST)
#: Labelled strings an automaton is learned from at most, by kind, and their characters in all.
SAMPLE, SAMPLE_CHARS = 400, 4_000_000
#: Longest run whose decision a task remembers.
REMEMBERED = 256
#: Bits a symbol by which a credential must be likelier than ordinary words.
MARGIN = 1.0

_CHARS = np.zeros(256, bool)
_CHARS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True


def base_spans(text: str, runs: list[tuple[int, int]]) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the fixed patterns; ``runs`` as from ``long_runs``."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end(), m.group(1)) for m in ASSIGN.finditer(text) if len(m.group(1)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= ACCESS_LEAST]
    for a, b in runs:  # a long run of hex digits is part of a long run
        if b - a >= HEX_LEAST:
            out += [("hex", a + m.start(), a + m.end(), m.group()) for m in HEX.finditer(text[a:b]) if len(m.group()) >= HEX_LEAST]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def long_runs(texts: list[str], least: int = RUN_LEAST) -> list[list[tuple[int, int]]]:
    """For each text the places of its maximal long runs of credential characters."""
    out = []
    for text in texts:
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        ok = np.concatenate([[False], _CHARS[raw], [False]])
        edge = np.flatnonzero(ok[1:] != ok[:-1])
        start, end = edge[::2], edge[1::2]
        long = end - start >= least
        start, end = start[long], end[long]
        if len(raw) != len(text):  # from bytes to code points: those that don't continue one
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            start, end = points[start], points[end]
        places = list(zip(start.tolist(), end.tolist()))
        out.append(places)
    return out


def free_runs(places: list[tuple[int, int]], spans: list[tuple], least: int) -> list[tuple[int, int]]:
    """What spans (kind, start, end, ...) leave of the runs, in stretches of ``least`` at least."""
    if not spans:
        return [p for p in places if p[1] - p[0] >= least]
    cuts: list[list[int]] = []
    for a, b in sorted((s[1], s[2]) for s in spans):
        if cuts and a <= cuts[-1][1]:
            cuts[-1][1] = max(b, cuts[-1][1])
        else:
            cuts.append([a, b])
    out, i = [], 0
    for a, b in places:
        while i < len(cuts) and cuts[i][1] <= a:
            i += 1
        k = i
        while k < len(cuts) and cuts[k][0] < b:
            if cuts[k][0] - a >= least:
                out.append((a, cuts[k][0]))
            a = max(a, cuts[k][1])
            k += 1
        if b - a >= least:
            out.append((a, b))
    return out


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _batch(names: list[str], rows: list[tuple], types: list) -> pa.RecordBatch:
    """Rows as a batch, whose columns have their types also where there is no row."""
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def labelled_values(docs: DataFrame) -> DataFrame:
    """(kind, value): the distinct values that the fixed patterns find."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(0))
            found = {(s[0], s[3]) for text, places in zip(texts, long_runs(texts, HEX_LEAST)) for s in base_spans(text, places)}
            yield _batch(["kind", "value"], sorted(found), [pa.string()] * 2)

    return shipped(docs).select("text").mapInArrow(rows, "kind string, value string").distinct()


def sample_values(values: DataFrame, limit: int = SAMPLE, chars: int = SAMPLE_CHARS) -> dict[str, list[str]]:
    """Values by kind in the order of their hash, at most ``limit`` of each and ``chars`` characters."""
    hashed = values.withColumn("h", F.xxhash64("value"))
    out: dict[str, list[str]] = {}
    for kind in KINDS:
        of = hashed.filter(F.col("kind") == kind)
        fits, total = [], 0
        for r in of.select("h", F.length("value").alias("n")).orderBy("h", "n").limit(limit).collect():
            if total + r["n"] <= chars:
                total += r["n"]
                fits.append(r["h"])
        if fits:
            out[kind] = [r["value"] for r in of.filter(F.col("h").isin(fits)).orderBy("h", "value").select("value").collect()]
    return out


def count_pairs(docs: DataFrame, least: int) -> dict[str, int]:
    """In how many places each pair of symbols stands in all distinct runs outside of labelled spans.

    A blank stands for a run's start and end. Each task adds up its runs, so as many rows as there
    are pairs of symbols reach the driver.
    """
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _texts(batch.column(0))
            found = set()
            for text, places in zip(texts, long_runs(texts, least)):
                found.update(text[a:b] for a, b in free_runs(places, base_spans(text, places), least))
            yield _batch(["value"], [(v,) for v in sorted(found)], [pa.string()])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)  # a pair's two bytes are its place
        for batch in batches:
            if batch.num_rows:
                text = " " + " ".join(batch.column(0).to_pylist()) + " "
                raw = np.frombuffer(text.encode("ascii"), np.uint8).astype(np.uint16)
                total += np.bincount(raw[:-1] << 8 | raw[1:], minlength=1 << 16)
        at = np.flatnonzero(total).tolist()
        yield _batch(["pair", "n"], [(chr(x >> 8) + chr(x & 255), int(total[x])) for x in at], [pa.string(), pa.int64()])

    values = shipped(docs).select("text").mapInArrow(runs, "value string").distinct()
    counts = values.mapInArrow(pairs, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r["pair"]: r["n"] for r in counts.collect() if r["pair"] != "  "}


def learn_formats(docs: DataFrame, limit: int = SAMPLE) -> tuple[dict[str, Format], Pairs, int]:
    """An automaton for each labelled kind, the model of ordinary runs, and the least length to score."""
    values = stash(labelled_values(docs), "secret-labels")
    formats = {k: Format(v) for k, v in sample_values(values, limit).items()}
    if not formats:
        return {}, Pairs([]), RUN_LEAST
    return formats, Pairs(counts=count_pairs(docs, RUN_LEAST)), RUN_LEAST


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def decisions(formats: dict[str, Format], ordinary: Pairs) -> Callable[[str], str | None]:
    """The kind a run is like, or None; short runs are remembered."""
    known: dict[str, str | None] = {}

    def like(value: str) -> str | None:
        if value in known:
            return known[value]
        kind = next((k for k, f in formats.items() if f.accepts(value, ordinary, MARGIN)), None)
        if len(value) <= REMEMBERED:
            if len(known) > 100_000:
                known.clear()
            known[value] = kind
        return kind

    return like


def scan(docs: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """Counts and digest of the fixed patterns' spans, and all spans with the learned ones.

    A learned span's kind is that of its format with ``like_`` in front.
    """
    formats, ordinary, least = learn_formats(docs, limit)

    order = [*KINDS, *(f"like_{k}" for k in KINDS)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like = decisions(formats, ordinary)
        for batch in batches:
            out = []
            texts = _texts(batch.column(1))
            for text, places in zip(texts, long_runs(texts, min(least, HEX_LEAST))):
                base = [s[:3] for s in base_spans(text, places)]
                more = [(f"like_{kind}", a, b) for a, b in free_runs(places, base, least) if (kind := like(text[a:b]))]
                kinds = [s[0] for s in base]
                out.append((
                    *(kinds.count(k) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(),
                    joined(sorted(base + more, key=lambda s: (s[1], order.index(s[0]))))))
            found = _batch(["n_assign", "n_access", "n_hex", "base_sha256", "spans"], out, [pa.int64()] * 3 + [pa.string()] * 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], ["doc_id", *found.schema.names])

    return shipped(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(
        rows, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str, spans: str, mark: str) -> str:
    """The text with each stretch that spans cover, overlapping ones as one, replaced by the mark."""
    out, at = [], 0
    cuts = sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",") if s)
    for a, b in cuts:
        if a >= at:
            out.append(text[at:a] + mark)
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_documents(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with their secrets replaced; the learned formats come from these documents.

    A row's own text is scanned again instead of joined with its spans, so nothing is shuffled.
    """
    formats, ordinary, least = learn_formats(docs)
    names, at = docs.columns, docs.columns.index("text")
    schema = docs.schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        like = decisions(formats, ordinary)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = []
            for text, places in zip(texts, long_runs([t or "" for t in texts], min(least, HEX_LEAST))):
                if not text:
                    clean.append(text)
                    continue
                spans = [s[:3] for s in base_spans(text, places)]
                spans += [("like", a, b) for a, b in free_runs(places, spans, least) if like(text[a:b])]
                clean.append(redact(text, joined(spans), mark) if spans else text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    out = shipped(docs).mapInArrow(rows, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in names else out
