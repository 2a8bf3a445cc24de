"""BPE encoding and decoding with a transducer lexicon of frequent words.

Spark counts the words of all documents; the most frequent are encoded once and compiled into a
minimal acyclic transducer whose outputs are their ids. Executors fetch the file and map it
into memory. Words found there take their ids from it, all others are merged exactly, many at a
time. The lexicon decides speed only: any lexicon gives the same ids.

The file names the vocabulary, the merges, the normaliser and the pre-tokeniser of a word-end
BPE tokenizer (canonical composition, white space runs to one space, lower case; byte-level
symbols; the last symbol of a word carries a mark). Decoding joins token texts with spaces, as
that file, which has no decoder, asks for.

Defined cases: null and empty texts have no ids and decode to the empty text; special tokens
written in a text become their ids; long words without a break are merged with a heap; repeated
rows and rows without an id are encoded like others; other columns are not read. Characters
that Python's Unicode tables don't know yet may be split unlike in a library with newer ones.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import tempfile
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Lexicon, compile_words
from .common import shipped, stash, whole_text

END = "</w>"
#: How many words the lexicon holds, and the longest of them in bytes.
LEXICON_WORDS = 50_000
LEXICON_BYTES = 24
#: Words a task remembers at most before it starts anew.
REMEMBERED = 400_000
#: Words of more symbols are merged one by one.
LONG_WORD = 64
NO_RANK = np.int32(2**31 - 1)

# The pre-tokeniser's pattern (fixed value), for any text and for texts in which \w and \d say the same.
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Characters outside of that: controls, superscript and fraction digits, all scripts but Latin.
SPECIAL_CASE = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f\xb2\xb3\xb9\xbc-\xbeİɐ-\U0010ffff]")
#: White space as the normaliser's pattern has it.
SPACES = regex.compile(r"[\t-\r \x85\p{Z}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte (fixed values of byte-level BPE)."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class Merger:
    """Merges of one vocabulary: bytes of a word to its ids."""

    def __init__(self, model: dict) -> None:
        vocab = model["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.text = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.text[i] = token
        names = byte_symbols()
        self.inner = np.array([vocab[c] for c in names], np.int32)
        self.last = np.array([vocab[c + END] for c in names], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        self.base = len(self.text)
        key = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int32), made
        self.of_pair = {int(k): r for r, k in enumerate(key)}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        want = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where((self.key[at] == want) & (left >= 0) & (right >= 0), self.rank[at], NO_RANK)

    def symbols(self, word: bytes) -> np.ndarray:
        out = self.inner[np.frombuffer(word, np.uint8)]
        out[-1] = self.last[word[-1]]
        return out

    def merge_long(self, word: bytes) -> list[int]:
        """Merge by a heap of (rank, place): n log n for a word of n symbols."""
        sym = self.symbols(word).tolist()
        after, before = [*range(1, len(sym)), -1], [*range(-1, len(sym) - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (r := self.of_pair.get(sym[i] * self.base + sym[j])) is not None:
                heapq.heappush(heap, (r, i, sym[i], sym[j]))

        for i in range(len(sym)):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one of the two has been merged since
            sym[i], sym[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            after[j] = -1
            offer(i)
            offer(before[i])
        return [s for s in sym if s >= 0]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """The ids of many words; those of like length are merged side by side."""
        out: list[list[int]] = [[] for _ in words]
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self.merge_long(w)
            elif w:
                groups.setdefault(-(-len(w) // 8) * 8, []).append(i)
        for width, members in groups.items():
            for begin in range(0, len(members), 8192):
                part = members[begin : begin + 8192]
                for i, ids in zip(part, self._merge_block([words[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_block(self, words: list[bytes], width: int) -> list[list[int]]:
        sym = np.full((len(words), width + 1), -1, np.int32)
        size = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym[np.arange(width + 1) < size[:, None]] = self.inner[flat]
        sym[np.arange(len(words)), size - 1] = self.last[flat[np.cumsum(size) - 1]]
        rank = self.ranks(sym[:, :-1], sym[:, 1:])
        place = np.arange(width + 1)
        rows = np.arange(len(words))
        while True:
            best = rank[rows].argmin(axis=1)
            least = rank[rows, best]
            rows, best, least = (x[least < NO_RANK] for x in (rows, best, least))
            if not len(rows):
                break
            now = sym[rows]
            now[np.arange(len(rows)), best] = self.made[least]
            # Close the gap right of the merged symbol; only the pairs beside it are new.
            now = np.take_along_axis(now, np.minimum(place + (place > best[:, None]), width), 1)
            now[:, -1] = -1
            old = np.take_along_axis(rank[rows], np.minimum(place[:-1] + (place[:-1] > best[:, None]), width - 1), 1)
            old[:, -1] = NO_RANK
            k, left = np.arange(len(rows)), np.maximum(best - 1, 0)
            for at in (best, left):
                old[k, at] = self.ranks(now[k, at], now[k, np.minimum(at + 1, width)])
            sym[rows], rank[rows] = now, old
        ids, ends = sym[sym >= 0].tolist(), np.cumsum((sym >= 0).sum(axis=1)).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


def normalise(text: str) -> str:
    """Composed, white space runs as one space, each character in lower case by itself."""
    text = SPACES.sub(" ", unicodedata.normalize("NFC", text))
    if "Σ" in text or "İ" in text:  # str.lower looks at a sigma's neighbours
        return "".join(c.lower() for c in text)
    return text.lower()


def split_words(text: str) -> list[str]:
    if SPECIAL_CASE.search(text):
        return PATTERN.findall(normalise(text))
    return PLAIN.findall(unicodedata.normalize("NFC", text).lower())


class Encoder:
    """Texts to ids, with a lexicon for frequent words and a bounded memory of others."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None) -> None:
        self.merger, self.lexicon = merger, lexicon
        self.specials = re.compile("|".join(f"({re.escape(t)})" for t in merger.special) or "(?!)")
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def pieces(self, text: str) -> list[str]:
        """The words of a text, special tokens among them with a mark in front."""
        if "<|" not in text or not self.specials.search(text):
            return split_words(text)
        out, at = [], 0
        for m in self.specials.finditer(text):
            out += split_words(text[at : m.start()])
            out.append("\0" + m.group())
            at = m.end()
        return out + split_words(text[at:])

    def learn(self, words: set[str]) -> None:
        """Look up or merge the words that aren't remembered."""
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.decoded.clear()
        new = [w for w in words if w not in self.ids]
        raw = [w.encode() for w in new]
        number = self.lexicon.numbers(raw) if self.lexicon and new else np.full(len(new), -1)
        unseen = np.flatnonzero(number < 0)
        found: list[list[int]] = [[] if n < 0 else self.lexicon.output(n) for n in number]
        plain = [i for i in unseen if not new[i].startswith("\0")]
        for i, ids in zip(plain, self.merger.merge([raw[i] for i in plain])):
            found[i] = ids
        for i in unseen:
            if new[i].startswith("\0"):
                found[i] = [self.merger.special[new[i][1:]]] if new[i][1:] in self.merger.special else self.merger.merge([raw[i]])[0]
        for w, ids in zip(new, found):
            self.ids[w] = " ".join(map(str, ids))
            self.decoded[w] = " ".join(self.merger.text[i] for i in ids)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids and its decoded text, both joined by spaces."""
        begin = size = 0
        for end in range(len(texts) + 1):
            if end < len(texts) and size < 1 << 20:
                size += len(texts[end])
                continue
            split = [self.pieces(t) for t in texts[begin:end]]
            self.learn(set().union(*split))
            for words in split:
                yield " ".join(map(self.ids.__getitem__, words)), " ".join(map(self.decoded.__getitem__, words))
            begin, size = end, len(texts[end]) if end < len(texts) else 0


def load_model(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def frequent_words(docs: DataFrame, limit: int = LEXICON_WORDS) -> list[str]:
    """The most frequent words of all documents, at most ``limit`` of them.

    Words of like frequency (within an eighth of a doubling) are taken together or not at all, so
    the driver gets a few hundred sums and then at most ``limit`` words, whatever the input.
    """
    found = F.regexp_extract_all(F.lower(whole_text("text")), F.lit(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"), F.lit(0))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").count()
    short = counts.filter((F.octet_length("word") <= LEXICON_BYTES) & (F.col("count") > 1))
    levelled = stash(short.select("word", F.floor(F.log2("count") * 8).cast("int").alias("level")), "word-counts")
    total, lowest = 0, None
    for level, n in sorted(map(tuple, levelled.groupBy("level").count().collect()), reverse=True):
        total += n
        if total > limit:
            break
        lowest = level
    if lowest is None:
        return []
    return [r["word"] for r in levelled.filter(F.col("level") >= lowest).select("word").collect()]


def build_lexicon(words: list[str], merger: Merger) -> np.ndarray:
    raw = sorted({w.encode() for w in words if w and "\0" not in w})
    return compile_words(raw, merger.merge(raw))


def ship(docs: DataFrame, array: np.ndarray) -> str:
    """Give the lexicon to every executor, also to those that join later; returns its name."""
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    np.save(path, array)
    docs.sparkSession.sparkContext.addFile(path)
    return name


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, model_path: str) -> Encoder:
    """One encoder for a worker process; a newer lexicon replaces it."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(Merger(load_model(model_path)), Lexicon.open(SparkFiles.get(name)))
    return _encoders[name]


def encode_documents(docs: DataFrame, model_path: str, keep_ids: bool = True, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), and the ids themselves if asked for.

    ``model_path`` is a tokenizer file that driver and executors have.
    """
    docs = shipped(docs).select("doc_id", "text")
    name = ship(docs, build_lexicon(frequent_words(docs, lexicon_words), Merger(load_model(model_path))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, model_path)
        for batch in batches:
            ids, n, ids_sha, text_sha = [], [], [], []
            for found, text in encoder.encode([t or "" for t in batch.column(1).to_pylist()]):
                n.append(found.count(" ") + 1 if found else 0)
                ids_sha.append(hashlib.sha256(found.encode()).hexdigest())
                text_sha.append(hashlib.sha256(text.encode()).hexdigest())
                if keep_ids:
                    ids.append(np.array(found.split(), np.int32))
            columns = {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()),
                       "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if keep_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        rows, schema + (", ids array<int>" if keep_ids else ""))


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text): the token texts of ``ids``, joined by spaces."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = Merger(load_model(model_path)).text
        for batch in batches:
            found = [" ".join(text[i] for i in ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(found, pa.string())})

    return shipped(encoded).select(F.col("doc_id").cast("long"), "ids").mapInArrow(rows, "doc_id long, text string")
