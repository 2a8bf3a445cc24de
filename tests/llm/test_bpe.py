"""BPE against the tokenizers library, and the transducer against a dictionary."""

import hashlib
import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barsmith.llm import bpe
from barsmith.llm.automaton import Lexicon, compile_words
from barsmith.llm.common import documents

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def merger():
    return bpe.Merger(bpe.load_model(PATH))


def odd_texts():
    rng = random.Random(4)
    pool = "abcXYZ 019'_-\t\n.!<|>²½ßÅÉéŁσΣςİıǅﬀЖ中あ한ा́  ​\x00\x1c\x85\U0001f600ͅ٣Ⅷ"
    yield from ("", " ", "it's we'll they'VE 'Sam", "<|endoftext|>", "a<|startoftext|>B <|endoftext|>c<|endoftex|>", "\0<|endoftext|>")
    yield "a" * 3000
    yield "thnd" * 700
    for _ in range(400):
        yield "".join(rng.choice(pool) for _ in range(rng.randrange(1, 60)))


def test_ids_and_decoding_equal_the_library(library, merger):
    texts = list(odd_texts())
    lexicon = Lexicon(bpe.build_lexicon(["the", "it", "thnd", ".", "é"], merger))
    for enc in (bpe.Encoder(merger, lexicon), bpe.Encoder(merger, None)):
        for text, (ids, decoded) in zip(texts, enc.encode(texts), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert ids == " ".join(map(str, want)), repr(text)
            assert decoded == library.decode(want, skip_special_tokens=False), repr(text)


def test_every_character_equals_the_library(library, merger):
    enc = bpe.Encoder(merger, None)
    # Characters newer than Python's own tables are the one known difference.
    points = [c for c in range(0x3000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    texts = ["".join(f"a{chr(c)}b1{chr(c)}. " for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    wrong = []
    for text, (ids, _) in zip(texts, enc.encode(texts), strict=True):
        if ids != " ".join(map(str, library.encode(text, add_special_tokens=False).ids)):
            wrong.append(text)
    assert not wrong, wrong[:2]


def test_query_equals_the_library(spark, library):
    docs = documents(spark, SF)
    got = {r["doc_id"]: r for r in bpe.encode_documents(docs, PATH, lexicon_words=500).collect()}
    for doc_id, text in docs.collect():
        ids = library.encode(text, add_special_tokens=False).ids
        row = got[doc_id]
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges_and_decoding(spark, library):
    df = spark.createDataFrame([(1, None, 7), (None, "", 7), (2, "The the", 8), (2, "The the", 8)], "doc_id long, text string, ids int")
    encoded = bpe.encode_documents(df, PATH)
    rows = encoded.select("doc_id", "n_tokens").collect()
    assert sorted(rows, key=str) == sorted([(1, 0), (None, 0), (2, 2), (2, 2)], key=str)
    assert {r["text"] for r in bpe.decode_documents(encoded, PATH).collect()} == {"", "the</w> the</w>"}
    assert bpe.encode_documents(df.limit(0), PATH).count() == 0


def test_transducer_numbers_words_in_order():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))).encode() for _ in range(3000)})
    data = compile_words(words, [[i, i + 1] for i in range(len(words))])
    lexicon = Lexicon(data)
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    assert lexicon.output(5) == [5, 6]
    other = [w for w in (b"abcabcabca", b"d", b"", b"abd") if w not in words]
    assert (lexicon.numbers(other) == -1).all()
    # Endings are shared: far fewer states than a prefix tree has.
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    assert len(lexicon.final) < len(prefixes) / 2
    empty = Lexicon(compile_words([], []))
    assert empty.numbers([b"a"]).tolist() == [-1]


def test_large_ids_beside_null_ids(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, "a word"), (None, None)], "doc_id long, text string").coalesce(1)
    encoded = bpe.encode_documents(df, public_tokenizers.path("word_bpe_49k.json"))
    assert {r["doc_id"]: r["n_tokens"] for r in encoded.collect()} == {big: 2, None: 0}
    decoded = bpe.decode_documents(encoded, public_tokenizers.path("word_bpe_49k.json"))
    assert {r["doc_id"]: r["text"] for r in decoded.collect()} == {big: "a</w> word</w>", None: ""}
