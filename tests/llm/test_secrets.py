"""Secret scans against plain regular expressions, and formats learned from labelled values."""

import hashlib
import random
import re

from barsmith.llm import secrets
from barsmith.llm.common import documents
from barsmith.llm.grammar import Automaton, Format, Pairs

SF = "/root/testdata/sf0.01"
RULES = (
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
)


def plain(text):
    spans = [(k, m.start(), m.end()) for k, rx, ok in RULES for m in re.finditer(rx, text) if ok(m)]
    return sorted(spans, key=lambda s: (s[1], [r[0] for r in RULES].index(s[0])))


def test_query_equals_plain_patterns(spark):
    docs = documents(spark, SF)
    got = {r["doc_id"]: r for r in secrets.scan(docs).collect()}
    for doc_id, text in docs.collect():
        want, row = plain(text), got[doc_id]
        assert row["base_sha256"] == hashlib.sha256(secrets.joined(want).encode()).hexdigest()
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[0] == k for s in want) for k in secrets.KINDS]
        assert set(secrets.joined(want).split(",")) <= set(row["spans"].split(",")) | {""}


def test_odd_texts_equal_plain_patterns():
    rng = random.Random(2)
    parts = ["password", "passwd=", "TOKEN", "toKen: ", "api_key", "APIKEY='", "secret\"", ":", "=", " ", "AKIA", "AKIA" + "Z9" * 9,
             "0123456789abcdef" * 2, "deadbeef", "é", "ſecret=abcdefgh", "toKen=abcdefgh", "\n", "abc", "x" * 30, "token=token=abcdef", "secret:token:abcdefgh"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    for text, runs in zip(texts, secrets.long_runs(texts)):
        assert [s[:3] for s in secrets.base_spans(text, runs)] == plain(text), text


def _keys(n, seed=1):
    rng = random.Random(seed)
    return ["sk-" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(20)) for _ in range(n)]


def test_automaton_generalises_a_format():
    form = Format(_keys(300))
    assert form.automaton.states < 30
    words = Pairs(["internationalisation", "verantwortungslosigkeit", "extraordinariamente"])
    unseen = _keys(100, seed=2)
    assert sum(form.accepts(k, words, 1.0) for k in unseen) > 90
    others = ["internationalisations12", "SK-" + unseen[0][3:], "xx-" + unseen[0][3:], unseen[0][:12]]
    assert not any(form.accepts(k, words, 1.0) for k in others)
    assert Automaton(["ab", "ab"]).bits("ab") > Automaton(["ab", "cd"]).bits("ab")


def test_learned_spans_and_redaction(spark):
    rows = [(i, f"some words here password = {k} and more") for i, k in enumerate(_keys(200))]
    bare = _keys(1, seed=9)[0]
    rows += [(500, f"note {bare} end"), (501, "nothing internationalisation to see"), (502, None), (503, ""), (None, "token=abcdef"), (504, f"é {bare}"), (504, f"é {bare}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "0L as n_chars", "'x' as spans", "1 as base")
    got = {r["doc_id"]: r for r in secrets.scan(df).collect()}
    assert got[500]["spans"] == "like_assign:5:28" and got[500]["n_assign"] == 0
    assert got[504]["spans"] == "like_assign:2:25"
    assert got[501]["spans"] == got[502]["spans"] == got[503]["spans"] == ""
    assert got[None]["spans"] == "assign:0:12"
    clean = {r["doc_id"]: r for r in secrets.redact_documents(df).collect()}
    assert clean[500]["text"] == "note [SECRET] end" and clean[500]["n_chars"] == 17
    assert clean[501]["text"] == "nothing internationalisation to see" and clean[502]["text"] is None
    assert clean[0]["text"] == "some words here [SECRET] and more" and clean[0]["spans"] == "x"
    assert secrets.scan(df.limit(0)).count() == 0 and secrets.redact_documents(df.limit(0)).count() == 0


def test_redact_takes_overlaps_as_one():
    assert secrets.redact("abcdefghij", "a:1:4,b:2:6,c:8:9", "_") == "a_gh_j"


def test_ordinary_runs_are_counted_over_the_whole_corpus(spark):
    runs = [f"path/{i:05d}/segment-{i * 7919 % 100_003:06d}" for i in range(1500)]
    df = spark.createDataFrame(
        [(i, f"token=abcdef0123456789 see {r} and {r}") for i, r in enumerate(runs)], "doc_id long, text string").repartition(5)
    _, ordinary, least = secrets.learn_formats(df)
    plain_counts = Pairs(runs)  # each distinct run once, however often it occurs
    assert least == secrets.RUN_LEAST == 6 and ordinary.pair == plain_counts.pair and ordinary.one == plain_counts.one
    assert all(abs(ordinary.bits(r) - plain_counts.bits(r)) < 1e-12 for r in runs[:20])


def test_runs_of_any_length_are_scored(spark):
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("qvxzjkyghu") for _ in range(n))
    keys = [number(rng.randrange(12, 60)) for _ in range(600)]
    df = spark.createDataFrame([(i, f"secret={k} wordswordswords") for i, k in enumerate(keys)], "doc_id long, text string")
    # Longer ones than any label pass as their symbols do; one alone, as many would be ordinary runs.
    for n in (70, 3000):
        more = df.union(spark.createDataFrame([(1000, number(n))], df.schema))
        assert secrets.scan(more, limit=100).filter("doc_id = 1000").first()["spans"] == f"like_assign:0:{n}"


def test_tasks_without_runs(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh12345678"), (2, "a b c")], "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for rows in (df, df.repartition(7)):
            assert {r["doc_id"]: r["n_assign"] for r in secrets.scan(rows).collect()} == {1: 1, 2: 0}
            assert {r["text"] for r in secrets.redact_documents(rows).collect()} == {"[SECRET]", "a b c"}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_large_ids_beside_null_ids(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(big, "token=abcdefgh", big), (None, "x", None)], "doc_id long, text string, other long").coalesce(1)
    assert {r["doc_id"] for r in secrets.scan(df).collect()} == {big, None}
    assert {(r["doc_id"], r["other"]) for r in secrets.redact_documents(df).collect()} == {(big, big), (None, None)}


def test_rest_of_a_partly_covered_run_is_scored(spark):
    assert secrets.free_runs([(0, 10), (12, 40)], [("assign", 5, 14), ("hex", 6, 8), ("hex", 20, 25)], 5) == [(0, 5), (14, 20), (25, 40)]
    bare = _keys(1, seed=9)[0]
    rows = [(i, f"some words here password = {k} and more") for i, k in enumerate(_keys(200))]
    df = spark.createDataFrame([*rows, (500, f"{bare}/AKIA{'Z9' * 9}")], "doc_id long, text string")
    # The slash belongs to the rest, so here it is a credential of its own only without it.
    assert secrets.scan(df).filter("doc_id = 500").first()["spans"] == "access:24:46"
    df = spark.createDataFrame([*rows, (500, f"{bare}AKIA{'Z9' * 9}")], "doc_id long, text string")
    assert secrets.scan(df).filter("doc_id = 500").first()["spans"] == "like_assign:0:23,access:23:45"


def test_automaton_of_long_strings_takes_no_states():
    rng = random.Random(6)
    long = ["".join(rng.choice("0123456789abcdef") for _ in range(20_000)) for _ in range(20)]
    assert Automaton(long).states < 30
