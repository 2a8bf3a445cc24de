"""Personal data against plain regular expressions, and patterns that find unseen identifiers."""

import hashlib
import random
import re
import time

from barsmith.llm import pii
from barsmith.llm.common import documents

SF = "/root/testdata/sf0.01"


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    def d(m):
        return re.sub("[^0-9]", "", m[0])

    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(d(m)) <= 19 and luhn(d(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(d(m)) <= 15),
    )
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, rx, ok in rules for m in re.finditer(rx, text or "") if ok(m))


def check(docs, rows):
    got = {(r["doc_id"]): r for r in rows}
    for doc_id, text in docs:
        want = plain(text)
        row = got[doc_id]
        assert row["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (text, want, row["spans"])
        assert row["spans"].startswith(want)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [want.count(f"{k}:") for k in pii.KINDS]


def test_query_equals_plain_patterns(spark):
    docs = documents(spark, SF)
    check([tuple(r) for r in docs.collect()], pii.find_personal_data(docs).collect())


def test_odd_texts_equal_plain_patterns(spark):
    rng = random.Random(3)
    parts = ["a@b.co", "@", ".", "x%d@e-f.g.h", "1.2.3.4", "256.1.1.1", "0001.2.3.4", "4111 1111 1111 1111", "4111-1111", " ", "-", "+1 (555) 010-9999",
             "+", "7", "12345678", "é", "😀", "\n", "a@b.c@d.e", "+44 20 7946 0958 ", "1.2.3.4.5.6.7.8", "0" * 17]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 8))) for _ in range(1500)]
    texts += [None, "", "1" * 60_000, "1 " * 30_000, "a" * 60_000 + "@", "a.b" * 20_000, "+" * 5000, "9" * 100 + "@x.y"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 as base", "'k' as kind")
    check(rows, pii.find_personal_data(df).collect())


def test_patterns_of_seeds_find_unseen_identifiers(spark):
    rng = random.Random(5)
    rows = []
    for i in range(40):
        rows.append((i, f"please call hotline {'+1 (555) ' + str(rng.randrange(100, 999)) + '-' + str(rng.randrange(1000, 9999))} today friend number {i}"))
    rows += [(100, "é please call hotline 555-0199-22, today"), (101, "in the year 20245 nothing"), (102, "mixed number 77777 here"), (None, "call hotline 99887766"), (None, "call hotline 99887766"), (103, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {}
    for r in pii.find_personal_data(df).collect():
        got.setdefault(r["doc_id"], []).append(r["spans"])
    assert got[100] == ["context_phone:22:33"]
    assert got[101] == got[102] == got[103] == [""]
    assert got[None] == ["context_phone:13:21"] * 2
    assert all(s[0].startswith("phone:20:") for k, s in got.items() if k is not None and k < 40)
    assert pii.find_personal_data(df.limit(0)).count() == 0


def _spans(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: r["spans"] for r in pii.find_personal_data(df).collect()}


def test_groups_of_digits_are_one_identifier(spark):
    rng = random.Random(7)
    rows = [(i, f"please call hotline +1 (555) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)} friend") for i in range(40)]
    rows += [(50 + i, f"charge card number 4111 1111 1111 1111 please {'abcdefghij'[i % 10]}") for i in range(3)]
    cards = [d for d in map(str, range(4111111111110000, 4111111111112000)) if luhn(d)][:30]
    rows += [(60 + i, f"charge card number {' '.join(d[k:k + 4] for k in (0, 4, 8, 12))} please") for i, d in enumerate(cards)]
    rows += [(i + 200, f"write to mailbox user{'abcdefghijklmnopqrst'[i]}@host.org soon") for i in range(20)]
    rows += [
        (100, "é call hotline (555) 010-9999 today"), (101, "charge card number 4111 1111 1111 1112, please"),
        (102, "write to mailbox bob@localhost soon"), (103, "call hotline 12 34"), (104, "call hotline 1 2"),
        (105, "1.2.3.4 99887766 friend"), (106, "1 " * 30_000 + "1x"), (107, "call hotline 99887766 1.2.3.4")]
    got = _spans(spark, rows)
    assert got[100] == "context_phone:15:29"
    assert got[101] == "context_card:19:38"
    assert got[102] == "context_email:17:30"
    assert got[103] == "context_phone:13:18" and got[104] == ""
    # A known span beside an unseen group does not hide it.
    assert got[105] == "ip:0:7,context_phone:8:16" and got[107] == "ip:22:29,context_phone:13:21"


def test_accepted_instances_support_later_patterns(spark):
    rng = random.Random(8)
    rows = [(i, f"hotline +1 (555) {100 + i}-{rng.randrange(1000, 9999)} {chr(97 + i)}end") for i in range(20)]
    # These are known by "hotline" only, and are all that stands before "pager".
    rows += [(100 + i, f"hotline 555{i}0199 pager") for i in range(5)]
    rows += [(200, "dial 5559888 pager")]
    assert _spans(spark, rows)[200] == "context_phone:5:12"


def test_long_texts_equal_plain_patterns_in_linear_time(spark):
    """Some 1 MB of e-mails, of numbers and of both; doubling a text far less than quadruples the time."""
    def text(n):
        return "".join(f"to u{i}@h.org or 10.0.0.{i % 300} call {i * 7919} now, " for i in range(n))

    took = []
    for n in (10_000, 20_000):
        rows = [(0, text(n)), (1, "7 " * 20 * n), (2, "1.2.3.4 " * n + "b " + "x" * n + " 12345678")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        scanned = pii.scan_texts(df)
        start = time.monotonic()
        got = {r["doc_id"]: r for r in scanned.collect()}
        took.append(time.monotonic() - start)
        for doc_id, t in rows:
            assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in got[doc_id]["base"]) == plain(t)
        assert len(got[0]["found"]) == 3 * n
        assert [f["kind"] for f in got[0]["found"][:3]] == ["email", "ip", None]
        assert [rows[0][1][f["start"]:f["end"]] for f in got[0]["found"]] == [f["value"] for f in got[0]["found"]]
        # The last instance has a very long token on its left, which its contexts hold whole.
        assert got[2]["found"][-1]["patterns"] == [f"2:b {'x' * n}", f"1:{'x' * n}"]
    assert took[1] < 3 * took[0] + 5


def test_rounds_go_on_until_scores_settle(spark):
    """A chain of patterns, each known only by the instances that the one before it marks."""
    def word(k):
        return "alpha bravo carol delta echo foxtrot".split()[k]

    rows = [(i, f"{word(0)} +1 (555) {100 + i}-{2000 + i} end") for i in range(20)]
    for k in range(5):
        for i in range(20):
            rows += [(1000 * (k + 1) + i, f"{word(k)} 55{k}{i}0199"), (1000 * (k + 1) + 500 + i, f"{word(k + 1)} 55{k}{i}0199")]
    rows += [(9000, "in the year 20245")]
    got = _spans(spark, rows)
    assert all("context_phone" in got[1000 * (k + 1) + i] for k in range(5) for i in range(20)) and got[9000] == ""
