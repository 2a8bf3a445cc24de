"""URL filters against every rule tested on every address, odd rows, and the index itself."""

import re
from collections import Counter

import pytest

from barsmith.llm import oracles, url_filters
from barsmith.llm.url_filters import ALLOW, BLOCK, PATTERN, RULES, SITE

from ..compare import connect, differences

ODD = [
    (1, None), (2, ""), (3, "no scheme at all/ads/"), (4, "http://a.NET/x"), (5, "http://anet/x"), (6, "http://a.net"),
    (7, "https://Example.net/en/ads/1"), (8, "https://www.example.net/EN/"), (9, "https://example.com/de/?x=http://b.net/"),
    (10, "x://org/fr/#top"), (11, "http://user@shop.org:80/fr/a"), (12, "a?u=http://b.net/q"), (13, "http:///ads/"),
    (14, "http://casino-royal.example.com/"), (15, "http://x.com/a?sessionid=5"), (16, "http://x.com/a?nosessionid=5"),
    (17, "http://docs.x.com/login"), (18, "http://x.com/login"), (19, "http://x.com/loginpage"), (20, "http://x.com/a.zip"),
    (21, "http://x.com/a.zip?x"), (22, "http://ads.x.com/\u00e9/ads\u00e9"), (23, "http://x.com/" + "a/" * 50_000 + "cart"),
    (None, "http://x.net/"), (None, "http://x.net/"), (None, None), (25, "HTTP://X.COM/LOGIN"), (26, "http://x.com/a\n/ads/"),
    (9007199254740993, "http://y.net/"), (4, "http://a.NET/x"), (4, "http://other.com/"),
]
EXTRA = "page_id long, url string"


def plain_fits(rule: str, site: str, whole: str, kind: str) -> bool:
    if kind == SITE:
        return re.search(r"^://(?:[^/?#]*\.)?" + re.escape(rule), site) is not None
    return re.search(oracles._pattern_regex(rule.lower()).replace(r"\z", r"\Z"), whole) is not None


def plain(rows, rules):
    out = []
    lower = str.maketrans(url_filters._UPPER, url_filters._LOWER)
    for page_id, url in rows:
        url = url or ""
        _, mark, rest = url.partition("://")
        rest = rest if mark else ""
        given = re.match(r"[^/?#]*", rest).group()
        host, path = given.translate(lower), re.match(r"[^?#]*", rest[len(given):]).group()
        site = f"://{host}{path}" if mark else ""
        whole = (mark + rest if mark else url).translate(lower)
        fits = [(k, r, v) for k, r, v in rules if plain_fits(r, site, whole, k)]
        best = max(((k == SITE, k == PATTERN and v == ALLOW, len(r), r, v) for k, r, v in fits), default=None)
        by_site = best is not None and best[0]
        out.append((page_id, host, path, best[3] if by_site else None, best[4] if best else ALLOW,
                    best[3] if best and not by_site else None))
    return Counter(out)


def test_odd_rows(spark):
    rules = url_filters.default_rules(spark)
    df = spark.createDataFrame(ODD, EXTRA).selectExpr("*", "'x' as rule", "'y' as token", "1 as part", "'z' as host")
    got = Counter(map(tuple, url_filters.judge(df, rules).collect()))
    assert got == plain(ODD, [tuple(r) for r in rules.collect()])
    verdicts = {r[0]: r[4] for r in got}
    assert verdicts[17] == ALLOW and verdicts[18] == verdicts[25] == BLOCK and verdicts[19] == ALLOW
    assert url_filters.judge(df.limit(0), rules).count() == 0


def test_odd_rows_by_sql(spark):
    df = spark.createDataFrame(ODD, EXTRA)
    con = connect("/root/testdata/sf0.001")
    con.execute("CREATE TABLE odd (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO odd VALUES (?, ?)", ODD)
    assert differences(url_filters.judge(df, url_filters.default_rules(spark)), con, oracles.url_filters("odd")) is None


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_many_rules_and_hot_tokens(spark, broadcast):
    rules = [(PATTERN, f"/page{i}^", BLOCK) for i in range(300)] + [(PATTERN, "@@/page7^", ALLOW)]
    rules += [(PATTERN, "*ge9*", BLOCK), (PATTERN, "|://h1.", BLOCK), (PATTERN, "", BLOCK), (PATTERN, None, BLOCK),
              (SITE, "H.com/", BLOCK), (SITE, "com/page12", ALLOW), (SITE, "com/page1", BLOCK), (PATTERN, "a+b(c", BLOCK)]
    rows = [(i, f"http://h{i % 3}.com/page{i % 350}/x") for i in range(2000)] + [(0, "http://h.com/a+b(c")] * 700
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = url_filters.judge(spark.createDataFrame(rows, EXTRA), spark.createDataFrame(rules, RULES)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert Counter(map(tuple, got)) == plain(rows, [r for r in rules if r[1]])


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = spark.createDataFrame(
        [(PATTERN, "||rare.common^", BLOCK), (PATTERN, "*tail", BLOCK), (PATTERN, "/common/unseen/", BLOCK)], RULES)
    pages = spark.createDataFrame([(i, f"http://{'rare' if i == 0 else 'x'}.common/tail") for i in range(9)], EXTRA)
    index = {r["token"]: {x["rule"] for x in r["rules"]} for r in url_filters.token_index(url_filters.compiled(rules), pages).collect()}
    assert index == {"rare": {"||rare.common^"}, "": {"*tail"}, "unseen": {"/common/unseen/"}}


def test_plan_has_no_python(spark):
    plan = url_filters.judge(
        spark.createDataFrame(ODD, EXTRA), url_filters.default_rules(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
