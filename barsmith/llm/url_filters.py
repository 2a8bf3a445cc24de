"""URL filters: pattern rules indexed by their rarest literal token.

Two kinds of rules are compiled to regular expressions. A site rule is a host and a path, such
as ``example.net/en/``: it fits the host and its subdomains where the path starts like that, and
letters of the path keep their case. A pattern is written as in filter lists and ignores the case
of A-Z: ``||`` stands for the start of a host or of one of its parent domains, ``|`` for an end of
the address, ``*`` for anything, ``^`` for a separator or the end, and ``@@`` in front allows.
Patterns see an address from its first ``://`` on.

A token is a longest run of a-z and 0-9. A rule's literal tokens are those that stand whole in
every address that it fits; it is filed under the one that the fewest addresses have. An address
looks its tokens up, and only rules found there run their expressions. Rules without a literal
token are filed under the empty one, which every address has.

The longest site rule decides; without any, an allowing pattern, else a blocking one, the longest
first; without these the address is allowed. Ties go to the text that sorts last.

Rules may be many: they are a table, joined by token. Spark broadcasts the index while its file is
below the session's threshold and shuffles and splits otherwise. Addresses are shuffled once, one
row each after the map side has combined its matches.

Defined cases: an address that is null or has no ``://`` has empty host and path and fits no site
rule; patterns see the whole of it; repeated rows and rows without an id stay, each with its
verdict; an empty table gives an empty result; rules that are null or have no characters are left
out; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stash

ALLOW, BLOCK = "allow", "block"
RULES = "kind string, rule string, verdict string"
SITE, PATTERN = "site", "pattern"

# The site rules of the query (fixed values).
SITE_RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))
# Patterns for crawled pages: spam hosts, advertising, accounts, shops, session ids and files.
PATTERNS = (
    "||spam-farm.", "||cheap-pills.", "||casino-", "-casino.", "-bets.", "||track.", "||tracker.", "||ads.",
    "/ads/", "/adserver/", "/banner^", "/popup^", "/track/", "/tracking/", "/login^", "/signin^", "/logout^",
    "/register^", "/cart^", "/checkout^", "^sessionid=", "^phpsessid=", "^replytocom=", "/wp-admin/",
    ".exe|", ".zip|", ".apk|", ".iso|", "@@||docs.", "@@/wiki/", "@@/docs/",
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: What stands between the mark of a host and a rule's own text.
_PARENTS = r"^://(?:[^/?#]*\.)?"
_TOKEN = "[a-z0-9]+"
_WHOLE_TOKEN = r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])"
ANY = ""


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def host(url: Column) -> Column:
    return lowered(F.regexp_extract(url, _PARTS, 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def default_rules(spark: SparkSession) -> DataFrame:
    """The rules above as a table (kind, rule, verdict)."""
    sites = [(SITE, rule, verdict) for rule, verdict in SITE_RULES]
    patterns = [(PATTERN, p, ALLOW if p.startswith("@@") else BLOCK) for p in PATTERNS]
    return spark.createDataFrame(sites + patterns, RULES)


def compiled(rules: DataFrame) -> DataFrame:
    """(kind, rule, verdict, regex, tokens) of the rules (kind, rule, verdict)."""
    is_site = F.col("kind") == SITE
    plain = F.regexp_replace(lowered(F.col("rule")), "^@@", "")
    at_host, at_start = plain.startswith("||"), plain.startswith("|")
    at_end = plain.endswith("|") & (F.length(plain) > 1)
    body = F.when(is_site, F.col("rule")).otherwise(
        F.regexp_replace(F.regexp_replace(plain, r"^\|\|?", ""), r"\|$", ""))
    literal = F.regexp_replace(F.col("body"), r"([!-)+-/:-@\[-\]_`{-~])", r"\\$1")
    wild = F.regexp_replace(F.regexp_replace(literal, r"\*", ".*"), r"\^", r"(?:[^a-z0-9_.%-]|\\z)")
    start = F.when(is_site | at_host, F.lit(_PARENTS)).when(at_start, F.lit("^")).otherwise(F.lit(""))
    regex = F.concat(
        F.lit("(?s)"), start, F.when(is_site, F.regexp_replace(literal, r"([*^])", r"\\$1")).otherwise(wild),
        F.when(~is_site & at_end, F.lit(r"\z")).otherwise(F.lit("")))
    # An open end may be in the middle of a token, as beside a star; a site rule's path is open.
    guarded = F.concat(
        F.when(is_site | at_start, F.lit("^")).otherwise(F.lit("*")),
        F.when(is_site, F.translate(lowered(F.col("body")), "*", "^")).otherwise(F.col("body")),
        F.when(~is_site & at_end, F.lit("^")).otherwise(F.lit("*")))
    return (
        rules.filter(F.length("rule") > 0).withColumn("body", body)
        .select("kind", "rule", "verdict", regex.alias("regex"),
                F.array_distinct(F.regexp_extract_all(guarded, F.lit(_WHOLE_TOKEN), F.lit(0))).alias("tokens")))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(lowered(F.coalesce(url, F.lit(""))), F.lit(_TOKEN), F.lit(0)))


def token_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(token, rules): every compiled rule under its literal token that the fewest addresses have."""
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    often = (
        urls.select(F.explode(url_tokens(F.col("url"))).alias("token"))
        .join(wanted, "token").groupBy("token").agg(F.count(F.lit(1)).alias("often")))
    of_rule = rules.select("kind", "rule", "verdict", "regex", F.explode_outer("tokens").alias("token"))
    filed = (
        of_rule.join(often, "token", "left")
        .groupBy("kind", "rule", "verdict", "regex")
        .agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "token")).alias("rarest")))
    return filed.groupBy(F.coalesce("rarest.token", F.lit(ANY)).alias("token")).agg(
        F.collect_list(F.struct("kind", "rule", "verdict", "regex")).alias("rules"))


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern): each page's verdict and what decided it."""
    pages = pages.select("page_id", "url")
    made = stash(compiled(rules), "url-rules")
    index = stash(token_index(made, pages), "url-index")
    mark = F.instr("url", "://")
    seen = pages.select(
        "page_id", "url", F.spark_partition_id().alias("part"),
        F.when(mark > 0, F.concat(F.lit("://"), host(F.col("url")), path(F.col("url")))).otherwise(F.lit("")).alias("site"),
        lowered(F.when(mark > 0, F.expr("substring(url, instr(url, '://'))")).otherwise(F.coalesce("url", F.lit("")))).alias("whole"),
        F.posexplode(F.concat(F.array(F.lit(ANY)), url_tokens(F.col("url")))).alias("place", "token"))
    fits = F.filter(
        "rules", lambda r: F.regexp_like(F.when(r["kind"] == SITE, F.col("site")).otherwise(F.col("whole")), r["regex"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        (r["kind"] == SITE).alias("by_site"),
        ((r["kind"] == PATTERN) & (r["verdict"] == ALLOW)).alias("allows"),
        F.length(r["rule"]).alias("length"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    met = seen.join(index, "token", "left").select("page_id", "url", "part", "place", best.alias("best"))
    # Rows that repeat are counted by task, so that none has to hold them all, and dealt out again.
    found = (
        met.filter((F.col("place") == 0) | F.col("best").isNotNull())
        .groupBy("page_id", "url", "part")
        .agg(F.max("best").alias("best"), F.count_if(F.col("place") == 0).alias("n")))
    each = found.select("page_id", "url", "best", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    by_site = F.coalesce("best.by_site", F.lit(False))
    return each.select(
        "page_id", F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path(F.col("url")), F.lit("")).alias("path"),
        F.when(by_site, F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"),
        F.when(~by_site, F.col("best.rule")).alias("pattern"))
