"""Personal data by fixed patterns and bootstrapped contextual extraction.

Fixed patterns give the base spans. They are also the seeds: every token with a digit or an @
is an instance, neighbouring groups of digits together one, those within base spans have a kind,
and the words beside an instance are its lexical patterns (two words before it, one before it,
one behind it). Spark scores the graph of patterns and instances in rounds: a pattern is as sure
of a kind as the share of its distinct instances that belong to it, an instance as its surest
pattern. Rounds go on until one moves no pattern by a thousandth. Patterns above ``SURE``
with enough support, from seeds and from what earlier rounds accepted, then mark instances that no
fixed pattern knows.

Everything is DataFrame functions. Texts are scanned once; places come from splitting a text at
the matches, so they count code points. What is shuffled are instances and their contexts.

Defined cases: null and empty texts have no spans; equal rows get equal spans; rows without an
id are scanned like others; an empty table gives an empty result; columns other than the two
named ones are not read. Patterns are written without nested backtracking, places are summed in
blocks, and instances meet the spans of their own stretch of text only: time grows with a text's
length, also with very many matches, runs of digits or tokens without spaces.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stash, whole_text

KINDS = ("email", "ip", "card", "phone")
# The base patterns (fixed values). A match can only start where its run of characters starts or
# where the last match ended, which the part in front says to spare needless attempts.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A part of an address that is at most 255.
OCTET = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"
#: A token that holds a digit or an @, from its start.
INSTANCE = r"(?<![^ \t-\r])[^ \t-\r0-9@]*+[0-9@][^ \t-\r]*+"

#: Digits and the punctuation within numbers, whole tokens one blank apart; the last may end a clause.
_GROUP = r"[(+]*+[0-9][0-9()./+-]*+"
GROUPS = rf"(?<![^ \t-\r]){_GROUP}(?![^ \t-\r])(?: {_GROUP}(?![^ \t-\r]))*+(?: {_GROUP}[^ \t-\r0-9A-Za-z@]*+(?![^ \t-\r]))?+"
#: An instance from its first letter or digit to its last; a bracket that is closed within it stays.
CORE = r"(?:\((?=[0-9+]++\).*[A-Za-z0-9])|[A-Za-z0-9+])(?:.*[A-Za-z0-9])?"

#: Rounds that are taken at least.
ROUNDS = 3
#: Matches whose places are summed one by one; instances that look up spans together, by level.
BLOCK = 128
STRETCHES = (32_768, 1_024, 32)
#: Characters beside an instance that hold its words as a rule; more are read where they don't.
NEAR = 60
#: Least confidence of a pattern, and the seeds or accepted instances of a kind that it must have met.
SURE = 0.8
MIN_SEEDS = 5
#: Digits an unseen identifier without an @ must have, all its groups together.
MIN_DIGITS = 4


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: part.rlike(OCTET))
    if kind == "card":
        return let(digits(value), lambda d: F.length(d).between(16, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def running(lengths: Column) -> Column:
    """The sum of what stands before each element, in blocks: no array grows beyond a block."""
    def sums(values: Column, of) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, start, lambda acc, x: F.struct(
            (acc["at"] + of(x)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def joined(done: Column) -> Column:
        return F.flatten(F.zip_with(
            done, sums(done, lambda d: d["at"])["out"], lambda d, before: F.transform(d["out"], lambda x: x + before)))

    return let(lengths, lambda all_: let(F.transform(blocks(all_, BLOCK), lambda block: sums(block, lambda x: x)), joined))


def blocks(values: Column, size: int) -> Column:
    """``values``, a column or a bound value, cut into arrays of ``size``."""
    return F.when(F.size(values) > size, F.transform(
        F.sequence(F.lit(1), F.size(values), F.lit(size)), lambda at: F.slice(values, at, size))).otherwise(F.array(values))


def matches(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start, end, value, before, after>>, places in code points."""
    def build(found: Column, pieces: Column) -> Column:
        ahead = running(F.transform(found, lambda m, i: F.length(F.get(pieces, i)) + F.length(m)))

        def placed(m: Column, i: Column, at: Column) -> Column:
            return F.struct(
                at.alias("start"), (at + F.length(m)).alias("end"), m.alias("value"),
                F.get(pieces, i).alias("before"), F.get(pieces, i + 1).alias("after"))

        return let(ahead, lambda sums: F.transform(
            found, lambda m, i: placed(m, i, F.get(sums, i) + F.length(F.get(pieces, i)))))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda found: let(F.split(text, pattern, -1), lambda pieces: build(found, pieces)))


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> by kind as listed, then start."""
    needs = {"email": text.contains("@"), "phone": text.contains("+")}
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def of(kind: str) -> Column:
        found = F.transform(
            F.filter(matches(text, PATTERNS[kind]), lambda s: valid(kind, s["value"])),
            lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(needs.get(kind, text.rlike("[0-9]")), found).otherwise(empty)

    return F.concat(*map(of, KINDS))


def overlaps(b: Column, start: Column, end: Column) -> Column:
    return (b["start"] < end) & (b["end"] > start)


def beside(spans: Column, base: Column, body, stretches: tuple[int, ...] = STRETCHES) -> Column:
    """``body(span, base spans of its stretch)`` of each span; ``spans`` are in order.

    Stretches of spans pick the base spans that touch them, smaller ones among what the larger
    picked, so a span isn't held against the base spans of a whole long text.
    """
    if not stretches:
        return F.transform(spans, lambda s: body(s, base))

    def stretch(some: Column) -> Column:
        first, last = F.get(some, F.lit(0)), F.get(some, F.size(some) - 1)
        here = let(F.struct(first["start"].alias("start"), last["end"].alias("end")),
                   lambda r: F.filter(base, lambda b: overlaps(b, r["start"], r["end"])))
        return let(here, lambda near: beside(some, near, body, stretches[1:]))

    return F.flatten(F.transform(blocks(spans, stretches[0]), stretch))


def side(text: Column, near: Column, pick) -> Column:
    """``pick`` of the words beside an instance, of ``near`` alone where it holds them whole."""
    def tidy(c: Column) -> Column:
        return F.lower(F.trim(F.translate(c, "\t\n\x0b\f\r", "     ")))

    return let(tidy(near), lambda some: F.when(
        (F.octet_length(text) <= NEAR) | (pick(some) != some), some).otherwise(tidy(text)))


INSTANCES = "array<struct<start:int,end:int,value:string,before:string,after:string>>"


def candidates(text: Column) -> Column:
    """Runs of digit groups and tokens with a digit or an @, in order."""
    return F.when(text.rlike("[0-9@]"), matches(text, f"{GROUPS}|{INSTANCE}")).otherwise(F.array().cast(INSTANCES))


def parted(runs: Column, base: Column) -> Column:
    """The runs, or their tokens where a base span is beside other groups."""
    def parts(s: Column, near: Column) -> Column:
        inner = F.struct(
            (s["start"] + F.length(F.regexp_extract(s["value"], "^[^0-9+]*+", 0))).alias("start"),
            (s["end"] - F.length(F.regexp_extract(s["value"], "(?:^|(?<=[0-9]))[^0-9]*+$", 0))).alias("end"))
        partly = let(inner, lambda r: F.exists(near, lambda b: overlaps(b, s["start"], s["end"]) & (
            (b["start"] > r["start"]) | (b["end"] < r["end"]))))
        tokens = F.transform(matches(s["value"], INSTANCE), lambda t: F.struct(
            (s["start"] + t["start"]).alias("start"), (s["start"] + t["end"]).alias("end"), t["value"].alias("value"),
            F.when(t["start"] == 0, s["before"]).otherwise(t["before"]).alias("before"),
            F.when(s["start"] + t["end"] == s["end"], s["after"]).otherwise(t["after"]).alias("after")))
        return F.when(s["value"].contains(" ") & partly, tokens).otherwise(F.array(s))

    return F.flatten(beside(runs, base, parts))


def instances(found: Column, base: Column) -> Column:
    """array<struct<start, end, value, kind, patterns>>: identifier-like tokens with their contexts."""
    def words_beside(s: Column) -> Column:
        left = side(s["before"], F.substring(s["before"], -NEAR, NEAR), lambda c: F.substring_index(c, " ", -2))
        right = side(s["after"], F.substring(s["after"], 1, NEAR), lambda c: F.substring_index(c, " ", 1))
        return let(left, lambda words: F.filter(F.array(
            F.concat(F.lit("2:"), F.substring_index(words, " ", -2)), F.concat(F.lit("1:"), F.substring_index(words, " ", -1)),
            F.concat(F.lit("r:"), F.substring_index(right, " ", 1))), lambda c: F.length(c) > 2))

    def of(s: Column, near: Column) -> Column:
        core = F.regexp_extract(s["value"], CORE, 0)
        start = s["start"] + F.position(core, s["value"]) - 1
        # Tokens of one base span are one instance, the whole span.
        seed = F.get(F.filter(near, lambda b: overlaps(b, s["start"], s["end"])), F.lit(0))
        return let(seed, lambda known: F.struct(
            start.alias("start"), (start + F.length(core)).alias("end"),
            F.coalesce(known["value"], core).alias("value"), known["kind"].alias("kind"), words_beside(s).alias("patterns")))

    return beside(found, base, of)


def identifier(value: Column) -> Column:
    """Whether an unseen instance may be marked at all."""
    return value.contains("@") | (F.length(digits(value)) >= MIN_DIGITS)


def scan_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, base, found) of every row."""
    text = docs.select("doc_id", whole_text("text").alias("text"))
    scanned = text.select("doc_id", "text", base_spans(F.col("text")).alias("known"), candidates(F.col("text")).alias("runs"))
    tokens = scanned.withColumn("tokens", parted(F.col("runs"), F.col("known")))
    return tokens.select(
        "doc_id", F.xxhash64("text").alias("text_key"),
        F.transform("known", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("base"),
        instances(F.col("tokens"), F.col("known")).alias("found"))


def score_graph(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence, seeds) from edges (pattern, value, kind), kind null if unseen.

    After ``rounds`` rounds, others follow until one moves no confidence to its next thousandth.
    Confidences only rise from round to round, so that comes about; a pattern that counts at all
    (``SURE / 2``) has at most 0.6 of its instances to win. Sums combine before the shuffle, so a
    very common pattern costs its distinct instances only.
    """
    # An instance that some occurrence shows as a seed is one everywhere.
    edge = stash(edges.groupBy("pattern", "value").agg(F.min("kind").alias("kind")), "pattern-edges")
    size = edge.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"))
    known = edge.filter(F.col("kind").isNotNull()).select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    belief, done, before = known, 0, None
    accepted = (F.col("score") == 1.0) | ((F.col("score") >= SURE) & identifier(F.col("value")))
    # Half a thousandth off, as exact shares are common and sums of parts aren't exact.
    level = F.sum(F.floor(F.col("confidence") * 1000 + 0.5))
    while True:
        sums = edge.select("pattern", "value").join(belief, "value").groupBy("pattern", "kind").agg(
            F.sum("score").alias("weight"), F.count(F.when(accepted, 1)).alias("seeds"))
        patterns = stash(sums.join(size, "pattern").select(
            "pattern", "kind", F.try_divide("weight", "size").alias("confidence"), "seeds"), "pattern-scores")
        now = patterns.agg(level, F.sum("seeds")).first()
        done += 1
        if done >= rounds and now == before:
            return patterns
        before = now
        good = patterns.filter((F.col("confidence") >= SURE / 2) & (F.col("seeds") >= MIN_SEEDS))
        unseen = edge.select("pattern", "value").join(known.select("value"), "value", "left_anti")
        guess = unseen.join(good, "pattern").groupBy("value", "kind").agg(F.max("confidence").alias("score"))
        # A guess is never as sure as a seed; from SURE on it supports patterns in the next round.
        belief = stash(known.union(guess.withColumn("score", F.least("score", F.lit(0.999)))), "beliefs")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans with those found by context.

    A span found by context has its kind with ``context_`` in front.
    """
    scanned = stash(scan_texts(docs), "pii-scan")
    occurrence = scanned.filter(F.size("found") > 0).select(
        "doc_id", "text_key", F.explode("found").alias("o")).select("doc_id", "text_key", "o.*")
    edges = occurrence.select(F.explode("patterns").alias("pattern"), "value", "kind")
    sure = score_graph(edges).filter((F.col("confidence") >= SURE) & (F.col("seeds") >= MIN_SEEDS))
    unseen = occurrence.filter(F.col("kind").isNull() & identifier(F.col("value")))
    hits = unseen.select("doc_id", "text_key", "start", "end", F.explode("patterns").alias("pattern")).join(
        sure.select("pattern", F.col("kind"), "confidence"), "pattern")
    best = hits.groupBy("doc_id", "text_key", "start", "end").agg(
        F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
    added = best.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.collect_set(F.struct(F.concat(F.lit("context_"), "kind").alias("kind"), "start", "end")).alias("added"))
    rows = scanned.join(added, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")

    order = F.create_map(*reduce(
        lambda out, k: [*out, F.lit(k[1]), F.lit(k[0])], enumerate([*KINDS, *(f"context_{k}" for k in KINDS)]), []))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text_of(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    more = F.transform(
        F.array_sort(F.transform(
            F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>")),
            lambda s: F.struct(F.element_at(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(text_of(F.col("base")), 256).alias("base_sha256"),
        text_of(F.concat("base", more)).alias("spans"))
