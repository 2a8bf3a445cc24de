"""Quality rules: a threshold table compiled into one projection.

Measures of a text are column expressions over its words and lines; a rule bounds one measure.
``compile_rules`` turns the table into one struct of booleans, so all rules cost one scan and
no shuffle, and no user function runs. Repeated windows are found inside the row: windows are
hashed, sorted with their places, and neighbours of equal hash are compared word by word.

Defined cases: a null text counts as empty; an empty text has zero of everything and fails the
base rule; ratios of texts without words or lines are 0. Rows pass through one to one, so
repeated rows, null ids and further columns change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, whole_text, words

#: Words so common that running prose of the language has many of them (fixed values).
STOP_WORDS = (
    "the of and to in is that for it with as was on are this be at by from or an "
    "der die das und in zu den von mit ist im nicht ein eine auf sich für "
    "le la les de des et en un une du que qui dans pour par sur au avec pas "
    "el los las y que con para se del su al lo como más por"
).split()


@dataclass(frozen=True)
class Rule:
    """Bounds of one measure, both inclusive; None leaves a side open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: The production table. Bounds leave wide room around running prose of any of the languages.
RULES = (
    Rule("word_count", "n_words", low=20),
    Rule("repeated_windows", "repeat_ratio", high=0.30),
    Rule("mean_word_length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbol_ratio", high=0.10),
    Rule("shouting", "bang_ratio", high=0.10),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("repeated_words", "repeat_neighbour_ratio", high=0.25),
    Rule("repeated_lines", "dup_line_ratio", high=0.50),
)
#: The two rules that every caller's table shares.
BASE = ("word_count", "repeated_windows")
WINDOW = 8


def repeated_words(found: Column, width: int = WINDOW) -> Column:
    """How many words lie in a ``width``-word window that occurs twice or more."""
    n = F.size(found)
    starts = F.sequence(F.lit(0), n - width)

    def covered(at: Column) -> Column:
        # Sorted starts: each covers its window up to the next start.
        step = F.aggregate(
            at, F.struct(F.lit(-width).alias("last"), F.lit(0).alias("sum")),
            lambda acc, p: F.struct(
                p.alias("last"), (acc["sum"] + F.least(F.lit(width), p - acc["last"])).alias("sum")),
        )
        return step["sum"]

    def places(ordered: Column) -> Column:
        pairs = F.filter(
            F.zip_with(
                F.slice(ordered, F.lit(1), F.size(ordered) - 1), F.slice(ordered, F.lit(2), F.size(ordered)),
                lambda a, b: F.when(
                    (a["h"] == b["h"])
                    & (F.slice(found, a["p"] + 1, F.lit(width)) == F.slice(found, b["p"] + 1, F.lit(width))),
                    F.array(a["p"], b["p"]))),
            lambda x: x.isNotNull())
        return F.array_sort(F.array_distinct(F.flatten(pairs)))

    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(found, i + 1, F.lit(width))))

    def from_hashes(hs: Column) -> Column:
        keyed = F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return F.when(F.size(F.array_distinct(hs)) < F.size(hs),
                      let(F.array_sort(keyed), lambda o: covered(places(o)))).otherwise(0)

    return F.when(n > width, let(hashes, from_hashes)).otherwise(0)


def measured(text: Column | str) -> Column:
    """A struct of all measures of a text."""

    def of_words(found: Column, t: Column) -> Column:
        n = F.size(found)
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
        neighbours = F.zip_with(F.slice(found, F.lit(2), F.greatest(n - 1, F.lit(0))), found, lambda a, b: a == b)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(found, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(
                F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            repeated_words(found).cast("long").alias("n_repeat_words"),
            (F.length(t) - F.length(F.replace(t, F.lit("!!"), F.lit("!")))).alias("bangs"),
            F.size(F.filter(found, lambda w: F.lower(w).isin(*STOP_WORDS))).alias("stops"),
            F.size(F.filter(neighbours, lambda x: x)).alias("same_as_last"),
        )

    return let(whole_text(text), lambda t: let(words(t), lambda w: of_words(w, t)))


def measures(df: DataFrame, text: str = "text", name: str = "_m") -> DataFrame:
    """Add the struct of all measures as ``name``; other columns stay as they are."""
    return df.withColumn(name, measured(text))


def ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def measure(name: str, m: Column) -> Column:
    n = m["n_words"]
    return {
        "n_words": n,
        "repeat_ratio": ratio(m["n_repeat_words"], n),
        "mean_word_chars": ratio(m["word_chars"], n),
        "symbol_ratio": ratio(m["n_symbols"], n),
        "bang_ratio": ratio(m["bangs"], n),
        "stop_word_ratio": ratio(m["stops"], n),
        "repeat_neighbour_ratio": ratio(m["same_as_last"], n),
        "dup_line_ratio": ratio(m["lines"]["dup"], m["lines"]["n"]),
    }[name]


def passes(rule: Rule, m: Column) -> Column:
    """Whether the measure is within its bounds; integers where the rule is exact in them."""
    if rule.measure == "repeat_ratio":
        return F.lit(100) * m["n_repeat_words"] <= F.lit(round(100 * rule.high)) * m["n_words"]
    value, good = measure(rule.measure, m), F.lit(True)
    if rule.low is not None:
        good = good & (value >= rule.low)
    if rule.high is not None:
        good = good & (value <= rule.high)
    return good


def compile_rules(rules: tuple[Rule, ...], m: Column) -> Column:
    """The table as one struct: a boolean for each rule, true where it holds."""
    return F.struct(*(passes(r, m).alias(r.name) for r in rules))


def apply_rules(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Every row with its counts, ``base_failed``, ``kept`` and the names of failed rules."""
    # Two working columns under names that the table doesn't have, in whatever case.
    taken = {c.lower() for c in df.columns}
    m_name, ok_name = (next(n for n in (stem + "_" * k for k in range(len(taken) + 1)) if n not in taken) for stem in ("_m", "_ok"))
    m, ok = F.col(f"`{m_name}`"), F.col(f"`{ok_name}`")
    out = measures(df, text, m_name).withColumn(ok_name, compile_rules(rules, m))
    base = [r.name for r in rules if r.name in BASE]
    failed = F.filter(F.array(*(F.when(~ok[r.name], F.lit(r.name)) for r in rules)), lambda x: x.isNotNull())
    made = {
        **{c: m[c] for c in ("n_words", "word_chars", "n_symbols")},
        "n_dup_lines": m["lines"]["dup"],
        "n_repeat_words": m["n_repeat_words"],
        "base_failed": F.exists(F.array(*(~ok[n] for n in base)), lambda x: x),
        "kept": F.forall(F.array(*(ok[r.name] for r in rules)), lambda x: x),
        "failed_rules": F.array_join(failed, ","),
    }
    keep = [F.col(f"`{c}`") for c in df.columns if c not in made]
    return out.select(*keep, *(v.alias(k) for k, v in made.items()))


def keep_passing(df: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that every rule accepts, with their columns as they were.

    One expression: a filter on a column of measures would be pushed below it and compute them
    anew for each rule.
    """
    return df.filter(let(measured(text), lambda m: F.forall(F.array(*(passes(r, m) for r in rules)), lambda x: x)))
