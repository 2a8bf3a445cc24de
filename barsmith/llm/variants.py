"""Spelling variants by permuterm rotations.

Every word gets a terminator, and all rotations of the result are sorted. The rotation that
starts right behind a word's i-th character ends with that character: without its last place it
is what the word looks like when that character is skipped, and a word that lacks it altogether
has the same string as a whole rotation. So each rotation is filed twice, whole and without its
last character, and each range of equal strings holds words that are near each other: those that
skip differ by a replacement, and the one word that is whole by an insertion. Such a range has at
most one word for each character, so scanning it is bounded.

Scanning a range doesn't list its pairs: it counts the words that are near and takes the two most
frequent, of which a word's neighbour is the first that is not itself. A pair that differs by one
of several equal characters in a row shares several ranges; it is counted where the first of the
row is skipped.

A rotation is as long as its word, so long words are filed under hashes of their rotations modulo
a prime of 127 bits, computed from the hashes of the word's prefixes in one step each, and travel
as numbers in their sorted order. That keeps the work in proportion to the text however long a
word is. Words of exactly ``LONGEST`` characters are filed both ways, whole rotations only under
hashes, so that no pair is lost or counted twice.

Words follow their forms to the last by doubling jumps. A form has at least ten times the count,
so chains are short and rounds few.

Defined cases: null and empty texts have no words, a null doc_id is written as nothing in a run's
checksum; repeated rows count again; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shipped, stash, whole_text

RUN = r"[A-Za-zÀ-ÿ]+"
LETTERS, OCCURRENCES, TIMES = 7, 2, 10
#: Of the runs, one in so many loses a character.
SPOILED = 31
#: Ends a word; no run has it.
END = "$"
#: Characters up to which a word's rotations are sorted as texts.
LONGEST = 64
PRIME, BASE = (1 << 127) - 1, 0x5DEECE66D2B79F3A1C0FB5E1D4A9D6C7
#: Rows a task hands over at once.
ROWS = 1 << 15

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the distinct words of all texts and their occurrences."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(whole_text("text"), F.lit(RUN), F.lit(0))).alias("run"))
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = runs.select("doc_id", lowered.alias("run")).select("run", F.crc32(F.encode(named, "UTF-8")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    spoiled = F.concat(F.substring("run", F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.col("h") % SPOILED == 0, spoiled).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).filter(F.length("word") >= LETTERS).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= OCCURRENCES)


def rotations(counted: DataFrame) -> DataFrame:
    """(key, word, n, skipped, first): every rotation of a word, whole and without its last character.

    ``skipped`` is null for whole rotations; ``first`` tells whether the skipped character is the
    first of a row of equal ones.
    """
    letter = F.substring(F.col("word"), F.col("i"), F.lit(1))
    behind = F.substring(F.col("word"), F.col("i") + 1, F.length("word"))
    before = F.substring(F.col("word"), F.lit(1), F.col("i") - 1)
    turned = counted.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i")).select(
        "word", "n", F.when(F.col("i") > 0, letter).alias("letter"),
        F.when(F.col("i") > 0, F.concat(behind, F.lit(END), before)).alias("short"),
        F.when(F.col("i") > 0, F.concat(behind, F.lit(END), before, letter)).otherwise(
            F.concat("word", F.lit(END))).alias("whole"),
        ((F.col("i") == 1) | (F.substring(F.col("word"), F.col("i") - 1, F.lit(1)) != letter)).alias("first"))
    filed = F.array(
        F.struct(F.col("whole").alias("key"), F.lit(None).cast("string").alias("skipped"), F.lit(False).alias("first")),
        F.struct(F.col("short").alias("key"), F.col("letter").alias("skipped"), "first"))
    return turned.select("word", "n", F.explode(filed).alias("r")).select("r.key", "word", "n", "r.skipped", "r.first").filter(
        F.col("key").isNotNull())


def hashed_rotations(numbered: DataFrame) -> DataFrame:
    """The same of (word, number, n) for long words: hashes as keys and numbers for the words."""

    def of_word(word: str) -> Iterator[tuple[str, str | None, bool]]:
        codes = word.encode("latin-1")
        prefix, power = [0], [1]
        for c in codes:
            prefix.append((prefix[-1] * BASE + c) % PRIME)
            power.append(power[-1] * BASE % PRIME)
        size, end = len(codes), ord(END)
        yield format((prefix[size] * BASE + end) % PRIME, "x"), None, False
        for i, c in enumerate(codes):
            behind = prefix[size] - prefix[i + 1] * power[size - i - 1]
            short = ((behind * BASE + end) * power[i] + prefix[i]) % PRIME
            yield format((short * BASE + c) % PRIME, "x"), None, False
            if size > LONGEST:
                yield format(short, "x"), chr(c), i == 0 or codes[i - 1] != c

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), schema.types)], schema=schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, number, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = []
                for key, skipped, first in of_word(word):
                    found.append((key, number, n, skipped, first))
                    if len(found) == ROWS:
                        yield table(found)
                        found = []
                if found:
                    yield table(found)

    schema = pa.schema([("key", pa.string()), ("word", pa.int64()), ("n", pa.int64()), ("skipped", pa.string()), ("first", pa.bool_())])
    return shipped(numbered).select("word", "number", "n").mapInArrow(
        rows, "key string, word long, n long, skipped string, first boolean")


def scanned(rotated: DataFrame) -> DataFrame:
    """(word, near, form_n, form): of each range of equal keys, what it adds to each of its words."""
    of_key = Window.partitionBy("key")
    best = of_key.orderBy(F.col("n").desc(), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    skips = F.col("skipped").isNotNull()
    near = F.when(skips, F.col("n_skips") - 1 + F.when(F.col("first"), F.col("n_whole")).otherwise(0)).otherwise(F.col("n_first"))
    own = F.col("best_word") == F.col("word")
    return (
        rotated.withColumns({
            "n_skips": F.count_if(skips).over(of_key), "n_whole": F.count_if(~skips).over(of_key),
            "n_first": F.count_if(F.col("first")).over(of_key),
            "best_word": F.first("word").over(best), "best_n": F.first("n").over(best),
            "next_word": F.nth_value("word", 2).over(best), "next_n": F.nth_value("n", 2).over(best)})
        .filter(F.col("next_word").isNotNull())
        .select("word", near.alias("near"), F.when(own, F.col("next_n")).otherwise(F.col("best_n")).alias("form_n"),
                F.when(own, F.col("next_word")).otherwise(F.col("best_word")).alias("form")))


def neighbours(counted: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) of the words that have near ones; the most frequent of them is ``form``."""
    short = scanned(rotations(counted.filter(F.length("word") <= LONGEST)))
    # Sorted first, so that the numbers are in the order of the words.
    long = counted.filter(F.length("word") >= LONGEST).orderBy("word")
    numbered = stash(long.withColumn("number", F.monotonically_increasing_id()), "long-words")
    name, form = numbered.select(F.col("number").alias("word"), F.col("word").alias("text")), F.col("form_text")
    far = scanned(hashed_rotations(numbered)).join(name, "word").join(name.toDF("form", "form_text"), "form")
    far = far.select(F.col("text").alias("word"), "near", "form_n", form.alias("form"))
    most = F.min(F.struct((-F.col("form_n")).alias("minus"), "form"))
    return short.union(far).groupBy("word").agg(F.sum("near").alias("n_near"), most.alias("most")).select(
        "word", "n_near", (-F.col("most.minus")).alias("form_n"), F.col("most.form").alias("form"))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, root) for (word, form); ``longest`` bounds the forms that follow on each other."""
    steps = forms.select("word", F.col("form").alias("root"))
    jump = 1
    while jump < longest:
        far = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        steps = stash(steps.join(far, "root", "left").select("word", F.coalesce("far", "root").alias("root")), "roots")
        jump *= 2
    return steps


def group_variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the documents."""
    counted = stash(words(docs), "words")
    near = stash(neighbours(counted), "near-words")
    accepted = F.col("form_n") >= times * F.col("n")
    known = counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(accepted, F.col("form")).alias("form"), F.when(accepted, F.col("form_n")).alias("form_n"))
    known = stash(known, "word-forms")
    forms = known.filter(F.col("form").isNotNull())
    most, longest = forms.agg(F.max("form_n")).first()[0] or 0, 0
    while most >= OCCURRENCES * times:
        most, longest = most // times, longest + 1
    found = known.join(roots(forms, longest), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
