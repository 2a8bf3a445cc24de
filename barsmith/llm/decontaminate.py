"""Benchmark decontamination by spaced-seed hashing.

A seed hashes the tokens at the set places of a fixed mask and ignores those between them. The
seeds of the test items are joined with the seeds at every token of every training text; each
hit is verified by aligning text and item there: a stretch of ``WINDOW`` tokens around the hit
(the whole item, if shorter) must agree in all but the allowed misses. These are ``MISSES``, and
for items under nine tokens fewer (one from five tokens on, none below), as two misses in
four tokens say nothing.

The two masks together hit every window of 13 tokens with any two substitutions. Items of 5 to 12
tokens get masks of their own: the item is cut into two blocks more than it may miss, and each
mask sets two blocks, so one of them is whole whatever is missed. Masks cost a hash for each token of
all texts; only those that the benchmark's lengths call for are used.

Training texts are scanned once and never shuffled: seeds are made, looked up and verified
within the row, and only verified pairs are grouped. A test seed carries the tokens that its
verification can touch, 25 at most, whatever the item's length. The seeds are broadcast in blocks of
about ``BLOCK_SEEDS``, which even out as each seed is dealt by a hash of item and place; a larger
benchmark takes more passes, not more memory.

Tokens are maximal runs of neither white space nor ASCII punctuation, in lower case. Defined
cases: null and empty texts, and items without a token, match nothing; repeated items count once,
repeated texts give one pair, as do rows without an id (pair with a null doc_id); further columns
are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, whole_text

TOKEN = r"[^\s\p{Punct}]+"
#: Places of the tokens that count; together they withstand any 2 substitutions in 13 tokens.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
WINDOW = 13
MISSES = 2
BLOCK_SEEDS = 250_000
SPAN = max(m[-1] for m in MASKS) + 1


def token_hashes(text: Column) -> Column:
    tokens = F.regexp_extract_all(F.lower(whole_text(text)), F.lit(TOKEN), F.lit(0))
    return F.transform(tokens, lambda w: F.xxhash64(w))


def seeds(tokens: Column, mask: tuple[int, ...], number: int) -> Column:
    """A hash per token, of the tokens that the mask sets from there on."""
    return F.transform(tokens, lambda x, i: F.xxhash64(F.lit(number), x, *(F.get(tokens, i + o) for o in mask[1:])))


def allowed(width, misses: int = MISSES):
    """Misses in a window of that many tokens; ``width`` is a number or a column."""
    if isinstance(width, Column):
        return F.least(F.lit(misses), F.floor(F.lit(misses) * width / SPAN))
    return min(misses, misses * width // SPAN)


def short_masks(n: int, misses: int = MISSES) -> list[tuple[int, ...]]:
    """Masks of which one is untouched by any allowed misses in an item of ``n`` tokens."""
    gone = allowed(n, misses)
    if not gone:
        return [tuple(range(n))]
    edge = [n * k // (gone + 2) for k in range(gone + 3)]
    blocks = [range(a, b) for a, b in zip(edge, edge[1:])]
    shapes = set()
    for x, y in combinations(blocks, 2):
        places = [*x, *y]
        shapes.add(tuple(p - places[0] for p in places))
    return sorted(shapes)


def masks_for(items: DataFrame, window: int = WINDOW, misses: int = MISSES) -> dict[tuple[int, ...], list[int]]:
    """Each mask and the lengths of items, below the window, that it is for; none for the fixed masks."""
    lengths = items.filter(F.size("tokens").between(1, window - 1)).select(F.size("tokens")).distinct().collect()
    masks: dict[tuple[int, ...], list[int]] = {m: [] for m in MASKS}
    for (n,) in sorted(lengths):
        for shape in short_masks(n, misses):
            masks.setdefault(shape, []).append(n)
    return masks


def item_seeds(items: DataFrame, masks: dict[tuple[int, ...], list[int]], window: int = WINDOW) -> DataFrame:
    """(item_id, at, seed, low, n, near) of every complete seed: ``near`` holds the item's tokens from ``low`` on."""
    n = F.size("tokens")
    rows = []
    for k, (mask, lengths) in enumerate(masks.items()):
        fits = n.isin(lengths) if mask not in MASKS else (n >= SPAN) | n.isin(lengths)
        width, at = F.least(F.lit(window), n), F.col("at")
        # Places of the item that a window with the hit's first token can touch.
        low = F.greatest(F.lit(0), at - width + 1)
        rows.append(items.filter(fits).select("item_id", "tokens", F.posexplode(seeds(F.col("tokens"), mask, k)).alias("at", "seed"))
            .filter(at + mask[-1] < n)
            .select("item_id", F.lit(k).alias("mask"), "at", "seed", low.alias("low"), n.alias("n"),
                    F.slice("tokens", low + 1, F.least(n, at + width) - low).alias("near")))
    out = rows[0]
    for more in rows[1:]:
        out = out.union(more)
    return out


def agreement(doc: Column, dpos: Column, window: int, misses: int) -> Column:
    """Most equal tokens in a verified window around the hit; null if none is verified."""
    near, low, width = F.col("near"), F.col("low"), F.least(F.lit(window), F.col("n"))
    first = dpos - F.col("at") + low  # the text's place that faces the first of them
    same = F.transform(
        near, lambda x, i: F.when((first + i >= 0) & (F.get(doc, F.greatest(first + i, F.lit(0))) == x), 1).otherwise(0))

    def best(row: Column) -> Column:
        return F.array_max(F.transform(
            F.sequence(F.lit(1), F.size(row) - width + 1),
            lambda s: F.aggregate(F.slice(row, s, width), F.lit(0), lambda a, x: a + x)))

    found = let(same, best)
    return F.when(found >= width - allowed(width, misses), found)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, misses: int = MISSES,
                  block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """(doc_id, item_id, n_hits, best_match, first_token) of every pair with a verified overlap."""
    items = benchmark.select("item_id", token_hashes(F.col("text")).alias("tokens")).distinct()
    masks = masks_for(items, window, misses)
    total = items.agg(F.sum(F.size("tokens"))).first()[0] or 0
    blocks = max(1, -(-total * len(masks) // block_seeds))
    train = docs.select("doc_id", token_hashes(F.col("text")).alias("tokens"))
    places = train.select(
        "doc_id", "tokens",
        F.posexplode(F.concat(*(seeds(F.col("tokens"), m, k) for k, m in enumerate(masks)))).alias("place", "seed"),
    )
    of_items = item_seeds(items, masks, window)
    found = None
    for block in range(blocks):
        part = of_items if blocks == 1 else of_items.filter(
            F.pmod(F.xxhash64("item_id", "mask", "at", "near"), F.lit(blocks)) == block)
        # About block_seeds rows of at most 25 tokens, see above.
        hits = places.join(F.broadcast(part), "seed")
        dpos = F.col("place") % F.size("tokens")
        checked = hits.select(
            "doc_id", "item_id", dpos.alias("dpos"), agreement(F.col("tokens"), dpos, window, misses).alias("match"),
        ).filter(F.col("match").isNotNull())
        found = checked if found is None else found.union(checked)
    return found.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_hits"), F.max("match").cast("long").alias("best_match"),
        F.min("dpos").cast("long").alias("first_token"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text overlaps no benchmark item; rows without an id are told apart by text."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.encode(whole_text("text"), "UTF-8"))))
    bad = find_overlaps(docs.select(key.alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.withColumn("_key", key).join(bad, F.col("_key") == F.col("_bad"), "left_anti").drop("_key")
