"""Ordered windows over long series, split so that no series needs a single task.

A rolling frame of n rows needs the n-1 rows before it and nothing else. A series is
therefore cut into calendar segments, and each segment is given copies of the rows that
precede it (its context). Windows then partition by key *and* segment, so one symbol with a
third of all rows spreads over as many tasks as it has segments, and the result equals the
uncut window row for row. The series must be unique in its order column, as candles and bars
are: a segment of ``rows`` steps then holds at most ``rows`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Steps of the series per segment: half a year of one-minute candles.
SEGMENT_ROWS = 1 << 18
# Rows per block of an exponential average: (1 - alpha) ** -BLOCK must stay a finite double.
BLOCK = 256

SEGMENT, CONTEXT = "_segment", "_context"

Stage = Callable[[WindowSpec], Mapping[str, Column]]


def _segment_of(order: str, step: Column | int, rows: int) -> Column:
    width = (F.lit(step) if isinstance(step, int) else step) * F.lit(rows)
    return F.floor(F.unix_seconds(F.col(order)) / width)


def with_context(
    df: DataFrame, keys: Sequence[str], order: str, step: Column | int, before: int,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Tag rows with their segment and add each segment's preceding ``before`` rows.

    Only the last ``before`` rows of a segment can be context for a later one. They are found
    by a row number with a limit, which Spark also applies before the shuffle, and within
    them a row serves every later segment that starts fewer than ``before`` + 1 rows on.
    """
    own = df.withColumn(SEGMENT, _segment_of(order, step, rows))
    newest_first = Window.partitionBy(*keys, SEGMENT).orderBy(F.col(order).desc())
    tails = (
        own.withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= before)
        .drop("_rank")
    )
    following = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, before)
    context = (
        tails.withColumn("_next", F.collect_set(SEGMENT).over(following))
        .withColumn(SEGMENT, F.explode(F.array_remove("_next", F.col(SEGMENT))))
        .drop("_next")
    )
    return own.withColumn(CONTEXT, F.lit(False)).unionByName(
        context.withColumn(CONTEXT, F.lit(True))
    )


def over_series(
    df: DataFrame, keys: Sequence[str], order: str, step: Column | int, before: int,
    *stages: Stage, rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add rolling columns. Each stage may use the columns of the stage before it.

    Stages share one partitioning and one order, hence one exchange and one sort. Columns
    whose name starts with ``_`` are working columns and are dropped. ``before`` must cover
    the frames of all stages added up.
    """
    parts = with_context(df, keys, order, step, before, rows)
    window = Window.partitionBy(*keys, SEGMENT).orderBy(order)
    for stage in stages:
        parts = parts.withColumns(dict(stage(window)))
    kept = parts.filter(~F.col(CONTEXT))
    return kept.drop(*[name for name in kept.columns if name.startswith("_")])


def with_totals_before(
    df: DataFrame, keys: Sequence[str], order: str, step: Column | int,
    totals: Mapping[str, Column], rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add the segment and, for each aggregate, its total over all earlier segments.

    The totals table has one row per key and segment, so its window stays small.
    """
    own = df.withColumn(SEGMENT, _segment_of(order, step, rows))
    earlier = (
        Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = own.groupBy(*keys, SEGMENT).agg(*[c.alias(name) for name, c in totals.items()])
    sums = sums.select(
        *keys, SEGMENT,
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals],
    )
    return own.join(sums, [*keys, SEGMENT])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: str, step: Column | int, value: str, name: str,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Cumulative sum over the whole series: sum within the segment plus earlier totals."""
    parts = with_totals_before(df, keys, order, step, {"_before": F.sum(value)}, rows)
    so_far = (
        Window.partitionBy(*keys, SEGMENT).orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return parts.withColumn(name, F.col("_before") + F.sum(value).over(so_far)).drop(
        SEGMENT, "_before"
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: str, step: Column | int, name: str,
    rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Add the row's dense position in its series, from 0."""
    parts = with_totals_before(df, keys, order, step, {"_before": F.count(F.lit(1))}, rows)
    window = Window.partitionBy(*keys, SEGMENT).orderBy(order)
    return parts.withColumn(name, F.col("_before") + F.row_number().over(window) - 1).drop(
        SEGMENT, "_before"
    )


def _blocks_to_underflow(decay: float) -> int:
    """Blocks after which a carried value is multiplied by less than any double."""
    blocks, weight = 1, decay**BLOCK
    while weight > 0.0:
        blocks, weight = blocks + 1, weight * decay**BLOCK
    return blocks


def _shrinking_sum(shrink: float):
    return lambda carry, end: carry * F.lit(shrink) + end


def exponential_means(
    df: DataFrame, keys: Sequence[str], position: str,
    means: Mapping[str, tuple[Column, float]],
) -> DataFrame:
    """Exponentially weighted means: y = alpha * x + (1 - alpha) * previous y, first y = x.

    ``position`` is the dense position of the row in its series. The recurrence is unrolled
    into sums, so all of it stays in Spark's own operators: within a block of 256 rows the
    mean is a running sum of weighted inputs, and the block's last value is carried into
    later blocks. A carry shrinks by (1 - alpha) ** 256 per block and reaches zero in double
    arithmetic after a fixed number of blocks, so the carried part is a short rolling frame
    over the block ends instead of a scan of the whole series.
    """
    block, offset = F.floor(F.col(position) / BLOCK), F.pmod(F.col(position), F.lit(BLOCK))
    so_far = (
        Window.partitionBy(*keys, "_block").orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = df.withColumns({"_block": block, "_offset": offset.cast("double")})
    local = {}
    for name, (value, alpha) in means.items():
        decay = F.lit(1.0 - alpha)
        share = F.when(F.col(position) == 0, value).otherwise(value * alpha)
        local[f"_local_{name}"] = F.pow(decay, F.col("_offset")) * F.sum(
            share * F.pow(decay, -F.col("_offset"))
        ).over(so_far)
    rows = rows.withColumns(local)

    # The carry into a block: the ends of the blocks before it, nearest weighted most.
    reach = max(_blocks_to_underflow(1.0 - alpha) for _, alpha in means.values())
    ends = rows.filter(F.col("_offset") == BLOCK - 1).select(*keys, "_block", *local)
    group = F.floor(F.col("_block") / SEGMENT_ROWS)
    reaching = F.floor((F.col("_block") + reach) / SEGMENT_ROWS)
    ends = ends.withColumn("_group", F.explode(F.sequence(group, reaching)))
    frame = Window.partitionBy(*keys, "_group").orderBy("_block").rowsBetween(1 - reach, 0)
    carries = ends.withColumns(
        {
            f"_carry_{name}": F.aggregate(
                F.collect_list(f"_local_{name}").over(frame),
                F.lit(0.0),
                _shrinking_sum((1.0 - alpha) ** BLOCK),
            )
            for name, (_, alpha) in means.items()
        }
    )
    carries = carries.filter(F.col("_group") == group).select(
        *keys, (F.col("_block") + 1).alias("_block"), *[f"_carry_{name}" for name in means]
    )
    result = rows.join(carries, [*keys, "_block"], "left").withColumns(
        {
            name: F.col(f"_local_{name}")
            + F.pow(F.lit(1.0 - alpha), F.col("_offset") + 1)
            * F.coalesce(F.col(f"_carry_{name}"), F.lit(0.0))
            for name, (_, alpha) in means.items()
        }
    )
    return result.drop(*[c for c in result.columns if c.startswith("_") and c != position])
