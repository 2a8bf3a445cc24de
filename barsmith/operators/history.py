"""History rows joined to a batch, merges by key, and unions of differing layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of a batch; joined, never collected."""
    return batch.select(*keys).distinct()


def history_without_batch(
    history: DataFrame, batch: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """History rows whose key the batch does not bring again."""
    return history.join(batch.select(*keys).distinct(), list(keys), "left_anti")


def latest_before(
    history: DataFrame, batch: DataFrame, keys: Sequence[str], order: str, n: int
) -> DataFrame:
    """The last ``n`` history rows of each key, strictly before the batch's first row."""
    starts = batch.groupBy(*keys).agg(F.min(order).alias("_first"))
    older = history.join(starts, list(keys)).filter(F.col(order) < F.col("_first")).drop("_first")
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return (
        older.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )


def union_by_name(new: DataFrame, old: DataFrame, flag: str = "is_new") -> DataFrame:
    """Both sides with a flag telling new rows from old; columns either side lacks are NULL."""
    return new.withColumn(flag, F.lit(True)).unionByName(
        old.withColumn(flag, F.lit(False)), allowMissingColumns=True
    )


def merged_by_key(
    versions: DataFrame, keys: Sequence[str], version: str, insert_only: Sequence[str]
) -> DataFrame:
    """Fold batch versions of a table into one row per key.

    Columns in ``insert_only`` keep the value the key was first inserted with, all others
    take the latest version's. An aggregate rather than a window: each task folds its
    versions of a key before the shuffle, in a hash aggregate where all columns are numbers
    or times.
    """
    kept = [c for c in versions.columns if c not in (*keys, version)]
    pick = {c: F.min_by if c in insert_only else F.max_by for c in kept}
    merged = versions.groupBy(*keys).agg(*[pick[c](F.col(c), F.col(version)).alias(c) for c in kept])
    return merged.select(*[c for c in versions.columns if c != version])
