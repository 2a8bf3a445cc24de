"""Layer tables on plain files: batch-numbered appends, read as one table.

Each batch of a layer is a directory ``batch_id=N`` that is written with overwrite, so a batch
that is run again after a failure replaces its own output. A reader sees all batches, or those
before a given one. Formats are Spark data source names, so a table format or a message topic
takes the place of parquet by name and options alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import merged_by_key
from ..operators.resample import GOLD_KEY

BATCH = "batch_id"
LAYERS = ("bronze", "silver", "gold")
# Columns of a bar that keep the value they were first inserted with. The open is not among
# them: a bar is always computed from all its candles, so a late first candle changes it.
GOLD_INSERT_ONLY = ("window_end", "partition_date")


def layer_path(base: str, layer: str, table: str) -> str:
    """Path of a layer's table; an unknown layer falls back to the base path."""
    root = f"{base.rstrip('/')}/{layer}" if layer in LAYERS else base.rstrip("/")
    return f"{root}/{table}"


def checkpoint_path(base: str, job: str) -> str:
    return f"{base.rstrip('/')}/checkpoints/{job}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there: absence means no history, any other error surfaces."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def write_batch(
    df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> None:
    """Write one batch; running it again replaces it."""
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/{BATCH}={batch_id}")


def read_batches(
    spark: SparkSession, path: str, before: int | None = None, schema: str | None = None,
    fmt: str = "parquet",
) -> DataFrame | None:
    """All batches, or those numbered below ``before``; None where there is no table yet.

    With a schema no file is opened to plan the read; without one the batches' own schemas
    are merged, so a column that only later batches have reads as NULL in earlier ones. The
    batch number is a partition column, so the bound prunes directories.
    """
    if not exists(spark, path):
        return None
    reader = spark.read.format(fmt).option("basePath", path)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    df = reader.load(path)
    return df if before is None else df.filter(F.col(BATCH) < before)


def latest_batch(spark: SparkSession, path: str, before: int) -> int | None:
    """Highest batch number below ``before``, from the directory names alone."""
    if not exists(spark, path):
        return None
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(target)]
    numbers = [int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=")]
    return max((n for n in numbers if n < before), default=None)


def keep_last(spark: SparkSession, path: str, batch_id: int, kept: int = 3) -> None:
    """Delete the batches before the last ``kept`` up to ``batch_id`` of a table whose every batch
    is a whole state. The one before ``batch_id`` stays, which a replay of that batch reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return
    for status in files.listStatus(target):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) <= batch_id - kept:
            files.delete(status.getPath(), True)


def read_batch(
    spark: SparkSession, path: str, batch_id: int, schema: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return reader.load(f"{path}/{BATCH}={batch_id}")


def gold_view(versions: DataFrame) -> DataFrame:
    """Current bars: every batch's version of a bar folded by key."""
    return merged_by_key(versions, GOLD_KEY, BATCH, GOLD_INSERT_ONLY)


def compact(spark: SparkSession, view: DataFrame, path: str, partition_by=()) -> None:
    """Write a folded view to a new directory, which readers then switch to."""
    if exists(spark, path):
        raise ValueError(f"compaction target exists: {path}")
    write_batch(view, path, 0, partition_by)


def seed(spark: SparkSession, rules: DataFrame, path: str) -> bool:
    """Write sample rules only where the rule table is absent or empty."""
    present = read_batches(spark, path)
    if present is not None and not present.isEmpty():
        return False
    write_batch(rules, path, 0)
    return True


def publish(messages: DataFrame, fmt: str, **options: str) -> None:
    """Append key/value messages to a sink by format name, such as kafka or json."""
    messages.write.format(fmt).mode("append").options(**options).save()
