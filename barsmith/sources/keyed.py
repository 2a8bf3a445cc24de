"""Keyed tables that stay small to read: segments that are replaced whole, and a manifest of them.

A segment is a function of the key, so a key never moves. A batch folds its rows into the
segments that they touch and writes those anew; the others keep their files. A manifest, one
small JSON file for each batch, names every segment's folder. It is written under another name
and renamed, which moves all readers from one state to the next at once: a reader lists no data
folders, and opens as many files as there are segments, however many batches there were.

A batch that runs again after its manifest is there changes nothing; one that failed before that
writes its segments again. The last ``kept`` states stay readable, which a replay of the last
batch needs; what only older ones name is deleted.

What a batch costs is the size of the segments it touches. Segments should therefore be bounded in
time, as ``bar_segment`` does: a bar's segment has up to ``SEGMENT_BARS`` bars of each symbol in
one hash bucket. The manifest grows with the number of segments, not with rows or batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import interval_seconds
from ..operators.history import merged_by_key
from .tables import BATCH, exists

SEGMENT = "_segment"
VERSION = "_version"
#: Bars of a symbol and timeframe in one segment.
SEGMENT_BARS = 96


def bar_segment(buckets: int = 8) -> Column:
    """Timeframe, stretch of ``SEGMENT_BARS`` bars and hash bucket of the symbol."""
    length = interval_seconds(F.col("timeframe")) * SEGMENT_BARS
    stretch = F.floor(F.unix_seconds("window_start") / length)
    return F.concat_ws("-", "timeframe", stretch.cast("string"), F.pmod(F.xxhash64("symbol"), F.lit(buckets)).cast("string"))


def day_segment(column: str) -> Column:
    return F.coalesce(F.date_format(column, "yyyyMMdd"), F.lit("none"))


@dataclass(frozen=True)
class KeyedTable:
    """A table with one row for each key; ``segment`` gives the column that names a row's segment."""

    path: str
    schema: str
    key: tuple[str, ...]
    segment: Callable[[], Column]
    insert_only: tuple[str, ...] = ()
    kept: int = 3

    # ---- states --------------------------------------------------------------------------

    def _files(self, spark: SparkSession):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, spark: SparkSession, *parts: str):
        return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def states(self, spark: SparkSession) -> list[int]:
        """The batches whose state can be read, in ascending order."""
        if not exists(spark, f"{self.path}/manifest"):
            return []
        names = [s.getPath().getName() for s in self._files(spark).listStatus(self._at(spark, "manifest"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", ".")))

    def manifest(self, spark: SparkSession, before: int | None = None) -> dict[str, str]:
        """Folder by segment in the last state, or the last one below batch ``before``."""
        known = [n for n in self.states(spark) if before is None or n < before]
        if not known:
            return {}
        text = spark.read.text(f"{self.path}/manifest/{known[-1]:020d}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _publish(self, spark: SparkSession, batch_id: int, segments: dict[str, str]) -> None:
        files = self._files(spark)
        draft, final = (self._at(spark, "manifest", f"{p}{batch_id:020d}.json") for p in ("_", ""))
        out = files.create(draft, True)
        try:
            out.write(bytearray(json.dumps(segments, sort_keys=True).encode()))
        finally:
            out.close()
        if not files.rename(draft, final):
            raise RuntimeError(f"state {batch_id} of {self.path} could not be published")

    def _forget(self, spark: SparkSession) -> None:
        """Delete the states before the last ``kept``, and the folders that only they name."""
        states = self.states(spark)
        old, kept = states[: -self.kept], states[-self.kept:]
        if not old:
            return
        files = self._files(spark)
        used = {folder for n in kept for folder in self.manifest(spark, n + 1).values()}
        for n in old:
            for folder in self.manifest(spark, n + 1).values():
                if folder not in used:
                    files.delete(self._at(spark, folder), True)
            files.delete(self._at(spark, "manifest", f"{n:020d}.json"), False)

    # ---- rows ----------------------------------------------------------------------------

    def _load(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in sorted(folders)))

    def read(
        self, spark: SparkSession, before: int | None = None, wanted: Callable[[str], bool] | None = None
    ) -> DataFrame:
        """The current rows, or those before a batch; ``wanted`` chooses segments by name."""
        found = self.manifest(spark, before)
        return self._load(spark, [f for s, f in found.items() if wanted is None or wanted(s)])

    def apply(self, rows: DataFrame, batch_id: int) -> list[str]:
        """Insert or replace the batch's rows by key; returns the segments written."""
        spark = rows.sparkSession
        if any(n >= batch_id for n in self.states(spark)):
            return []
        found = self.manifest(spark, batch_id)
        names = self._load(spark, []).columns
        new = rows.select(*names)
        # As many names as the batch touches segments.
        touched = sorted(r[0] for r in new.select(self.segment()).distinct().collect())
        stored = self._load(spark, [found[s] for s in touched if s in found])
        versions = new.withColumn(VERSION, F.lit(1)).union(stored.withColumn(VERSION, F.lit(0)))
        folded = merged_by_key(versions, self.key, VERSION, self.insert_only).select(*names, self.segment().alias(SEGMENT))
        folder = f"data/{BATCH}={batch_id}"
        (folded.hint("rebalance", SEGMENT).sortWithinPartitions(SEGMENT, *self.key)
         .write.mode("overwrite").partitionBy(SEGMENT).parquet(f"{self.path}/{folder}"))
        self._publish(spark, batch_id, found | {s: f"{folder}/{SEGMENT}={s}" for s in touched})
        self._forget(spark)
        return touched
