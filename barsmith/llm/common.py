"""Helpers the training-data operators share: reading, lineage cuts, words, bound expressions."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.session import shared_dir

#: White space of the word definition: space and U+0009 to U+000D.
WORD = r"[^ \t-\r]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns or ("doc_id", "text"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares; gone when the driver's JVM ends.

    Only a session whose tasks all run on the driver's machine may do without a shared folder.
    """
    base = shared_dir(spark, unset="")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/llm-{name}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.

    Lost executors cost only the tasks they ran; what was written stays readable.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once the session's Python workers can import this package.

    Functions that run in tasks are found by module name, so executors get the package's
    sources as an archive, also those that join later.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), f"{root.name}-{uuid.uuid4().hex}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(root.rglob("*.py")):
                out.write(source, source.relative_to(root.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    return df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def whole_text(text: Column | str) -> Column:
    """A text; the empty one where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
