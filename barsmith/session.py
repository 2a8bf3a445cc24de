"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "barsmith", master: str | None = None, **conf: str) -> SparkSession:
    """Create or fetch a session with UTC time and adaptive execution.

    Shuffle parallelism is left to the cluster: adaptive execution coalesces small
    partitions and splits skewed ones, so no partition count is fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Plans here have many columns; recording a call site for each doubles build time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates and buckets are UTC; a session made elsewhere may follow its host."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, unset: str) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``unset`` is used only where the cluster names none, which is the case in tests.
    """
    return spark.conf.get("spark.checkpoint.dir", None) or unset
