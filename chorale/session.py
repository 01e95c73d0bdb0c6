"""Session defaults and the two ways work is handed between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "chorale", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="chorale-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def allow_checkpoints(spark: SparkSession) -> None:
    """Let fits that cut their lineage do so in the shared folder, also where only the session names it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/chorale/{name}-{uuid.uuid4().hex}"


# Spark then removes a query's shuffle files when the query has ended.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage in a form that outlives executors, and lets the passes
    that follow read only the columns they need. The shuffles behind it go as
    soon as it is written, not when the driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    before = conf.get(SWEEP, None)
    conf.set(SWEEP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(SWEEP) if before is None else conf.set(SWEEP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A table with at most this many rows may be copied to every executor.
SMALL_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Return ``df`` ready to be the small side of a join.

    The rows are counted while they are fetched: up to ``max_rows`` they become
    a local table with a broadcast hint; beyond it the original plan comes back
    unhinted, so the join shuffles (and adaptive skew handling applies).
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
