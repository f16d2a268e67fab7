"""Session settings and the shared folder that durable intermediate tables use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small join sides are broadcast by measured size, up to 100 MB.
    "spark.sql.autoBroadcastJoinThreshold": "100MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "100MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the call site of every column expression makes building large plans slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "weekloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's defaults; keyword settings use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="weekloom-")
    context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """Unused path for one written table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/weekloom/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Materialize to the shared folder: reused without recomputation, safe if executors go."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet and read back, so later scans prune columns and push filters."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
