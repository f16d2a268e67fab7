"""Reading declared views and writing feature tables."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..definitions import FeatureView
from .commits import put_if_absent


def scan_view(
    spark: SparkSession, view: FeatureView, columns: Sequence[str] | None = None
) -> DataFrame:
    """Keys, time and the wanted columns, cast to the declared types.

    Only these columns reach the scan. A declared column the source lacks is an error.
    """
    raw = view.source.read(spark)
    ts = view.source.timestamp_field
    types = {f.name: f.dtype for f in view.schema}
    names = list(columns) if columns is not None else list(types)
    missing = [c for c in (*view.join_keys, ts, *names) if c not in raw.columns]
    if missing:
        raise ValueError(f"source {view.source.name} of {view.name} lacks {missing}")
    casts = {k: e.value_type for e in view.entities for k in e.join_keys}
    casts |= {c: types[c] for c in names}
    cast = [f"CAST(`{c}` AS {t.simpleString()}) AS `{c}`" for c, t in casts.items()]
    return raw.selectExpr(*cast, f"`{ts}`").select(*view.join_keys, ts, *names)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` came to its end."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"), "_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where nothing lies; other failures are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def cached_table(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the table at ``path``; build and write it only if no finished one is there.

    What a broken write left behind is written over.
    """
    if not is_written(spark, path):
        df = build()
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return spark.read.parquet(path)


def fingerprint(df: DataFrame) -> str:
    """What a frame depends on, as a digest: its plan and the files that it reads.

    The plan holds views, TTLs, options and columns with their expression ids taken out; of files
    path, length and time count. Files are listed by Spark, one row comes back. In-memory rows
    count by their schema only.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().optimizedPlan().canonicalized().treeString(True, False, 2**31 - 1, False, True)
    digest = hashlib.sha256(plan.encode())
    digest.update(df.schema.json().encode())
    files = df.inputFiles()
    if files:
        listed = spark.read.format("binaryFile").load(files).select("path", "length", "modificationTime")
        one = F.xxhash64("path", "length", "modificationTime")
        row = listed.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime").cast("string"), F.bit_xor(one)).first()
        digest.update(repr(tuple(row)).encode())
    return digest.hexdigest()


def cached(df: DataFrame, folder: str) -> DataFrame:
    """The frame's rows, stored under ``folder`` by its fingerprint; computed if not there yet.

    A changed view, TTL, option or source file gives another fingerprint and so another table; an
    unchanged one is read as it was written. A manifest beside the table says what it was made
    from. Tables that went out of date are left to whoever owns the folder.
    """
    spark, folder = df.sparkSession, folder.rstrip("/")
    key = fingerprint(df)
    path = f"{folder}/{key}"
    if not is_written(spark, path):
        df.write.mode("overwrite").parquet(path)
        manifest = {"fingerprint": key, "columns": df.columns, "files": len(df.inputFiles()), "at": time.time()}
        put_if_absent(spark, f"{folder}/{key}.json", json.dumps(manifest, sort_keys=True))
    return spark.read.schema(df.schema).parquet(path)


def write_if_any(df: DataFrame, path: str) -> bool:
    """Write unless the frame is empty. Computes it twice only up to its first row."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True
