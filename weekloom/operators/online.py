"""Latest values per entity: materialization, the online table and keyed lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import typed
from ..session import durable, fresh_path, stored
from .skew import MAX_GROUP_ROWS, left_join

# Partition columns of an online table: how many buckets it has, and the one of a row.
BUCKETS, BUCKET = "key_buckets", "key_bucket"
BUCKET_FIELDS = (T.StructField(BUCKETS, T.IntegerType()), T.StructField(BUCKET, T.IntegerType()))
MIN_BUCKETS = 16
ROWS_PER_BUCKET = 2_000_000
ROW_GROUP_BYTES = 16 << 20
MAX_NAMED = 200


def latest(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    ts: str = "event_timestamp",
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Newest row per key with a time in [start, end]; of equal times the greatest row.

    An aggregate, not a window: each task reduces its rows to one per key before the shuffle.
    Spark sorts for it, as the greatest of structs has no hash aggregate.
    """
    if start is not None:
        df = df.where(F.col(ts) >= typed(start, df.schema[ts].dataType))
    if end is not None:
        df = df.where(F.col(ts) <= typed(end, df.schema[ts].dataType))
    newest = df.dropna(subset=[*keys, ts]).groupBy(*keys).agg(F.max(F.struct(ts, *columns)).alias("r"))
    return newest.select(*keys, *[F.col("r")[c].alias(c) for c in (ts, *columns)])


def merge_latest(current: DataFrame, update: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Upsert: per key the newer of the stored and the fresh row. Repeating it changes nothing."""
    columns = [c for c in update.columns if c not in (*keys, ts)]
    return latest(current.select(update.columns).union(update), keys, columns, ts)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    # Keys as text, so that int and bigint keys of equal value share a bucket.
    typed_keys = [F.col(k).cast("string") for k in keys]
    return F.pmod(F.xxhash64(*typed_keys), F.lit(buckets)).cast("int")


def write_online(
    df: DataFrame, path: str, keys: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET, rows: int | None = None
) -> int:
    """One folder per key bucket, their number growing with the table and kept in the path.

    Keys are unique, so hashing spreads the rows evenly; buckets are sorted by key. ``rows`` is
    about how many there will be, as counted when the table was last written; only a table that
    was never counted is written to the shared folder first. Returns the number of rows.
    """
    if rows is None:
        df = stored(df, "online-rows")
        rows = df.count()
    buckets = max(MIN_BUCKETS, -(-rows // rows_per_bucket))
    _writer(df, keys, buckets, rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()  # from the footers


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    placed = df.withColumns({BUCKETS: F.lit(buckets), BUCKET: key_bucket(keys, buckets)})
    return placed.repartitionById(buckets, BUCKET).sortWithinPartitions(BUCKET, *keys)


def _writer(df: DataFrame, keys: Sequence[str], buckets: int, rows: int) -> DataFrameWriter:
    """Sorted buckets in small row groups with Bloom filters on the keys: a read of few keys skips most."""
    writer = _bucketed(df, keys, buckets).write.partitionBy(BUCKETS, BUCKET).option("parquet.block.size", ROW_GROUP_BYTES)
    for k in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true").option(
            f"parquet.bloom.filter.expected.ndv#{k}", str(max(1, rows // buckets))
        )
    return writer


def stage_upsert(current: DataFrame, fresh: DataFrame, keys: Sequence[str], ts: str) -> tuple[str, int]:
    """Write the new content of the buckets that ``fresh`` touches; (path, rows of ``fresh``).

    ``fresh`` holds the newest row of each key it has. Only the touched buckets of the online
    table ``current`` are read; bucket numbers reach the driver. ``current`` must have rows.
    """
    buckets = current.select(BUCKETS).first()[0]
    fresh = stored(fresh.withColumn(BUCKET, key_bucket(keys, buckets)), "fresh-rows")
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
    fresh = fresh.drop(BUCKET)
    old = current.where(F.col(BUCKET).isin(touched)).select(fresh.columns)
    path = fresh_path(current.sparkSession, "upsert")
    _bucketed(merge_latest(old, fresh, keys, ts), keys, buckets).write.partitionBy(BUCKETS, BUCKET).parquet(path)
    return path, fresh.count()


def apply_upsert(staged: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Put staged buckets in place of those of the online table; others are left alone.

    Doing it again changes nothing, so a broken run is mended by repeating it.
    """
    known = staged.select(BUCKETS).first()
    if known is None:
        return
    writer = _writer(staged.drop(BUCKETS, BUCKET), keys, known[0], staged.count())
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_online(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """``schema``, that of the view, makes a table without rows readable too."""
    if schema is None:
        return spark.read.parquet(path)
    whole = T.StructType([*schema.fields, *BUCKET_FIELDS])
    return spark.read.schema(whole).parquet(path)


def lookup(
    requests: DataFrame,
    online: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    max_group_rows: int = MAX_GROUP_ROWS,
    strategy: str = "join",
    hot: DataFrame | bool | None = True,
) -> DataFrame:
    """Add the online columns to every request; unknown keys get NULL.

    ``hot`` gives the hot keys of the requests where they were counted before.

    ``join``, for any number of requests: an equi join on the keys that sends hot request
    keys around the shuffle. ``buckets``, for requests that touch a part of the table: only their
    key buckets are read, of which Spark joins the asked keys by their measured size; up to
    ``MAX_NAMED`` keys are named in the scan, which skips row groups and pages without them.
    """
    keys = list(keys)
    wanted = online.select(*keys, *columns)
    if strategy == "join":
        return left_join(requests, wanted, keys, max_group_rows, hot)
    if strategy != "buckets":
        raise ValueError(f"unknown strategy {strategy!r}")
    asked = durable(requests.select(*keys).distinct())
    if BUCKET in online.columns:
        known = online.select(BUCKETS).first()
        number = key_bucket(keys, known[0] if known else 1)
        # At most one number a bucket comes to the driver.
        hit = [r[0] for r in asked.select(number).distinct().collect()]
        wanted = online.where(F.col(BUCKET).isin(hit)).select(*keys, *columns)
    few = asked.limit(MAX_NAMED + 1).collect()
    if len(few) <= MAX_NAMED:  # at most so many rows are sent
        hits = F.broadcast(wanted.where(_any_of(few, keys, wanted.schema)))
    else:
        hits = wanted.join(asked, keys, "left_semi")
    return requests.join(hits, keys, "left")


def _any_of(rows: Sequence[Row], keys: Sequence[str], schema: T.StructType) -> Column:
    """Rows with one of these keys, as a filter that reaches the row groups of the scan."""
    found = F.lit(False)
    for row in rows:
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(k) == typed(row[k], schema[k].dataType))
        found = found | same
    return found
