"""Stored layout of feature views: tables bucketed by key, that joins read without a shuffle.

A bucket is a file of rows sorted by key and time. A point-in-time join moves only the requests
into the same buckets; a view of any size stays where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..definitions import FeatureView, Source
from .tables import scan_view


def write_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], ts: str, buckets: int | None = None, path: str | None = None
) -> int:
    """Save as a catalog table, one sorted file a bucket; the number of buckets.

    As many buckets as the session has shuffle partitions, unless given: then requests, which
    Spark deals to as many tasks, meet their bucket. ``path`` keeps the files outside the warehouse.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(buckets, *keys).sortWithinPartitions(*keys, ts)
    writer = placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys, ts)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return buckets


def store_view(
    spark: SparkSession, view: FeatureView, table: str, buckets: int | None = None, path: str | None = None
) -> FeatureView:
    """Write a view's rows bucketed by its join keys; the same view over that table.

    Types are the declared ones, so reading the table casts no key and keeps the buckets.
    """
    ts = view.source.timestamp_field
    n = write_bucketed(scan_view(spark, view), table, view.join_keys, ts, buckets, path)
    source = Source(view.source.name, timestamp_field=ts, clustered=True, table=table, buckets=n)
    return replace(view, source=source)
