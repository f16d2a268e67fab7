"""Request tables on a regular calendar. Dates come from ``sequence`` + ``explode``, row by
row of the series, so the table is built in parallel and without any product join."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import moment


def numbers(count: int) -> Column:
    """Array 1..count as bigint."""
    return F.sequence(F.lit(1).cast("bigint"), F.lit(count).cast("bigint"))


def series_grid(spark: SparkSession, stores: int, departments: int) -> DataFrame:
    """All pairs (store_id, dept_id), both from 1."""
    return spark.range(1, stores + 1).select(
        F.col("id").alias("store_id"),
        F.explode(numbers(departments)).alias("dept_id"),
    )


def weekly(series: DataFrame, start: Column, end: Column, ts: str = "event_timestamp") -> DataFrame:
    """Every series at ``start``, ``start`` + 7 days, ... up to ``end``."""
    dates = F.sequence(start, end, F.expr("interval 7 days"))
    return series.select("*", F.explode(dates).alias(ts))


def weeks_from(series: DataFrame, start: datetime, weeks: int, ts: str = "event_timestamp") -> DataFrame:
    first = moment(start)
    return weekly(series, first, first + F.expr(f"interval {7 * (weeks - 1)} days"), ts)


def anchored(series: DataFrame, start: Column, end: Column, day: str = "FRI", ts: str = "event_timestamp") -> DataFrame:
    """Every series on each given weekday within [start, end], at midnight."""
    first = F.next_day(F.date_sub(start.cast("date"), 1), day).cast("timestamp_ntz")
    last = end.cast("date").cast("timestamp_ntz")
    dates = F.when(first <= last, F.sequence(first, last, F.expr("interval 7 days")))
    return series.select("*", F.explode(dates).alias(ts))
