"""Synthetic weekly sales for any set of series and weeks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar, noise, scalar
from ..functions.literals import moment
from . import spines


def sales_rows(
    rows: DataFrame,
    week: Column,
    seed: int | None = 42,
    holidays=calendar.HOLIDAY_WEEKS,
    mode: str = "nearest",
    ts: str = "event_timestamp",
) -> DataFrame:
    """Sales, calendar and economic columns for rows (store_id, dept_id, ts).

    ``week`` counts weeks from the first one. ``seed=None`` leaves out all noise.
    A pure projection: each row depends on its own values only.
    """
    store, dept, at = F.col("store_id"), F.col("dept_id"), F.col(ts)
    woy = F.weekofyear(at)
    made = calendar.calendar_columns(at, holidays, mode)
    sales = scalar.expected_sales(store, dept, woy, calendar.is_holiday(at, holidays))
    return rows.withColumn("__week", week.cast("bigint")).select(
        "store_id",
        "dept_id",
        ts,
        F.round(F.greatest(F.lit(0.0), sales + _noise(seed, 0, 2000.0)), 2).alias("weekly_sales"),
        *[c.alias(n) for n, c in made.items()],
        *[c.alias(n) for n, c in economy(woy, F.col("__week"), seed).items()],
    )


def economy(woy: Column, week: Column, seed: int | None = 42) -> dict[str, Column]:
    """Temperature, fuel price, price index and unemployment; needs a ``__week`` column."""
    fuel = F.lit(0.25) if seed is None else 0.5 * noise.uniform(_digest(seed, 1), 2)
    return {
        "temperature": F.round(scalar.mean_temperature(woy) + _noise(seed, 0, 5.0, 2), 1),
        "fuel_price": F.round(F.lit(3.0) + fuel, 2),
        "cpi": scalar.price_index(week),
        "unemployment": F.round(F.lit(5.0) + _noise(seed, 1, 0.5), 1),
    }


def _digest(seed: int, stream: int) -> Column:
    return noise.digest(seed, F.col("store_id"), F.col("dept_id"), F.col("__week"), stream=stream)


def _noise(seed: int | None, stream: int, scale: float, part: int = 0) -> Column:
    if seed is None:
        return F.lit(0.0)
    return noise.normal(_digest(seed, stream), part) * F.lit(scale)


def generate_sales(
    spark: SparkSession,
    start_date: str = "2022-01-01",
    weeks: int = 104,
    stores: int = 45,
    departments: int = 14,
    seed: int | None = 42,
    **options,
) -> DataFrame:
    """The demonstration data set: stores x departments x weeks."""
    start = datetime.fromisoformat(start_date)
    rows = spines.weeks_from(spines.series_grid(spark, stores, departments), start, weeks)
    first = moment(start).cast("date")
    week = F.datediff(F.col("event_timestamp").cast("date"), first) / 7
    return sales_rows(rows, week, seed, **options)


def generate_stores(
    spark: SparkSession, start_date: str = "2022-01-01", stores: int = 45, departments: int = 14
) -> DataFrame:
    """One row per series, all at the first date."""
    return store_rows(
        spines.series_grid(spark, stores, departments),
        moment(start_date),
    )


def store_rows(series: DataFrame, at: Column, ts: str = "event_timestamp") -> DataFrame:
    made = scalar.store_columns(F.col("store_id"))
    return series.select("store_id", "dept_id", at.alias(ts), *[c.alias(n) for n, c in made.items()])
