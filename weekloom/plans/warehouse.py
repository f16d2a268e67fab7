"""The sales store over an order warehouse (lineitem, part, supplier, ... as Parquet).

Suppliers are the stores, part types the departments, shipped revenue per week the sales.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import week_start
from ..functions.literals import moment
from ..sources.generator import store_rows
from ..sources.spines import anchored, numbers, weekly

# Part types in alphabetical order, numbered from 1 as departments.
DEPARTMENTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def department(part_type: Column) -> Column:
    number = F.when(part_type == DEPARTMENTS[0], F.lit(1).cast("bigint"))
    for i, name in enumerate(DEPARTMENTS[1:], start=2):
        number = number.when(part_type == name, F.lit(i).cast("bigint"))
    # A type that is not listed would lose its sales without a word.
    unknown = F.raise_error(F.concat(F.lit("part type without a department: "), part_type))
    return number.when(part_type.isNotNull(), unknown.cast("bigint"))


class Warehouse:
    """Lazy frames over one folder. Files are listed once per table and object."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def shipments(self) -> DataFrame:
        """One row per order line with its series keys and ship time.

        The join side is broadcast only if its size is under the session threshold.
        """
        parts = self.table("part").select(
            F.col("p_partkey").alias("l_partkey"), department(F.col("p_type")).alias("dept_id")
        )
        lines = self.table("lineitem").join(parts, "l_partkey")
        return lines.withColumnRenamed("l_suppkey", "store_id")

    def sales_base(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """Weekly revenue per series: at most one row per series and week.

        ``start`` (inclusive) and ``end`` are starts of weeks; the scan then reads only their rows.

        Money is summed in whole dollars and rest, both bigint: exact, independent of the
        order of the rows, and without the slow wide decimals. Partial sums before the
        shuffle take the weight out of heavy series.
        """
        cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
        kept = 100 - F.rint(F.col("l_discount") * 100).cast("bigint")
        units = cents * kept  # 1/10000 dollar
        rest = units % 10000
        dollars = ((units - rest) / 10000).cast("bigint")
        sales = F.sum(dollars).cast("decimal(20,4)") + F.sum(rest).cast("decimal(20,4)") / 10000
        lines = self.shipments()
        if start is not None:
            lines = lines.where(F.col("l_shipdate") >= moment(start))
        if end is not None:
            lines = lines.where(F.col("l_shipdate") < moment(end))
        return (
            lines.groupBy("store_id", "dept_id", week_start(F.col("l_shipdate")).alias("event_timestamp"))
            .agg(F.round(sales, 2).cast("double").alias("weekly_sales"))
        )

    def series(self) -> DataFrame:
        """All series: each supplier with each department, partitioned by series.

        Moving this small table costs little; the dates that callers add to it then come in
        parallel and already in the partitioning the joins need.
        """
        rows = self.table("supplier").select(
            F.col("s_suppkey").alias("store_id"),
            F.explode(numbers(len(DEPARTMENTS))).alias("dept_id"),
        )
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return rows.repartition(tasks, "store_id", "dept_id")

    @cached_property
    def ship_span(self) -> tuple[Column, Column]:
        """First and last ship week as scalar subqueries; Spark runs both as one scan."""
        lines = self.table("lineitem")
        return tuple(
            lines.select(week_start(bound("l_shipdate")).alias("week")).scalar()
            for bound in (F.min, F.max)
        )

    def store_features(self) -> DataFrame:
        """Static attributes of every series, all at the first ship week."""
        return store_rows(self.series(), self.ship_span[0])

    def friday_spine(self) -> DataFrame:
        """Every series on every Friday of the shipping span."""
        return anchored(self.series(), *self.ship_span)

    def weekly_spine(self) -> DataFrame:
        """Every series every seven days from the first ship week."""
        return weekly(self.series(), *self.ship_span)
