"""Row-wise formulas of the sales model and its target."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


# The constants of the demonstration sales model, in the formulas below.
def seasonality(woy: Column) -> Column:
    return F.lit(1.0) + F.lit(0.3) * F.sin(F.lit(2 * math.pi) * woy / F.lit(52.0))


def expected_sales(store: Column, dept: Column, woy: Column, holiday: Column) -> Column:
    """Mean weekly sales of a store and department before noise."""
    boost = F.when(holiday == 1, F.lit(1.5)).otherwise(F.lit(1.0))
    base = (F.lit(50000) + store * 5000) * (F.lit(0.5) + dept * F.lit(0.2))
    return base * seasonality(woy) * boost


def mean_temperature(woy: Column) -> Column:
    return F.lit(60.0) + F.lit(20.0) * F.sin(F.lit(2 * math.pi) * woy / F.lit(52.0))


def price_index(week: Column) -> Column:
    return F.round(F.lit(220.0) + week * F.lit(0.1), 1)


def store_columns(store: Column) -> dict[str, Column]:
    """Static attributes that follow from the store number."""
    kinds = F.array(F.lit("A"), F.lit("B"), F.lit("C"))
    return {
        "store_type": F.element_at(kinds, (F.pmod(store, F.lit(3)) + 1).cast("int")),
        "store_size": (F.lit(100000) + store * 10000).cast("bigint"),
        "region": F.concat(F.lit("region_"), (F.floor((store - 1) / 15) + 1).cast("string")),
    }


def to_target(sales: Column) -> Column:
    return F.log1p(sales)


def from_target(value: Column) -> Column:
    return F.expm1(value)


def or_one(value: Column) -> Column:
    """The value, or 1 where it is NULL or 0: a safe divisor."""
    return F.when(value.isNull() | (value == 0), F.lit(1.0)).otherwise(value)
