"""Calendar features of a date or timestamp column. All flags and numbers are bigint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weeks of the retail holidays (football final, Independence Day,
# Labor Day, Thanksgiving, Christmas); the batch-job variant also counts New Year.
HOLIDAY_WEEKS = (6, 27, 36, 47, 51)
HOLIDAY_WEEKS_NEW_YEAR = (6, 27, 36, 47, 51, 52)


def week_of_year(ts: Column) -> Column:
    return F.weekofyear(ts).cast("bigint")


def week_of_month(ts: Column) -> Column:
    return F.floor((F.dayofmonth(ts) - 1) / 7 + 1).cast("bigint")


def is_month_end(ts: Column) -> Column:
    """1 when the same weekday of the next week falls in another month."""
    day = ts.cast("date")
    return (F.month(F.date_add(day, 7)) != F.month(day)).cast("bigint")


def is_holiday(ts: Column, weeks: Sequence[int] = HOLIDAY_WEEKS) -> Column:
    return F.weekofyear(ts).isin(list(weeks)).cast("bigint")


def days_to_holiday(
    ts: Column, weeks: Sequence[int] = HOLIDAY_WEEKS, mode: str = "nearest"
) -> Column:
    """Days to the next holiday week on a 52-week circle.

    ``nearest`` gives 0 inside a holiday week; ``strict`` looks only at later weeks
    and gives 365 when there is none.
    """
    ahead = [F.pmod(F.lit(h) - F.weekofyear(ts), F.lit(52)) for h in weeks]
    if mode == "nearest":
        return (F.array_min(F.array(*ahead)) * 7).cast("bigint")
    if mode == "strict":
        later = [F.when(a > 0, a * 7) for a in ahead]
        return F.least(F.lit(365), *later).cast("bigint")
    raise ValueError(f"unknown mode {mode!r}")


def calendar_columns(
    ts: Column, weeks: Sequence[int] = HOLIDAY_WEEKS, mode: str = "nearest"
) -> dict[str, Column]:
    return {
        "week_of_year": week_of_year(ts),
        "month": F.month(ts).cast("bigint"),
        "quarter": F.quarter(ts).cast("bigint"),
        "week_of_month": week_of_month(ts),
        "is_month_end": is_month_end(ts),
        "is_holiday": is_holiday(ts, weeks),
        "days_to_holiday": days_to_holiday(ts, weeks, mode),
    }


def week_start(ts: Column) -> Column:
    """Monday of the week at midnight, without a detour over the session time zone."""
    day = ts.cast("date")
    return F.date_sub(day, F.weekday(day)).cast("timestamp_ntz")
