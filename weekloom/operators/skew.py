"""Finding and splitting groups too large for one task.

A group is measured with a count that is combined before the shuffle. While every group
fits, callers keep their plain plan. Groups over the limit are cut along time into buckets,
each a group of its own; what a bucket needs from earlier ones is carried over by the caller.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable

MAX_GROUP_ROWS = 2_000_000
CELLS = 1024
MAX_BROADCAST_BYTES = 64 << 20


def sent(df: DataFrame) -> DataFrame:
    """A stored table of groups, marked for broadcast if the size of its rows allows it.

    What is sent lists groups of more than some number of rows, so it is that many times smaller
    than the data. Where a small limit makes most groups hot the list grows with the data: it is
    then shuffled as any other side of a join, and a group much larger than the others is left to
    Spark's adaptive skew join.
    """
    size = df.count() * (32 * len(df.columns) + 16)
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, stored, or None. Counted once."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = durable(counts.where(F.col("n") > max_rows).select(*keys))
    return None if hot.isEmpty() else hot


def only(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(sent(hot), list(keys), "left_semi")


def without(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(sent(hot), list(keys), "left_anti")


def ordinal(df: DataFrame, column: str) -> Column:
    return ordinal_of(F.col(column), df.schema[column].dataType)


def ordinal_of(c: Column, dtype: T.DataType) -> Column:
    """Microseconds for times, the value itself for numbers; never decreases with the column."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, (T.TimestampNTZType, T.DateType)):
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
        if isinstance(dtype, T.DateType):
            return days
        seconds = days + F.hour(c) * 3600 + F.minute(c) * 60
        return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    if isinstance(dtype, T.NumericType):
        return F.floor(c).cast("bigint")
    raise TypeError(f"cannot split a series ordered by {dtype.simpleString()}")


@dataclass
class Split:
    """Cells of hot groups: (keys, __cell) -> __bucket, rows ``n``, rows ``before``.

    A cell is an interval of the order column, named by its least value.
    """

    keys: tuple[str, ...]
    table: DataFrame
    place: Callable[[DataFrame], DataFrame]

    def attach(self, df: DataFrame, columns: DataFrame) -> DataFrame:
        """Join columns known per (keys, __cell) to the rows of ``df``."""
        return self.place(df).join(columns, [*self.keys, "__cell"])


def split_groups(
    df: DataFrame, keys: Sequence[str], ts: str, max_rows: int, cells: int = CELLS
) -> Split:
    """Cut every group of ``df`` along ``ts`` into buckets of about ``max_rows`` rows.

    Each group's own range is cut into cells and counted; a cell with more than ``max_rows``
    rows is cut and counted again, until it fits or holds a single time. So neither a burst
    nor a time far out leaves a large bucket, whatever the range.
    """
    keys = list(keys)
    # A row without a time sorts first, in a cell of its own below the least time.
    low, high = F.coalesce(F.min(ordinal(df, ts)) - 1, F.lit(0)), F.coalesce(F.max(ordinal(df, ts)), F.lit(0))
    whole = df.groupBy(*keys).agg(low.alias("__low"), high.alias("__high"))
    span = F.col("__high") - F.col("__low") + 1
    finer = [durable(whole.select(*keys, "__low", F.ceil(span / F.lit(cells)).cast("bigint").alias("__step")))]

    def within(start: str, step: str) -> Column:
        return F.col(start) + F.expr(f"(__at - {start}) DIV {step}") * F.col(step)

    def place(frame: DataFrame) -> DataFrame:
        out = frame.join(sent(finer[0]), keys)
        out = out.withColumn("__at", F.coalesce(ordinal(frame, ts), F.col("__low")))
        out = out.withColumn("__cell", within("__low", "__step")).drop("__low")
        for table in finer[1:]:
            out = out.join(sent(table), [*keys, "__cell"], "left")
            cut = F.col("__finer").isNotNull()
            out = out.withColumns({
                "__cell": F.when(cut, within("__cell", "__finer")).otherwise(F.col("__cell")),
                "__step": F.coalesce("__finer", "__step"),
            }).drop("__finer")
        return out.drop("__at")

    while True:
        counted = durable(
            place(df).groupBy(*keys, "__cell").agg(F.count(F.lit(1)).alias("n"), F.min("__step").alias("__step"))
        )
        full = counted.where((F.col("n") > max_rows) & (F.col("__step") > 1))
        if full.isEmpty():
            break
        step = F.ceil(F.col("__step") / F.lit(cells)).cast("bigint")
        finer.append(durable(full.select(*keys, "__cell", step.alias("__finer"))))
    # One row per cell of a hot key that holds rows.
    before = F.sum("n").over(W.partitionBy(*keys).orderBy("__cell")) - F.col("n")
    table = counted.select(*keys, "__cell", "n", before.alias("before"))
    table = table.withColumn("__bucket", F.floor(F.col("before") / F.lit(max_rows)))
    return Split(tuple(keys), durable(table), lambda frame: place(frame).drop("__step"))


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
    hot: DataFrame | bool | None = True,
) -> DataFrame:
    """Left join with a ``right`` that has one row per key, also when few keys hold most of ``left``.

    Rows of hot keys meet a broadcast of the few right rows they can match and never
    shuffle; all others take the join Spark picks. NULL keys match nothing. ``hot`` gives what
    :func:`hot_keys` found for the keyed rows of ``left``, if that is known.
    """
    keys = list(keys)
    loose = F.lit(False)
    for k in keys:
        loose = loose | F.col(k).isNull()
    keyed = left.where(~loose)
    empty = [
        F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name not in keys
    ]
    unmatched = left.where(loose).select("*", *empty)
    if hot is True:
        hot = hot_keys(keyed, keys, max_rows)
    if hot is None:
        return keyed.join(right, keys, "left").unionByName(unmatched)
    hot_right = durable(only(right, hot, keys))
    return (
        only(keyed, hot, keys)
        .join(sent(hot_right), keys, "left")
        .unionByName(without(keyed, hot, keys).join(right, keys, "left"))
        .unionByName(unmatched)
    )
