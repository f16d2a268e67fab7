"""Lag and rolling features of many series at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import MAX_GROUP_ROWS, hot_keys, only, split_groups, without

LAGS = (1, 2, 4, 8)
ROLLING = 4


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Callable[[WindowSpec], dict[str, Column]],
    depth: int,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``depth`` rows back within their series.

    ``columns`` receives the window (by key, in time order). All columns share one
    shuffle and one sort. Series longer than ``max_group_rows`` are computed in time
    buckets, each preceded by the last ``depth`` rows before it. ``max_group_rows=None``
    skips the measurement: use it where the grain bounds the length of a series.
    Rows of one series need distinct values of ``order``.
    """
    hot = None if max_group_rows is None else hot_keys(df, keys, max_group_rows)
    if hot is None:
        return _add(df, columns, W.partitionBy(*keys).orderBy(order))
    if max_group_rows < 2 * depth:
        raise ValueError("max_group_rows must be at least twice the look-back")
    cold = _add(without(df, hot, keys), columns, W.partitionBy(*keys).orderBy(order))
    return cold.unionByName(
        _in_buckets(only(df, hot, keys), keys, order, columns, depth, max_group_rows)
    )


def _add(df: DataFrame, columns, window: WindowSpec) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in columns(window).items()])


def _in_buckets(df, keys, order, columns, depth, max_rows) -> DataFrame:
    split = split_groups(df, keys, order, max_rows)
    # A bucket also receives the cells that end fewer than `depth` rows before it starts.
    # Of two neighbouring buckets at least one has `depth` rows, as max_rows >= 2 * depth,
    # so a cell can only matter to the next two buckets.
    starts = split.table.groupBy(*keys, "__bucket").agg(F.min("before").alias("start"))
    ahead = W.partitionBy(*keys).orderBy("__bucket")
    starts = starts.select(
        *keys,
        "__bucket",
        *[F.lead("__bucket", i).over(ahead).alias(f"bucket{i}") for i in (1, 2)],
        *[F.lead("start", i).over(ahead).alias(f"start{i}") for i in (1, 2)],
    )
    near = [
        F.when(F.col(f"start{i}") - F.col("before") - F.col("n") < depth, F.col(f"bucket{i}"))
        for i in (1, 2)
    ]
    routes = split.table.join(starts, [*keys, "__bucket"]).select(
        *keys,
        "__cell",
        F.col("__bucket").alias("__home"),
        F.array_compact(F.array("__bucket", *near)).alias("__targets"),
    )
    routed = split.attach(df, routes).withColumn("__bucket", F.explode("__targets"))
    window = W.partitionBy(*keys, "__bucket").orderBy(order)
    names = list(columns(window))
    return _add(routed, columns, window).where("__bucket = __home").select(*df.columns, *names)


def positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "position",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Place of each row in its group, from 1. Long groups are numbered bucket by bucket.

    The first order column is a time or number, NULL first; the others break ties. More rows of
    one whole number or time than fit a group are numbered by the next column.
    """

    def place(*by: str) -> Column:
        return F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("bigint")

    hot = None if max_group_rows is None else hot_keys(df, keys, max_group_rows)
    if hot is None:
        return df.withColumn(name, place(*keys))
    cold = without(df, hot, keys).withColumn(name, place(*keys))
    long = only(df, hot, keys)
    split = split_groups(long, keys, order[0], max_group_rows)
    bucket = W.partitionBy(*keys, "__bucket")
    starts = split.table.select(
        *keys, "__cell", "__bucket", F.min("before").over(bucket).alias("__start")
    )
    # A cell of fractions may hold several values, which the next column does not order.
    whole = not isinstance(df.schema[order[0]].dataType, (T.FractionalType,))
    tied = split.table.where((F.col("n") > max_group_rows) & F.lit(len(order) > 1 and whole))
    # Each level of ties saves its offset under a name of its own, as it may split again.
    tie = f"__tied{len(order)}"
    starts = starts.join(tied.select(*keys, "__cell", F.col("before").alias(tie)), [*keys, "__cell"], "left")
    long = split.attach(long, starts)
    # A cell over the limit is the last one of its bucket: the others of the bucket come before it.
    rest = long.where(F.col(tie).isNull()).withColumn(name, F.col("__start") + place(*keys, "__bucket"))
    out = cold.unionByName(rest.select(*df.columns, name))
    if tied.isEmpty():
        return out
    apart = long.where(F.col(tie).isNotNull()).select(*df.columns, tie)
    more = positions(apart, [*keys, order[0]], order[1:], f"{tie}_place", max_group_rows)
    more = more.withColumn(name, F.col(tie) + F.col(f"{tie}_place"))
    return out.unionByName(more.select(*df.columns, name))


def sales_windows(
    df: DataFrame,
    keys: Sequence[str] = ("store_id", "dept_id"),
    order: str = "event_timestamp",
    value: str = "weekly_sales",
    lags: Sequence[int] = LAGS,
    window: int = ROLLING,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Lags by row position, trailing mean and sample deviation, ratio to the mean.

    Frames include the current row. A lag before the start of the series is the trailing
    mean, a deviation of fewer than two rows is 0, a zero mean divides as 1.
    """

    def raw(w: WindowSpec) -> dict[str, Column]:
        frame = w.rowsBetween(-(window - 1), W.currentRow)
        made = {f"lag_{k}": F.lag(value, k).over(w) for k in lags}
        made[f"rolling_mean_{window}w"] = F.avg(value).over(frame)
        made[f"rolling_std_{window}w"] = F.stddev_samp(value).over(frame)
        return made

    depth = max([window - 1, *lags])
    out = over_series(df, keys, order, raw, depth, max_group_rows)
    mean, std = F.col(f"rolling_mean_{window}w"), F.col(f"rolling_std_{window}w")
    ratio = F.col(value) / F.when(mean == 0, F.lit(1.0)).otherwise(mean)
    zero = F.lit(0.0)
    return out.select(
        *df.columns,
        *[F.coalesce(f"lag_{k}", mean, zero).alias(f"lag_{k}") for k in lags],
        F.coalesce(mean, zero).alias(f"rolling_mean_{window}w"),
        F.coalesce(std, zero).alias(f"rolling_std_{window}w"),
        F.coalesce(ratio, F.lit(1.0)).alias("sales_vs_avg"),
    )


def tails(df: DataFrame, keys: Sequence[str], order: str, depth: int) -> DataFrame:
    """The last ``depth`` rows of every series: all that windows of that look-back need later.

    Tasks cut their rows down before the shuffle, so a long series costs no more than others.
    """
    newest = W.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("__from_end", F.row_number().over(newest)).where(F.col("__from_end") <= depth).drop("__from_end")


def continued(
    tail: DataFrame | None, fresh: DataFrame, keys: Sequence[str], order: str, windows: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``windows`` over fresh rows that go on from stored tails; rows of the tails are not returned.

    Fresh rows come after the tail of their series. A row at or before its end is an error: what
    was computed from the rows after it would change.
    """
    if tail is None:
        return windows(fresh)
    marked = fresh.withColumn("__fresh", F.lit(True)).unionByName(tail.select(fresh.columns).withColumn("__fresh", F.lit(False)))
    over = W.partitionBy(*keys)
    ended = F.max(F.when(~F.col("__fresh"), F.col(order))).over(over)
    made = windows(marked.withColumn("__end", ended)).where("__fresh")
    late = F.raise_error(F.concat(F.lit("a row not after the end of its series at "), F.col("__end").cast("string")))
    checked = F.when(F.col(order) <= F.col("__end"), late.cast("boolean")).otherwise(F.lit(True))
    return made.where(checked).drop("__fresh", "__end")
