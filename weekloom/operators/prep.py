"""From a joined training table to a scaled matrix: filters, fills, splits and scaling."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import typed
from ..session import durable, stored
from .skew import ordinal_of

NOT_FEATURES = ("store_id", "dept_id", "event_timestamp", "date", "weekly_sales")


def numeric_features(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    """Names of the 32 and 64 bit numeric columns that are not keys, times or the target."""
    kinds = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)
    return [
        f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, kinds)
    ]


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL and NaN to 0 in numeric columns."""
    names = set(columns if columns is not None else numeric_features(df, exclude=()))
    made = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in names:
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                c = F.nanvl(c, F.lit(0.0).cast(f.dataType))
            c = F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name)
        made.append(c)
    return df.select(*made)


def feature_matrix(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The columns as float in the given order; missing values and missing columns are 0."""
    made = [
        F.coalesce(F.col(c).cast("float") if c in df.columns else F.lit(None), F.lit(0.0))
        .cast("float")
        .alias(c)
        for c in columns
    ]
    return df.select(*keep, *made)


# -- splits ----------------------------------------------------------------


def _value(row: Row, schema: T.StructType) -> Column:
    return F.struct(*[typed(v, f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])


SLOTS = 1024
PREFIX = 7  # characters' bytes of a string that one round looks at


@dataclass(frozen=True)
class Ranked:
    """The value at a rank, the rows before it and the rows that hold it."""

    value: object
    before: int
    there: int


def _ordinal(column: Column, dtype: T.DataType, skip: int) -> Column:
    """A number that never falls as the value grows. Of text, ``PREFIX`` bytes after ``skip``."""
    if isinstance(dtype, T.StringType):
        digits = F.rpad(F.hex(F.substring(column.cast("binary"), skip + 1, PREFIX)), 2 * PREFIX, "0")
        return F.conv(digits, 16, 10).cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return column.cast("bigint")
    if isinstance(dtype, T.FractionalType):
        # Halved, so that no difference overflows; NaN is the greatest.
        real, end = column.cast("double"), F.lit(1.7e308)
        return F.when(F.isnan(real), end).otherwise(F.greatest(F.least(real, end), -end)) / 2
    return ordinal_of(column, dtype).cast("decimal(20,0)")


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int]) -> list[Ranked]:
    """The values at the given ranks (from 1, NULL first), found for all of them at once.

    Every round cuts the range that still holds a rank into ``SLOTS`` slots, counts them with
    partial sums and goes on in the slot of the rank, whose own least and greatest value bound
    the next cut. Nothing is sorted; at most ``SLOTS`` counts a rank reach the driver. After the
    first cut the remaining rows are written once, so a long plan is computed three times.
    """
    dtype = df.schema[column].dataType
    value = F.col(column)
    n, nulls, low, high = df.agg(
        F.count(F.lit(1)), F.count_if(value.isNull()), F.min(value), F.max(value)
    ).first()
    if not all(1 <= k <= n for k in ranks):
        raise ValueError(f"ranks must be in 1..{n}")
    found = {k: Ranked(None, 0, nulls) for k in ranks if k <= nulls}
    # Ranges still open: (least, greatest, rows before), each with its ranks.
    open_ = {(low, high, nulls): [k for k in ranks if k > nulls]}
    left, narrowed = df.select(column).where(value.isNotNull()), False
    while open_ := {r: ks for r, ks in open_.items() if ks}:
        bounds = list(open_)
        slot, which = F.lit(None).cast("bigint"), F.lit(None).cast("int")
        for i, (low, high, _) in enumerate(bounds):
            lo, hi = typed(low, dtype), typed(high, dtype)
            skip = 0
            if isinstance(dtype, T.StringType):
                skip = _common(low.encode(), high.encode())
            at, first, last = (_ordinal(c, dtype, skip) for c in (value, lo, hi))
            share = (at - first).cast("double") / F.greatest((last - first).cast("double"), F.lit(1e-300))
            inside = (value >= lo) & (value <= hi)
            # The least and the greatest value have slots of their own, so every round gets on.
            place = F.when(value == lo, -1).when(value == hi, SLOTS + 1).otherwise(F.floor(share * SLOTS))
            slot = F.when(inside, place).otherwise(slot)
            which = F.when(inside, F.lit(i)).otherwise(which)
        cut = left.withColumns({"__which": which, "__slot": slot.cast("bigint")}).where(F.col("__which").isNotNull())
        counts = cut.groupBy("__which", "__slot").agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
        ).collect()
        again: dict[tuple, list[int]] = {}
        for i, range_ in enumerate(bounds):
            before = range_[2]
            wanted = sorted(open_[range_])
            for row in sorted((r for r in counts if r["__which"] == i), key=lambda r: r["__slot"]):
                here = [k for k in wanted if before < k <= before + row["n"]]
                if here and _same(row["low"], row["high"]):
                    found |= {k: Ranked(row["low"], before, row["n"]) for k in here}
                elif here:
                    again[row["low"], row["high"], before] = here
                before += row["n"]
        if again and not narrowed:
            kept = F.lit(False)
            for low, high, _ in again:
                kept = kept | value.between(typed(low, dtype), typed(high, dtype))
            left, narrowed = stored(left.where(kept), "candidates"), True
        open_ = again
    return [found[k] for k in ranks]


def _common(a: bytes, b: bytes) -> int:
    """Bytes that two texts share at the start."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def kth_rows(df: DataFrame, order: Sequence[str], ranks: Sequence[int]) -> list[tuple[Row, int, int]]:
    """For each rank the tuple of ``order`` there, the rows before it and the copies of it.

    Columns are settled one after the other: the next one only among rows equal so far.
    """
    keys = df.select(*order)
    first = order_statistics(keys, order[0], ranks)
    out = []
    for k, at in zip(ranks, first):
        values, before, there, left = [at.value], at.before, at.there, keys
        for column in order[1:]:
            settled = order[len(values) - 1]
            left = left.where(F.col(settled).eqNullSafe(typed(values[-1], df.schema[settled].dataType)))
            if len(values) == 1:
                left = stored(left, "ties")
            now = order_statistics(left, column, [k - before])[0]
            values.append(now.value)
            before, there = before + now.before, now.there
        out.append((Row(*order)(*values), before, there))
    return out


def kth_row(df: DataFrame, order: Sequence[str], k: int) -> Row:
    """The k-th smallest (from 1) tuple of ``order`` without sorting the table."""
    return kth_rows(df, order, [k])[0][0]


def ordered_splits(
    df: DataFrame, order: Sequence[str], rows: Sequence[int], labels: Sequence[str], label: str = "split"
) -> DataFrame:
    """Mark rows by their place in ``order``: the first ``rows[0]`` with ``labels[0]``, and so on.

    ``labels`` has one more entry than ``rows``. The cut rows are selected first; marking is then
    a projection. Only copies of a cut row that lie on both sides of a cut are numbered.
    """
    n = df.count()
    ends = [min(sum(rows[: i + 1]), n) for i in range(len(rows))]
    cuts = sorted({k for k in ends if 0 < k < n})
    found = dict(zip(cuts, kth_rows(df, order, cuts))) if cuts else {}
    key, schema = F.struct(*order), df.select(*order).schema

    def marked(frame: DataFrame, upto) -> DataFrame:
        """``upto(k)``: whether a row is among the first k; None if no row is."""
        mark = F.lit(labels[-1])
        for k, name in reversed(list(zip(ends, labels))):
            inside = F.lit(k >= n) if k in (0, n) else upto(k)
            mark = F.when(inside, F.lit(name)).otherwise(mark)
        return frame.withColumn(label, mark)

    torn = {k: f for k, f in found.items() if f[1] + f[2] != k}
    values = {k: _value(row, schema) for k, (row, _, _) in found.items()}
    apart = F.lit(False)
    for value in {tuple(torn[k][0]): values[k] for k in torn}.values():
        apart = apart | (key == value)
    out = marked(df.where(~apart) if torn else df, lambda k: key <= values[k])
    for row in {tuple(f[0]) for f in torn.values()}:
        before = next(f[1] for f in torn.values() if tuple(f[0]) == row)
        copies = numbered(df.where(key == _value(Row(*order)(*row), schema)), "__at")
        copies = marked(copies, lambda k: F.col("__at") <= k - before)
        out = out.unionByName(copies.drop("__at"))
    return out


def ordered_split(
    df: DataFrame,
    order: Sequence[str],
    fraction: float = 0.8,
    label: str = "split",
    rows: int | None = None,
) -> DataFrame:
    """Mark the first ``int(n * fraction)`` rows in ``order`` as train, the others as val.

    ``rows`` gives their number instead.
    """
    rows = int(df.count() * fraction) if rows is None else rows
    return ordered_splits(df, order, [rows], ["train", "val"], label)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Number the rows from 1 in any order: one count per partition, no sort and no shuffle."""
    # A checkpoint fixes which row is where; the ids hold partition and place in 33 bits.
    fixed = durable(df.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", 33)
    # One count a partition of the table reaches the driver, which adds them up.
    sizes = sorted(tuple(r) for r in fixed.groupBy(part.alias("__part")).count().collect())
    starts, total = [], 0
    for p, size in sizes:
        starts.append((p, total))
        total += size
    offsets = df.sparkSession.createDataFrame(starts, "__part bigint, __before bigint")
    place = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__before") + 1
    joined = fixed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return joined.withColumn(name, place).drop("__id", "__part", "__before")


def chrono_split(
    df: DataFrame,
    ts: str = "event_timestamp",
    keys: Sequence[str] = ("store_id", "dept_id"),
    fraction: float = 0.8,
) -> DataFrame:
    """Chronological split by row position; ties of one time are ordered by key."""
    return ordered_split(df, [ts, *keys], fraction)


def chrono_splits(
    df: DataFrame,
    shares: dict[str, float],
    ts: str = "event_timestamp",
    keys: Sequence[str] = ("store_id", "dept_id"),
) -> DataFrame:
    """Several chronological parts at once; the last one gets what rounding leaves."""
    n = df.count()
    names = list(shares)
    return ordered_splits(df, [ts, *keys], [int(n * shares[x]) for x in names[:-1]], names)


def hash_percent(keys: Sequence[str], seed: str = "") -> Column:
    """Number 0..99 that depends on the key only."""
    text = F.concat_ws("|", *([F.lit(seed)] if seed else []), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def hash_split(df: DataFrame, keys: Sequence[str], percent: int = 80, seed: str = "") -> DataFrame:
    """Random split by key hash: stable under any plan, about ``percent`` percent train."""
    train = hash_percent(keys, seed) < percent
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("val")))


def permutation_split(
    df: DataFrame, keys: Sequence[str], fraction: float = 0.8, seed: int = 42
) -> DataFrame:
    """Random split with exactly ``int(n * fraction)`` train rows: a cut in hash order."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    shuffled = df.withColumn("__draw", F.md5(text))
    return ordered_split(shuffled, ["__draw", *keys], fraction).drop("__draw")


# -- scaling ---------------------------------------------------------------


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column. A constant column divides by 1."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> "Scaler":
        """One pass over the table for all columns; one row comes back."""
        stats = df.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        means = tuple(stats[f"m{i}"] or 0.0 for i in range(len(columns)))
        stds = tuple(stats[f"s{i}"] or 1.0 for i in range(len(columns)))
        return cls(tuple(columns), means, stds)

    def scale(self, name: str, value: Column | None = None) -> Column:
        i = self.columns.index(name)
        value = F.col(name) if value is None else value
        return (value - F.lit(self.means[i])) / F.lit(self.stds[i])

    def unscale(self, name: str, value: Column | None = None) -> Column:
        i = self.columns.index(name)
        value = F.col(name) if value is None else value
        return value * F.lit(self.stds[i]) + F.lit(self.means[i])

    def transform(self, df: DataFrame) -> DataFrame:
        made = {c: self.scale(c) for c in self.columns}
        return df.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns])

    def inverse(self, df: DataFrame) -> DataFrame:
        made = {c: self.unscale(c) for c in self.columns}
        return df.select(*[made[c].alias(c) if c in made else F.col(c) for c in df.columns])

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = list(zip(self.columns, self.means, self.stds))
        return spark.createDataFrame(rows, "column string, mean double, std double")

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "means": self.means, "stds": self.stds})

    @classmethod
    def from_json(cls, text: str) -> "Scaler":
        got = json.loads(text)
        return cls(*(tuple(got[k]) for k in ("columns", "means", "stds")))


@dataclass(frozen=True)
class ScalerState:
    """Count, mean and sum of squared deviations of each column; two states merge into one.

    So new rows are fitted without reading the old ones: their own state is merged in.
    """

    columns: tuple[str, ...]
    counts: tuple[int, ...]
    means: tuple[float, ...]
    squares: tuple[float, ...]

    def merged(self, other: "ScalerState") -> "ScalerState":
        """The state of both sets of rows together, by the pairwise formula."""
        if self.columns != other.columns:
            raise ValueError(f"states of {self.columns} and {other.columns}")
        counts, means, squares = [], [], []
        for n, m, s, k, o, t in zip(self.counts, self.means, self.squares, other.counts, other.means, other.squares):
            both, apart = n + k, o - m
            counts.append(both)
            means.append(m + apart * k / both if both else 0.0)
            squares.append(s + t + (apart * apart * n * k / both if both else 0.0))
        return ScalerState(self.columns, tuple(counts), tuple(means), tuple(squares))

    def scaler(self) -> Scaler:
        """Population deviation; a column that is constant or empty divides by 1."""
        stds = ((s / n) ** 0.5 if n else 0.0 for s, n in zip(self.squares, self.counts))
        return Scaler(self.columns, self.means, tuple(d or 1.0 for d in stds))

    def to_json(self) -> str:
        return json.dumps({"columns": self.columns, "counts": self.counts, "means": self.means, "squares": self.squares})

    @classmethod
    def from_json(cls, text: str) -> "ScalerState":
        got = json.loads(text)
        return cls(*(tuple(got[k]) for k in ("columns", "counts", "means", "squares")))


def scaler_state(df: DataFrame, columns: Sequence[str]) -> ScalerState:
    """The state of a frame: one pass, combined before the shuffle; one row comes back."""
    row = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.avg(c).cast("double").alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(columns)],
    ).first()
    size = range(len(columns))
    return ScalerState(
        tuple(columns), tuple(row[f"n{i}"] for i in size), tuple(row[f"m{i}"] or 0.0 for i in size),
        tuple((row[f"v{i}"] or 0.0) * row[f"n{i}"] for i in size),
    )


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The fitted statistics as a lazy table, one row per column."""
    wide = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m{i}").alias("mean"),
            F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("std"),
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def drop_null_target(df: DataFrame, target: str = "weekly_sales") -> DataFrame:
    return df.dropna(subset=[target])
