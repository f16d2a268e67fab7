"""Point-in-time join: for every request row the newest feature row not after it.

Rules. A feature row at the very request time counts. A row older than the view's TTL
(inclusive bound) gives NULL. Of rows with equal key and time the greatest wins. Request
rows are all kept, duplicates too; NULL keys or times get NULL features.

Three plans give the same result:

* window: union both sides, sort by key and time, carry the last feature row forward.
  One shuffle per key set, linear in the rows, whatever the number of views.
* broadcast: on demand only, for few requests. Feature rows find their next request time in
  a broadcast table and are reduced per (key, time) before the shuffle. The features never
  shuffle. What is sent is measured in bytes first; too much is sent in blocks of keys, one
  after the other, each side written in these blocks by the tasks that have its rows.
* split: window in time buckets for keys with too many rows for one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import durable, fresh_path, stored
from .skew import MAX_GROUP_ROWS, left_join, only, split_groups, without

BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class AsOf:
    """A feature table to join.

    ``clustered`` says that the frame comes partitioned by ``keys``, as after a window over
    them; it is then not shuffled again. ``buckets`` says the same of a table bucketed by them.
    """

    frame: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    ttl: timedelta | None = None
    ts: str = "event_timestamp"
    clustered: bool = False
    buckets: int | None = None


def point_in_time(
    requests: DataFrame,
    views: Sequence[AsOf],
    ts: str = "event_timestamp",
    strategy: str = "auto",
    max_group_rows: int = MAX_GROUP_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    bound_time: bool = False,
    requests_clustered: bool = False,
) -> DataFrame:
    """Left as-of join of ``requests`` with every view.

    ``auto`` is the window plan at every size, with the keys of more than
    ``max_group_rows`` rows cut along time. ``window`` skips the measurement; use it where
    the grain of both sides bounds the rows per key. ``broadcast`` asks for that plan; it sends
    blocks of at most ``broadcast_bytes`` and raises if one key, with the times it is asked for,
    is larger. ``bound_time`` filters features to the
    time range of the requests; for stored views the filter reaches the Parquet scan.
    ``requests_clustered`` says that the requests come partitioned by the keys.
    """
    taken = list(requests.columns)
    for view in views:
        clash = set(view.columns) & set(taken)
        if clash:
            raise ValueError(f"columns {sorted(clash)} appear more than once")
        taken += view.columns
    by_keys: dict[tuple[str, ...], list[AsOf]] = {}
    for view in views:
        by_keys.setdefault(view.keys, []).append(view)

    out = requests
    for keys, group in by_keys.items():
        group = [_prepared(v, requests, ts, bound_time) for v in group]
        out = _one_key_set(
            out, keys, group, ts, strategy, max_group_rows, broadcast_bytes, requests_clustered
        )
        requests_clustered = False
    return out.select(*taken)


def _prepared(view: AsOf, requests: DataFrame, ts: str, bound_time: bool) -> AsOf:
    """Prune to the needed columns; drop rows that no request can match."""
    time_type = requests.schema[ts].dataType
    frame = view.frame.select(*view.keys, F.col(view.ts).cast(time_type).alias(ts), *view.columns)
    frame = frame.dropna(subset=[*view.keys, ts])
    if bound_time:
        frame = frame.where(F.col(ts) <= requests.select(F.max(ts)).scalar())
        if view.ttl is not None:
            oldest = requests.select((F.min(ts) - F.lit(view.ttl)).alias("t")).scalar()
            frame = frame.where(F.col(ts) >= oldest)
    return replace(view, frame=frame, ts=ts)


def _one_key_set(
    requests, keys, views, ts, strategy, max_rows, broadcast_bytes, clustered
) -> DataFrame:
    unmatched = F.lit(False)
    for c in (*keys, ts):
        unmatched = unmatched | F.col(c).isNull()
    keyed = requests.where(~unmatched)

    if strategy == "window":
        joined = _window(keyed, keys, views, ts, clustered)
    elif strategy == "broadcast":
        joined = _broadcast(keyed, keys, views, ts, broadcast_bytes)
    elif strategy != "auto":
        raise ValueError(f"unknown strategy {strategy!r}")
    else:
        joined = _splitting(keyed, keys, views, ts, max_rows, clustered)

    # NULL-key requests, however many, need no shuffle; their features become NULL.
    return joined.unionByName(requests.where(unmatched), allowMissingColumns=True)


def _carried(view: AsOf, name: str, window: WindowSpec, ts: str) -> Column:
    """The newest packed feature row up to here, NULL once it is older than the TTL."""
    hit = F.last(name, ignorenulls=True).over(window)
    if view.ttl is not None:
        hit = F.when(hit[ts] >= F.col(ts) - F.lit(view.ttl), hit)
    return hit.alias(name)


def _packed(view: AsOf, ts: str) -> Column:
    return F.struct(ts, *view.columns)


def _unpacked(views: Sequence[AsOf], hits: Sequence[str]) -> list[str]:
    """Names of the packed columns; fields of a NULL row are NULL."""
    return [f"{h}.`{c}`" for h, v in zip(hits, views) for c in v.columns]


def _window(requests: DataFrame, keys, views, ts, clustered=False) -> DataFrame:
    own = [c for c in requests.columns if c not in (*keys, ts)]
    row = F.struct(F.lit(1).alias("__kept"), *own)
    packs = [v.frame.select(_packed(v, ts).alias("f")).schema["f"].dataType for v in views]
    row_type = requests.select(row.alias("r")).schema["r"].dataType

    def side(df: DataFrame, order: int, which: int | None) -> DataFrame:
        made = [
            (_packed(v, ts) if i == which else F.lit(None).cast(packs[i])).alias(f"f{i}")
            for i, v in enumerate(views)
        ]
        kept = (row if which is None else F.lit(None).cast(row_type)).alias("__row")
        return df.select(*keys, ts, F.lit(order).alias("__side"), kept, *made)

    # Next to a clustered side the others are partitioned alike: Spark then sees one
    # partitioning of the whole union and does not shuffle the clustered side again.
    alike = clustered or any(v.clustered for v in views)
    buckets = max((v.buckets or 0 for v in views), default=0)

    def placed(df: DataFrame, clustered: bool = False, own: int | None = None) -> DataFrame:
        if buckets:  # where one side is bucketed, all others go into as many partitions
            return df if own == buckets else df.repartition(buckets, *keys)
        return df.repartition(*keys) if alike and not clustered else df

    both = side(placed(requests, clustered), 1, None)
    for i, v in enumerate(views):
        both = both.unionByName(side(placed(v.frame, v.clustered, v.buckets), 0, i))
    hits = [f"f{i}" for i in range(len(views))]
    running = (
        W.partitionBy(*keys)
        .orderBy(ts, "__side", *hits)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    filled = both.select(
        *keys, ts, "__row", *[_carried(v, h, running, ts) for h, v in zip(hits, views)]
    ).where("__row IS NOT NULL")
    return filled.select(*keys, ts, *[f"__row.`{c}`" for c in own], *_unpacked(views, hits))


def _block(keys: Sequence[str], types: dict, count: int) -> Column:
    """Block of a row by the hash of its keys; ``types`` is what both sides compare them as."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in keys]), F.lit(count)).cast("int")


def _types(keys: Sequence[str], frames: Sequence[DataFrame]) -> dict:
    """Key types of a union of the frames: a 32 and a 64 bit key that are equal hash alike."""
    return {f.name: f.dataType for f in reduce(DataFrame.union, [d.select(*keys) for d in frames]).schema}


def _blocks(df: DataFrame, keys: Sequence[str], types: dict, limit: int) -> int:
    """How many blocks leave none of a stored table with more bytes, as text, than the limit.

    ``keys`` are unique in it. A row that alone is over the limit fails the job.
    """
    sized = df.select(*keys, F.length(F.to_json(F.struct("*"))).cast("bigint").alias("__size"))
    total, longest = sized.agg(F.sum("__size"), F.max("__size")).first()
    if (longest or 0) > limit:
        raise ValueError(f"{longest} bytes to broadcast in a row, at most {limit}: use strategy='auto'")
    count = 1
    if (total or 0) > limit:
        count = -(-5 * total // (4 * limit))  # a quarter more than needed, as blocks differ
        while True:
            largest = sized.groupBy(_block(keys, types, count).alias("b")).agg(F.sum("__size").alias("s"))
            if largest.agg(F.max("s")).first()[0] <= limit:
                break
            count *= 2
    return count


def _cut(df: DataFrame, keys: Sequence[str], types: dict, count: int, name: str) -> Callable[[int], DataFrame]:
    """Write a frame in blocks, each task its own rows, without a shuffle; gives the reader of one."""
    path = fresh_path(df.sparkSession, name)
    cut = df.withColumn("__block", _block(keys, types, count))
    cut.write.partitionBy("__block").parquet(path)
    whole = df.sparkSession.read.schema(cut.schema).parquet(path)
    return lambda b: whole.where(F.col("__block") == b).drop("__block")


def _each_block(count: int, one: Callable[[int], DataFrame], name: str) -> DataFrame:
    """The rows of all blocks. One is computed and written at a time, so one broadcast is held."""
    for b in range(count):
        made = one(b)
        path = fresh_path(made.sparkSession, name) if b == 0 else path
        made.write.mode("append").parquet(path)
    return made.sparkSession.read.schema(made.schema).parquet(path)


def _broadcast(requests: DataFrame, keys, views, ts, limit) -> DataFrame:
    requests = stored(requests, "requests")
    # One array of distinct request times per key.
    moments = durable(requests.groupBy(*keys).agg(F.array_sort(F.collect_set(ts)).alias("__at")))

    def found_grid(moments: DataFrame, frames: Sequence[DataFrame]) -> DataFrame:
        grid = moments.select(*keys, F.explode("__at").alias(ts))
        for i, (v, frame) in enumerate(zip(views, frames)):
            slot = F.array_min(F.filter("__at", lambda at: at >= F.col(ts)))
            found = frame.join(F.broadcast(moments), list(keys)).withColumn("__slot", slot)
            found = found.where(F.col("__slot").isNotNull())
            if v.ttl is not None:
                found = found.where(F.col(ts) >= F.col("__slot") - F.lit(v.ttl))
            found = found.groupBy(*keys, "__slot").agg(F.max(_packed(v, ts)).alias(f"f{i}"))
            grid = grid.join(found.withColumnRenamed("__slot", ts), [*keys, ts], "left")
        running = W.partitionBy(*keys).orderBy(ts).rowsBetween(W.unboundedPreceding, W.currentRow)
        hits = [f"f{i}" for i in range(len(views))]
        grid = grid.select(*keys, ts, *[_carried(v, h, running, ts) for h, v in zip(hits, views)])
        return grid.select(*keys, ts, *_unpacked(views, hits))

    types = _types(keys, [requests, *[v.frame for v in views]])
    count = _blocks(moments, keys, types, limit)
    if count == 1:
        grid = durable(found_grid(moments, [v.frame for v in views]))
    else:
        sent = _cut(moments, keys, types, count, "moments")
        parts = [_cut(v.frame, keys, types, count, "features") for v in views]
        grid = _each_block(count, lambda b: found_grid(sent(b), [part(b) for part in parts]), "grid")

    moment = [*keys, ts]
    types = _types(moment, [requests])
    count = _blocks(grid, moment, types, limit)
    if count == 1:
        return requests.join(F.broadcast(grid), moment, "left")
    asked, sent_grid = (_cut(df, moment, types, count, name) for df, name in ((requests, "asked"), (grid, "moments")))
    return _each_block(count, lambda b: asked(b).join(F.broadcast(sent_grid(b)), moment, "left"), "joined")


def _splitting(requests: DataFrame, keys, views, ts, max_rows, clustered) -> DataFrame:
    # Only keys are read here. A lazy clustered view is not computed for it: the window it comes
    # from already had every key in one task.
    sides = [requests, *[v.frame for v in views if v.buckets or not v.clustered]]
    counts = [side.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) for side in sides]
    sums = reduce(DataFrame.union, counts).groupBy(*keys).agg(F.sum("n").alias("n"))
    hot = durable(sums.where(F.col("n") > max_rows).select(*keys))
    if hot.isEmpty():
        return _window(requests, keys, views, ts, clustered)

    def part(cut, df):
        return cut(df, hot, keys)

    def narrowed(cut):
        return [replace(v, frame=part(cut, v.frame)) for v in views]

    cold = _window(part(without, requests), keys, narrowed(without), ts, clustered)
    return cold.unionByName(_split(part(only, requests), keys, narrowed(only), ts, max_rows))


def _split(requests: DataFrame, keys, views, ts, max_rows) -> DataFrame:
    """Hot keys only. Copies collapse first, so one (key, time) is one row on each side."""
    moment = [*keys, ts]
    hits = [f"f{i}" for i in range(len(views))]
    packs = [v.frame.select(_packed(v, ts).alias("f")).schema["f"].dataType for v in views]

    def side(df: DataFrame, order: int, which: int | None) -> DataFrame:
        made = [
            (F.col("f") if i == which else F.lit(None).cast(t)).alias(h)
            for i, (h, t) in enumerate(zip(hits, packs))
        ]
        return df.select(*moment, F.lit(order).alias("__side"), *made)

    both = side(requests.select(*moment).distinct(), 1, None)
    for i, v in enumerate(views):
        newest = v.frame.groupBy(*moment).agg(F.max(_packed(v, ts)).alias("f"))
        both = both.unionByName(side(newest, 0, i))

    # Written once: the time range, the histogram and both passes below read it.
    both = stored(both, "hot-moments")
    split = split_groups(both.select(*moment), keys, ts, max_rows)
    both = split.attach(both, split.table.select(*keys, "__cell", "__bucket")).drop("__cell")
    # Last feature row of every bucket, then of all earlier buckets: one row per bucket.
    tails = both.groupBy(*keys, "__bucket").agg(*[F.max(h).alias(h) for h in hits])
    earlier = W.partitionBy(*keys).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = tails.select(
        *keys,
        F.lit(None).cast(requests.schema[ts].dataType).alias(ts),
        F.lit(-1).alias("__side"),
        *[F.last(h, ignorenulls=True).over(earlier).alias(h) for h in hits],
        "__bucket",
    )
    running = (
        W.partitionBy(*keys, "__bucket")
        .orderBy(F.col(ts).asc_nulls_first(), "__side")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    filled = both.unionByName(carried).select(
        *moment, "__side", *[_carried(v, h, running, ts) for h, v in zip(hits, views)]
    )
    found = filled.where("__side = 1").select(*moment, *_unpacked(views, hits))
    return left_join(requests, found, moment, max_rows)
