import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom import Entity, FeatureStore, FeatureView, Field, Source
from weekloom.operators import pit
from weekloom.operators.pit import AsOf, point_in_time
from weekloom.session import fresh_path
from weekloom.sources.layout import store_view

T0 = datetime(2023, 1, 1)
DAY = timedelta(days=1)
US = timedelta(microseconds=1)
REQ = "id long, k long, event_timestamp timestamp_ntz"
FEAT = "k long, event_timestamp timestamp_ntz, v long, w string"


def brute(requests, features, ttl):
    out = {}
    for rid, k, at in requests:
        best = max(
            ((t, v, w) for fk, t, v, w in features if fk == k and t is not None and at and t <= at),
            default=None,
        )
        if k is None or best is None or (ttl is not None and best[0] < at - ttl):
            best = (None, None, None)
        out[rid] = best[1:]
    return out


def run(spark, requests, features, ttl=None, **options):
    view = AsOf(spark.createDataFrame(features, FEAT), ("k",), ("v", "w"), ttl)
    out = point_in_time(spark.createDataFrame(requests, REQ), [view], **options)
    rows = out.collect()
    assert len(rows) == len(requests)
    return {r["id"]: (r["v"], r["w"]) for r in rows}


PLANS = {
    "window": {"strategy": "window"},
    "auto": {},
    "broadcast": {"strategy": "broadcast"},
    "split": {"max_group_rows": 12},
    "split fine": {"max_group_rows": 2},
    "bounded": {"strategy": "window", "bound_time": True},
}


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("ttl", [None, 3 * DAY])
def test_like_brute_force(spark, plan, ttl):
    rng = random.Random(7)

    def moment():
        return T0 + timedelta(hours=rng.randint(0, 24 * 20))

    # Key 0 holds most rows; there are NULL keys, NULL times and copies on both sides.
    keys = [0] * 6 + [1, 2, 3, None]
    requests = [(i, rng.choice(keys), moment()) for i in range(150)]
    requests += [(200 + i, 0, T0 + 5 * DAY) for i in range(40)] + [(300, 1, None)]
    features = [(rng.choice(keys), moment(), rng.randint(0, 9), rng.choice("ab")) for _ in range(200)]
    features += [(0, T0 + 4 * DAY, i % 7, "c") for i in range(40)] + [(4, T0, 1, "z")]
    assert run(spark, requests, features, ttl, **PLANS[plan]) == brute(requests, features, ttl)


@pytest.mark.parametrize("plan", PLANS)
def test_edges(spark, plan):
    requests = [(1, 1, T0), (2, 2, T0), (3, 3, T0), (4, 4, T0), (5, None, T0), (6, 9, T0)]
    features = [
        (1, T0, 1, "same time"),
        (2, T0 - DAY, 2, "as old as the TTL"),
        (3, T0 - DAY - US, 3, "too old"),
        (4, T0 + US, 4, "future"),
        (None, T0, 5, "no key"),
    ]
    got = run(spark, requests, features, DAY, **PLANS[plan])
    assert got == {
        1: (1, "same time"), 2: (2, "as old as the TTL"), 3: (None, None),
        4: (None, None), 5: (None, None), 6: (None, None),
    }


@pytest.mark.parametrize("plan", PLANS)
def test_equal_times_take_the_greatest_row(spark, plan):
    features = [(1, T0, 5, "b"), (1, T0, 7, "a"), (1, T0, 7, "c"), (1, T0 - DAY, 9, "z")]
    assert run(spark, [(1, 1, T0 + DAY)], features, **PLANS[plan]) == {1: (7, "c")}


def test_empty_requests(spark):
    for options in PLANS.values():
        assert run(spark, [], [(1, T0, 1, "a")], **options) == {}


def test_views_with_different_keys_and_repeated_requests(spark):
    requests = spark.createDataFrame(
        [(1, 1, T0), (1, 1, T0), (1, 2, T0 + DAY)], "a long, b long, event_timestamp timestamp_ntz"
    )
    one = spark.createDataFrame([(1, T0, 10)], "a long, event_timestamp timestamp_ntz, x long")
    two = spark.createDataFrame([(1, 2, T0, 20)], "a long, b long, event_timestamp timestamp_ntz, y long")
    views = [AsOf(one, ("a",), ("x",)), AsOf(two, ("a", "b"), ("y",))]
    for options in PLANS.values():
        got = sorted(tuple(r) for r in point_in_time(requests, views, **options).collect())
        assert [(r[0], r[1], r[3]) for r in got] == [(1, 1, 10), (1, 1, 10), (1, 2, 10)]
        assert [r[4] for r in got] == [None, None, 20]


def test_two_views_one_shuffle(spark):
    requests = spark.createDataFrame([(1, 1, T0)], REQ)
    feats = spark.createDataFrame([(1, T0, 1, "a")], FEAT)
    views = [
        AsOf(feats.select("k", "event_timestamp", "v"), ("k",), ("v",)),
        AsOf(feats.select("k", "event_timestamp", "w"), ("k",), ("w",)),
    ]
    out = point_in_time(requests, views, strategy="window").where(F.col("k").isNotNull())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Window [") == 1


def test_clustered_sides_of_unequal_size_stay_aligned(spark):
    """The union of differently large sides must keep each key in one task, also when
    adaptive execution merges partitions."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        feats = spark.range(60_000).select(
            (F.col("id") % 300).alias("k"),
            F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("event_timestamp"),
            F.col("id").alias("v"),
        )
        clustered = feats.repartition("k")
        requests = spark.range(300).select(
            F.col("id").alias("k"),
            F.timestamp_seconds(F.lit(10**8)).cast("timestamp_ntz").alias("event_timestamp"),
        )
        view = AsOf(clustered, ("k",), ("v",), clustered=True)
        out = point_in_time(requests, [view], strategy="window")
        assert out.where(F.col("v") != F.col("k") + 59_700).count() == 0
        assert out.where(F.col("v").isNotNull()).count() == 300
    finally:
        for key in ("advisoryPartitionSizeInBytes", "coalescePartitions.parallelismFirst"):
            spark.conf.unset(f"spark.sql.adaptive.{key}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_columns_must_not_collide(spark):
    feats = spark.createDataFrame([(1, T0, 1)], "k long, event_timestamp timestamp_ntz, id long")
    with pytest.raises(ValueError):
        point_in_time(spark.createDataFrame([(1, 1, T0)], REQ), [AsOf(feats, ("k",), ("id",))])


def test_broadcast_beyond_its_limit_fails(spark):
    with pytest.raises(ValueError, match="bytes to broadcast"):
        run(spark, [(1, 1, T0)], [(1, T0, 1, "a")], strategy="broadcast", broadcast_bytes=3)


@pytest.mark.parametrize("ttl", [None, 3 * DAY])
def test_more_than_one_broadcast_may_hold_goes_in_blocks(spark, ttl):
    rng = random.Random(3)

    def moment():
        return T0 + timedelta(hours=rng.randint(0, 24 * 20))

    keys = [*range(30), None]
    requests = [(i, rng.choice(keys), moment()) for i in range(240)]
    requests += [(300 + i, 5, T0 + 9 * DAY) for i in range(20)] + [(400, 1, None)]
    features = [(rng.choice([*keys, 77]), moment(), rng.randint(0, 9), rng.choice("ab")) for _ in range(400)]
    want = brute(requests, features, ttl)
    view = AsOf(spark.createDataFrame(features, FEAT), ("k",), ("v", "w"), ttl)
    # Keys of 32 bits are in the block of equal keys of 64 bits.
    asked = spark.createDataFrame(requests, REQ).withColumn("k", F.col("k").cast("int"))
    out = point_in_time(asked, [view], strategy="broadcast", broadcast_bytes=900)
    assert out.columns == [*asked.columns, "v", "w"] and out.schema["k"].dataType == T.IntegerType()
    rows = out.collect()
    assert len(rows) == len(requests)
    assert {r["id"]: (r["v"], r["w"]) for r in rows} == want


def test_more_hot_keys_than_a_broadcast_may_hold(spark, monkeypatch):
    from weekloom.operators import skew, windows

    monkeypatch.setattr(skew, "MAX_BROADCAST_BYTES", 1000)
    rng = random.Random(11)

    def moment():
        return T0 + timedelta(hours=rng.randint(0, 24 * 20))

    # Key 0 has most rows, all but a few of the others are hot too.
    keys = [0] * 30 + [*range(40), None]
    requests = [(i, rng.choice(keys), moment()) for i in range(900)] + [(1000, 99, T0), (1001, 1, None)]
    features = [(rng.choice([*keys, 98]), moment(), rng.randint(0, 9), rng.choice("ab")) for _ in range(700)]
    want = brute(requests, features, 3 * DAY)
    assert run(spark, requests, features, 3 * DAY, max_group_rows=12) == want

    rows = [(k, T0 + timedelta(hours=h), float(h * h % 17)) for k in range(40) for h in range(30)]
    series = spark.createDataFrame(rows, "k long, at timestamp_ntz, x double")
    one, cut = (windows.sales_windows(series, ["k"], "at", "x", max_group_rows=n) for n in (None, 20))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, cut.collect()))


def test_times_far_out_leave_no_large_bucket(spark):
    from weekloom.operators.skew import split_groups

    rows = spark.range(5000).selectExpr("1 AS k", "timestamp_ntz'2023-01-01' + make_interval(0,0,0,0,0,0,id) AS t")
    far = spark.sql("SELECT 1 AS k, timestamp_ntz'1900-01-01' AS t UNION ALL SELECT 1, timestamp_ntz'9999-12-31'")
    split = split_groups(rows.union(far), ["k"], "t", 100)
    sizes = split.table.groupBy("__bucket").agg(F.sum("n").alias("n")).agg(F.max("n"), F.sum("n")).first()
    assert sizes[0] <= 200 and sizes[1] == 5002


def test_bucketed_views_are_not_shuffled(spark):
    rows = [(i % 37, datetime(2024, 1, 1) + timedelta(hours=i), float(i)) for i in range(2000)] + [(None, datetime(2024, 1, 1), 0.0)]
    frame = spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, x double")
    views = [
        FeatureView(name, (Entity("k"),), (Field(c, T.DoubleType()),), Source(name, frame=lambda s, c=c: frame.withColumnRenamed("x", c), timestamp_field="ts"))
        for name, c in (("one", "x"), ("two", "y"))
    ]
    kept = [store_view(spark, v, f"v_{uuid.uuid4().hex}", buckets=n, path=fresh_path(spark, "v")) for v, n in zip(views, (6, 6))]
    asked = spark.createDataFrame([(i % 40, datetime(2024, 1, 1) + timedelta(hours=3 * i, minutes=5), i) for i in range(500)], "k bigint, event_timestamp timestamp_ntz, id int")
    for limit in (2_000_000, 20):
        got = FeatureStore(spark, kept).get_historical_features(asked, ["one:x", "two:y"], max_group_rows=limit)
        want = FeatureStore(spark, views).get_historical_features(asked, ["one:x", "two:y"])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = FeatureStore(spark, kept).get_historical_features(asked, ["one:x", "two:y"], strategy="window", bound_time=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Bucketed: true") == 2 and text.count("Exchange") == 1
    mixed = [kept[0], store_view(spark, views[1], f"v_{uuid.uuid4().hex}", buckets=3, path=fresh_path(spark, "v"))]
    got = FeatureStore(spark, mixed).get_historical_features(asked, ["one:x", "two:y"], strategy="window")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
