import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weekloom.operators import metrics, prep
from weekloom.operators.skew import left_join
from weekloom.session import fresh_path


@pytest.mark.parametrize("k", [1, 250, 4000])
def test_kth_row(spark, monkeypatch, k):
    monkeypatch.setattr(prep, "SLOTS", 8)
    rng = random.Random(3)
    rows = [(rng.randint(0, 40), rng.choice("xyz"), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "a long, b string, c long")
    assert tuple(prep.kth_row(df, ["a", "b", "c"], k)) == sorted(rows)[k - 1]


KINDS = {
    "bigint": [-(2**63), 2**63 - 1, 0, 1, 5, 5, 5, None, *range(100, 200)],
    "double": [float("-inf"), float("inf"), float("nan"), float("nan"), -0.5, 1e-300, 1e300, None, None, *[x / 7 for x in range(50)]],
    "string": ["", "\x00", "\x00\x00", "a", "ab", "ab\x00", "abcdefghijk", "abcdefghijkl", "é", "\U0001f600", None, *[f"common prefix {i}" for i in range(60)]],
    "timestamp_ntz": [None, *[datetime(2020, 1, 1) + timedelta(microseconds=i * i) for i in range(80)], datetime(1900, 5, 5)],
    "timestamp": [None, *[datetime(2020, 1, 1) + timedelta(seconds=i % 9) for i in range(80)]],
    "date": [date(1960, 1, 1), None, *[date(2020, 1, 1) + timedelta(days=i) for i in range(40)]],
    "boolean": [True, False, None, True, True],
    "decimal(10,2)": [Decimal("1.25"), None, *[Decimal(i) / 4 for i in range(50)]],
}


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_order_statistics_of_every_kind(spark, monkeypatch, kind):
    monkeypatch.setattr(prep, "SLOTS", 4)
    values = KINDS[kind]

    def rank(v):
        if v is None:
            return (0, 0, b"")
        if isinstance(v, float) and v != v:
            return (2, 0, b"")
        return (1, 0, v.encode()) if isinstance(v, str) else (1, v, b"")

    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    ranks = sorted({1, 2, len(values) // 3, len(values) // 2, len(values) - 1, len(values)})
    got = prep.order_statistics(df, "v", ranks)
    want = sorted(map(rank, values))
    for k, r in zip(ranks, got):
        assert rank(r.value) == want[k - 1]
        assert (r.before, r.there) == (sum(w < want[k - 1] for w in want), want.count(want[k - 1]))


def test_order_statistics_take_few_rounds_and_small_answers(spark, monkeypatch):
    rounds = []
    df = spark.range(0, 3_000_000, numPartitions=8).select((F.col("id") * F.col("id")).alias("v"))
    count = prep.stored
    monkeypatch.setattr(prep, "stored", lambda d, n: rounds.append(d) or count(d, n))
    got = prep.order_statistics(df, "v", [1, 1_000_000, 2_000_000, 3_000_000])
    assert [r.value for r in got] == [0, 999_999**2, 1_999_999**2, 2_999_999**2]
    assert len(rounds) == 1 and rounds[0].count() < 50_000


def test_splits_have_no_global_window_and_no_sorted_limit(spark, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    collect = frame.collect

    def seen(self):
        plans.append(self._jdf.queryExecution().optimizedPlan().toString())
        return collect(self)

    monkeypatch.setattr(frame, "collect", seen)
    df = spark.range(5000).select((F.col("id") % 50).alias("t"), F.md5(F.col("id").cast("string")).alias("k"))
    out = prep.chrono_splits(df, {"train": 0.7, "val": 0.15, "test": 0.15}, "t", ["k"])
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    plans.append(prep.permutation_split(df, ["k"])._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) > 4 and not any("Window" in p or "Limit" in p or "Sort" in p for p in plans)
    monkeypatch.undo()
    rows = sorted(out.collect(), key=lambda r: (r["t"], r["k"]))
    assert [r["split"] for r in rows] == ["train"] * 3500 + ["val"] * 750 + ["test"] * 750


def test_several_cuts_within_copies(spark):
    df = spark.range(100).select(F.when(F.col("id") < 90, 1).otherwise(2).alias("t"))
    out = prep.ordered_splits(df, ["t"], [30, 30, 35], ["a", "b", "c", "d"])
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"a": 30, "b": 30, "c": 35, "d": 5}
    assert out.where("split IN ('a', 'b') AND t = 2").isEmpty()
    assert prep.ordered_splits(df.limit(0), ["t"], [0], ["a", "b"]).isEmpty()


@pytest.mark.parametrize("copies", [1, 7, 1000])
def test_ordered_split_is_exact_also_among_copies(spark, copies):
    df = spark.range(1003).select(F.floor(F.col("id") / copies).alias("t"), F.lit("x").alias("p"))
    out = prep.ordered_split(df, ["t"])
    counts = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert counts == {"train": 802, "val": 201}
    ends = {r["split"]: (r["lo"], r["hi"]) for r in out.groupBy("split").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).collect()}
    assert ends["train"][1] <= ends["val"][0]


def test_numbering(spark):
    out = prep.numbered(spark.range(1000).repartition(7), "n").select("n").collect()
    assert sorted(r["n"] for r in out) == list(range(1, 1001))


def test_permutation_split_is_exact_and_stable(spark):
    df = spark.range(999)
    one = prep.permutation_split(df, ["id"])
    two = prep.permutation_split(df.repartition(5), ["id"])
    assert one.where("split = 'train'").count() == int(999 * 0.8)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    other = prep.permutation_split(df, ["id"], seed=7)
    assert sorted(map(tuple, one.collect())) != sorted(map(tuple, other.collect()))


def test_empty_split(spark):
    assert prep.ordered_split(spark.range(0), ["id"]).isEmpty()


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    s = prep.Scaler.fit(df, ["a", "b"])
    assert s.means == (3.0, 5.0) and s.stds[1] == 1.0
    assert s.stds[0] == pytest.approx((14 / 3) ** 0.5)
    assert prep.Scaler.from_json(s.to_json()) == s
    back = s.inverse(s.transform(df)).collect()
    assert [r["a"] for r in back] == pytest.approx([1.0, 2.0, 6.0])
    lazy = {r["column"]: (r["mean"], r["std"]) for r in prep.scaler_stats(df, ["a", "b"]).collect()}
    eager = {r["column"]: (r["mean"], r["std"]) for r in s.frame(spark).collect()}
    assert lazy["b"] == eager["b"] and lazy["a"] == pytest.approx(eager["a"])


def test_fill_zero_takes_null_and_nan(spark):
    df = spark.createDataFrame([(None, float("nan"), None, "x"), (1, 2.0, 3.0, None)], "i int, d double, f float, s string")
    rows = [tuple(r) for r in prep.fill_zero(df).collect()]
    assert rows == [(0, 0.0, 0.0, "x"), (1, 2.0, 3.0, None)]
    assert prep.fill_zero(df).dtypes == df.dtypes


def test_feature_matrix_and_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2, None, "A", 9.0)], "store_id long, n long, x double, t string, weekly_sales double")
    assert prep.numeric_features(df) == ["n", "x"]
    out = prep.feature_matrix(df, ["x", "absent", "n"], keep=["store_id"])
    assert out.dtypes == [("store_id", "bigint"), ("x", "float"), ("absent", "float"), ("n", "float")]
    assert tuple(out.first()) == (1, 0.0, 0.0, 2.0)


def test_left_join_with_hot_and_null_keys(spark):
    left = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"))
    right = spark.createDataFrame([(1, "hot"), (750, "b"), (None, "never")], "k long, v string")
    want = sorted(map(str, left.join(right, ["k"], "left").select("id", "k", "v").collect()))
    for limit in (100, 10**6):
        got = left_join(left, right, ["k"], limit).select("id", "k", "v")
        assert sorted(map(str, got.collect())) == want


def test_mape_counts_only_actuals_above_the_floor(spark):
    df = spark.createDataFrame([(1000.0, 0.0), (1001.0, 0.0), (2000.0, 1000.0)], "y double, p double")
    value = df.agg(metrics.mape(F.col("y"), F.col("p"))).first()[0]
    assert value == pytest.approx(75.0)
    assert df.where("y <= 1000").agg(metrics.mape(F.col("y"), F.col("p"))).first()[0] is None


def test_best_step_prefers_the_earliest(spark):
    log = spark.createDataFrame(
        [("r", 0, 0.5, 9.0), ("r", 1, 0.2, 7.0), ("r", 2, 0.2, 5.0), ("q", 0, 1.0, 1.0)],
        "run_id string, step int, val_loss double, mape double",
    )
    got = {r["run_id"]: (r["step"], r["mape"]) for r in metrics.best_step(log).collect()}
    assert got == {"r": (1, 7.0), "q": (0, 1.0)}


def test_versions_continue(spark):
    schema = "name string, run_id long, start_time long"
    first = metrics.next_versions(spark.createDataFrame([("m", 1, 10), ("m", 2, 5), ("n", 3, 1)], schema))
    second = metrics.next_versions(spark.createDataFrame([("m", 4, 20), ("o", 5, 1)], schema), first)
    assert {r["run_id"]: r["version"] for r in first.collect()} == {2: 1, 1: 2, 3: 1}
    assert {r["run_id"]: r["version"] for r in second.collect()} == {4: 3, 5: 1}
    last = metrics.latest_version(first.unionByName(second), keep=["run_id"])
    assert {r["name"]: r["run_id"] for r in last.collect()} == {"m": 4, "n": 3, "o": 5}


def test_params_and_tags(spark):
    path = fresh_path(spark, "params")
    metrics.append_params(spark, path, "r1", {"epochs": 5, "rate": 0.1})
    metrics.append_params(spark, path, "r2", {"epochs": 6})
    assert spark.read.parquet(path).count() == 3
    df = spark.createDataFrame([("m", 1, 3.14159)], "name string, version int, mape double")
    once = metrics.tag_versions(df, {"mape": F.round("mape", 2)})
    twice = metrics.tag_versions(once, {"mape": F.lit("2.00"), "team": F.lit("a")})
    assert once.first()["tags"] == {"mape": "3.14"}
    assert twice.first()["tags"] == {"mape": "2.00", "team": "a"}


def test_cut_does_not_depend_on_time_zones(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(100).select(
            F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("t")
        )
        assert prep.ordered_split(df, ["t"]).where("split = 'train'").count() == 80
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
