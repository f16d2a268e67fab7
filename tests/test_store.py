"""Registry, on-demand views, materialization, lookup and train-serve consistency."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom import Entity, FeatureService, FeatureStore, FeatureView, Field, Registry, Source
from weekloom.definitions import OnDemandView
from weekloom.operators import online
from weekloom.plans import retail
from weekloom.registry import saved_objects
from weekloom.session import fresh_path
from weekloom.sources import generator, spines
from weekloom.sources.tables import cached_table, scan_view, write_if_any

T0 = datetime(2022, 1, 1)
KEYS = list(retail.KEYS)


@pytest.fixture(scope="module")
def demo(spark):
    """A small demonstration store over written tables: 4 stores x 3 departments x 60 weeks."""
    raw = generator.generate_sales(spark, weeks=60, stores=4, departments=3)
    first = F.lit(T0).cast("date")
    sales = retail.build_sales_features(raw.select(*KEYS, retail.TS, retail.TARGET), first)
    paths = [fresh_path(spark, n) for n in ("demo-sales", "demo-stores")]
    sales.write.parquet(paths[0])
    generator.generate_stores(spark, stores=4, departments=3).write.parquet(paths[1])
    return FeatureStore(spark, retail.definitions(*paths))


def test_apply_is_idempotent(demo):
    again = retail.definitions("a", "b")
    registry = Registry(again)
    assert registry.apply(again) == []
    assert [e.name for e in registry.entities()] == ["dept_id", "store_id"]
    assert [v.name for v in registry.views()] == ["sales_features", "store_features"]
    assert [s.name for s in registry.services()] == ["inference_features", "training_features"]
    assert registry.apply(retail.definitions("a", "c")) != []


def test_service_selection(demo):
    selection = demo.registry.select("inference_features")
    assert len(selection.output) == 21 and "weekly_sales" not in selection.output
    assert selection.output[:4] == ["lag_1", "lag_2", "lag_4", "lag_8"]
    assert len(demo.registry.select("training_features").output) == 22


def test_refs_keep_order_and_reject_duplicates(demo, spark):
    registry = demo.registry
    refs = ["store_features:region", "sales_features:lag_1"]
    assert registry.select(refs).output == ["region", "lag_1"]
    clone = FeatureView(
        "other", (retail.store_entity,), (Field("lag_1", T.DoubleType()),), Source("s", path="p")
    )
    with pytest.raises(ValueError):
        Registry([*retail.definitions("a", "b"), clone]).select(["sales_features:lag_1", "other:lag_1"])
    with pytest.raises(KeyError):
        registry.select(["sales_features:nope"])
    with pytest.raises(KeyError):
        registry.select("no_such_service")


def test_historical_reads_of_the_reference_requests(demo, spark):
    spine = spark.createDataFrame(
        [(1, 1, datetime(2022, 6, 1)), (3, 2, datetime(2022, 7, 1)), (99, 1, datetime(2022, 7, 1))],
        "store_id long, dept_id long, event_timestamp timestamp_ntz",
    )
    rows = demo.get_historical_features(
        spine, ["sales_features:weekly_sales", "store_features:store_type"]
    ).collect()
    found = {r["store_id"]: r for r in rows}
    assert found[1]["store_type"] == "B" and found[1]["weekly_sales"] > 0
    assert found[3]["store_type"] == "A"
    assert found[99]["weekly_sales"] is None and found[99]["store_type"] is None


def test_store_rows_expire_after_a_year(spark):
    """One store row per key at week 0: with a TTL of 365 days weeks 0..52 match."""
    stores = generator.generate_stores(spark, stores=1, departments=1)
    objects = retail.definitions(
        lambda s: None, lambda s: stores, store_ttl=retail.SHORT_STORE_TTL
    )
    spine = spines.weeks_from(spines.series_grid(spark, 1, 1), T0, 104)
    out = FeatureStore(spark, objects).get_historical_features(spine, ["store_features:store_size"])
    assert out.where(F.col("store_size").isNotNull()).count() == 53
    assert out.where(F.col("store_size").isNull()).count() == 51


def test_requests_before_all_data_get_nothing(demo, spark):
    grid = spines.series_grid(spark, 4, 3)
    a, b = (F.lit(d).cast("date") for d in ("2010-02-05", "2012-10-26"))
    spine = spines.anchored(grid, a, b)
    assert spine.count() == 143 * 12
    out = demo.get_historical_features(spine, "training_features")
    assert out.count() == 143 * 12
    assert out.dropna(subset=["weekly_sales"]).isEmpty()


def test_materialize_twice_changes_nothing(demo):
    demo.materialize()
    first = sorted(map(tuple, demo.online("sales_features").collect()))
    demo.materialize()
    assert sorted(map(tuple, demo.online("sales_features").collect())) == first
    assert len(first) == 12


def test_later_materialization_wins_and_older_rows_stay(spark):
    rows = [(1, T0, 1.0), (1, T0 + timedelta(days=7), 2.0), (2, T0, 3.0)]
    frame = spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double")
    view = FeatureView(
        "v", (Entity("k"),), (Field("v", T.DoubleType()),),
        Source("s", timestamp_field="ts", frame=lambda s: frame),
    )
    hidden = FeatureView("h", (Entity("k"),), view.schema, view.source, online=False)
    store = FeatureStore(spark, [view, hidden])
    assert list(store.materialize(end=T0)) == ["v"]
    store.materialize(start=T0 + timedelta(days=1))
    assert {r["k"]: r["v"] for r in store.online("v").collect()} == {1: 2.0, 2: 3.0}
    with pytest.raises(LookupError):
        store.online("h")


@pytest.mark.parametrize("strategy", ["join", "buckets"])
def test_online_lookup(demo, spark, strategy):
    demo.materialize()
    asked = spark.createDataFrame(
        [(0, 4, 3), (1, 1, 1), (2, 77, 1), (3, None, 1), (4, 1, 1)], "pos long, store_id long, dept_id long"
    )
    rows = demo.get_online_features(asked, "inference_features", "pos", strategy).collect()
    assert [r["pos"] for r in rows] == [0, 1, 2, 3, 4]
    assert [r["store_size"] for r in rows] == [140000, 110000, None, None, 110000]
    assert "weekly_sales" not in rows[0].asDict()


def test_few_requests_read_few_buckets(demo, spark):
    demo.materialize()
    table = demo.online("sales_features")
    out = online.lookup(
        spark.createDataFrame([(1, 1)], "store_id long, dept_id long"), table, KEYS, ["lag_1"],
        strategy="buckets",
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({online.BUCKET}" in plan
    assert "hashpartitioning" not in plan.split("BroadcastHashJoin", 1)[1].split("HashAggregate")[0]


def test_training_and_serving_agree(demo, spark):
    """Online values equal point-in-time values at the last week."""
    demo.materialize()
    series = spines.series_grid(spark, 4, 3)
    last = T0 + timedelta(weeks=59)
    service = FeatureService(
        "both", (*demo.registry.service("inference_features").features, *demo.registry.on_demand_views())
    )
    served = demo.get_online_features(series, service)
    trained = demo.get_historical_features(
        series.withColumn("event_timestamp", F.lit(last).cast("timestamp_ntz")), service
    ).drop("event_timestamp")
    assert served.columns == trained.columns
    assert sorted(map(tuple, served.collect())) == sorted(map(tuple, trained.collect()))


ON_DEMAND = [
    ((100.0, 50, 80.0), (2.0, 0.25)),
    ((None, None, None), (0.0, -1.0)),
    ((7.0, 0, 0.0), (7.0, 6.0)),
]


@pytest.mark.parametrize("make", [retail.derived_features, retail.derived_features_pandas])
def test_on_demand_views(spark, make):
    sales, stores, *_ = retail.definitions("a", "b")
    view: OnDemandView = make(sales, stores)
    rows = [given for given, _ in ON_DEMAND]
    df = spark.createDataFrame(rows, "weekly_sales double, store_size long, lag_1 double")
    out = df.coalesce(1).select(*[c.alias(n) for n, c in view.columns().items()]).collect()
    assert [tuple(r) for r in out] == [want for _, want in ON_DEMAND]


def test_scan_casts_and_checks(spark):
    frame = spark.createDataFrame([(1, T0, 5)], "k int, ts timestamp_ntz, v int")
    source = Source("s", timestamp_field="ts", frame=lambda s: frame)
    view = FeatureView("v", (Entity("k"),), (Field("v", T.FloatType()),), source)
    assert scan_view(spark, view).dtypes == [("k", "bigint"), ("ts", "timestamp_ntz"), ("v", "float")]
    bad = FeatureView("v", (Entity("k"),), (Field("w", T.FloatType()),), source)
    with pytest.raises(ValueError):
        scan_view(spark, bad)


def test_projection_reaches_the_scan(demo, spark):
    view = demo.registry.view("sales_features")
    part = view[["lag_1"]]
    plan = scan_view(spark, part.view, part.columns)._jdf.queryExecution().executedPlan().toString()
    assert "lag_1" in plan and "temperature" not in plan


def test_cached_table_is_written_once(spark):
    path = fresh_path(spark, "cache")
    first = cached_table(spark, path, lambda: spark.range(3).toDF("id"))
    second = cached_table(spark, path, lambda: spark.range(5).toDF("id"))
    assert first.count() == second.count() == 3


def test_empty_results_are_not_written(spark):
    assert write_if_any(spark.range(0).toDF("id"), fresh_path(spark, "e")) is False
    assert write_if_any(spark.range(2).toDF("id"), fresh_path(spark, "e")) is True


def test_root_outlives_the_session(spark):
    root = fresh_path(spark, "root")
    sales = generator.generate_sales(spark, weeks=9, stores=2, departments=2)
    first = F.lit("2022-01-01").cast("date")
    built = retail.build_sales_features(sales.select(*KEYS, retail.TS, retail.TARGET), first)
    objects = retail.definitions(
        lambda s: built, lambda s: generator.generate_stores(s, stores=2, departments=2)
    )
    store = FeatureStore(spark, root=root)
    assert store.apply(objects) and store.apply(objects) == []
    store.materialize(end=T0 + timedelta(weeks=4))
    store.materialize()
    other = FeatureStore(spark, objects, root=root)
    times = {r[0] for r in other.online("sales_features").select("event_timestamp").collect()}
    assert times == {T0 + timedelta(weeks=8)}
    other.apply([Entity("region_id")])
    saved = saved_objects(spark, f"{root}/registry")
    assert saved.count() == 2 + 2 + 2 + 1 + 2 + 1
    assert saved.select("kind", "name").distinct().count() == saved.count()


def test_online_tables_grow_in_buckets(spark):
    path = fresh_path(spark, "buckets")
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    online.write_online(df, path, ["k"], rows_per_bucket=4)
    table = online.read_online(spark, path)
    assert table.select(online.BUCKETS).first()[0] == 25
    out = online.lookup(spark.createDataFrame([(3,), (500,)], "k int"), table, ["k"], ["v"])
    assert sorted(map(tuple, out.collect())) == [(3, 6), (500, None)]


def test_compact_types(spark):
    sales = retail.definitions("a", "b", compact=True)[0]
    kinds = {f.name: f.dtype.simpleString() for f in sales.schema}
    assert kinds["lag_1"] == "float" and kinds["month"] == "int"


def test_metadata_tables(demo, spark):
    assert demo.registry.features_frame(spark).count() == 24
    kinds = {r["kind"]: r["count"] for r in demo.registry.objects_frame(spark).groupBy("kind").count().collect()}
    assert kinds == {"entity": 2, "source": 2, "feature_view": 2, "on_demand_view": 1, "feature_service": 2}
    assert demo.registry.lineage_frame(spark).count() == 12


def _view(name="v", ttl=None, **extra):
    source = Source("src", path="p")
    return FeatureView(name, (Entity("k"),), (Field("x", T.DoubleType()),), source, ttl, **extra)


def test_a_new_definition_takes_effect():
    view = _view(ttl=timedelta(days=1))
    old = OnDemandView("d", (view,), (Field("y", T.DoubleType()),), lambda c: {"y": c["x"]})
    registry = Registry([view, old, FeatureService("svc", (view, old))])
    newer, other = _view(ttl=timedelta(days=9)), OnDemandView("d", (view,), old.schema, lambda c: {"y": -c["x"]})
    assert registry.apply([newer, other]) == [("feature_view", "v"), ("on_demand_view", "d")]
    for asked in ("svc", ["v:x", "d:y"]):
        selection = registry.select(asked)
        assert selection.views["v"][0].ttl == timedelta(days=9)
        assert selection.on_demand == [other]
    assert registry.apply([_view(ttl=timedelta(days=9), tags={"a": "b"})]) == [("feature_view", "v")]


def test_saved_registry_declares_everything(spark):
    path = fresh_path(spark, "registry")
    assert saved_objects(spark, path) is None
    Registry([_view(ttl=timedelta(days=1))]).save(spark, path)
    Registry([_view(ttl=timedelta(days=2)), _view("w")]).save(spark, path)
    spark.range(1).write.parquet(f"{path}/9-broken")
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/9-broken/_SUCCESS")
    done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(done, False)
    rows = {(r["kind"], r["name"]): r["declared"] for r in saved_objects(spark, path).collect()}
    assert set(rows) == {("entity", "k"), ("source", "src"), ("feature_view", "v"), ("feature_view", "w")}
    assert '"ttl_seconds": 172800.0' in rows["feature_view", "v"] and '"x": "double"' in rows["feature_view", "v"]


def test_materialization_without_rows_is_readable(demo, spark):
    store = FeatureStore(spark, [*demo.registry.views()])
    store.materialize(end=T0 - timedelta(days=365))
    assert store.online("sales_features").isEmpty()
    store.materialize()
    assert store.online("sales_features").count() == 12


def test_a_broken_write_is_not_a_cached_table(spark):
    path = fresh_path(spark, "cache")
    spark.range(3).write.parquet(f"{path}/_temporary/0")
    assert cached_table(spark, path, lambda: spark.range(5)).count() == 5
    assert cached_table(spark, path, lambda: 1 / 0).count() == 5


def test_few_keys_skip_most_of_an_online_table(spark):
    path = fresh_path(spark, "online")
    assert online.write_online(spark.range(600_000).select((F.col("id") * 7).alias("k"), F.col("id").alias("x")), path, ["k"]) == 600_000
    table = online.read_online(spark, path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def scanned(asked):
            got = online.lookup(asked, table, ["k"], ["x"], strategy="buckets")
            rows = {r["k"]: r["x"] for r in got.collect()}
            leaves, n = got._jdf.queryExecution().executedPlan().collectLeaves(), 0
            for i in range(leaves.size()):
                if "key_bucket" in leaves.apply(i).toString():
                    n += leaves.apply(i).metrics().apply("numOutputRows").value()
            return rows, n

        few, n_few = scanned(spark.createDataFrame([(7,), (70,), (1,)], "k bigint"))
        assert few == {7: 1, 70: 10, 1: None} and 0 < n_few < 100_000
        keys = [(7 * i,) for i in range(0, 600_000, 2000)]
        many, n_many = scanned(spark.createDataFrame(keys, "k bigint"))
        assert many == {k: k // 7 for (k,) in keys} and n_many == 600_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
