"""Incremental jobs: they equal the full ones, read only what is new and survive a broken run."""

import glob
import os
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.queries import STEPS
from weekloom import Entity, FeatureStore, FeatureView, Field, Source
from weekloom.operators import online, prep, windows
from weekloom.operators.metrics import ModelVersions
from weekloom.plans import retail
from weekloom.plans.incremental import DEPTH, FeatureLog
from weekloom.plans.warehouse import Warehouse
from weekloom.registry import Registry, closure
from weekloom.session import fresh_path
from weekloom.sources.commits import CommitLog, _hadoop, _renamed, put_if_absent
from weekloom.sources.tables import cached, fingerprint
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# commit files


def test_put_if_absent_writes_once(spark):
    path = fresh_path(spark, "commit") + "/1.json"
    assert put_if_absent(spark, path, "one é") and not put_if_absent(spark, path, "two")
    assert [r[0] for r in spark.read.text(path).collect()] == ["one é"]
    assert len(os.listdir(os.path.dirname(path.replace("file:", "")))) == 1  # nothing staged stays


def test_rename_without_overwriting(spark):
    folder = fresh_path(spark, "renamed")
    for name in ("a", "b"):
        put_if_absent(spark, f"{folder}/{name}", name)
    jvm, conf, a, fs = _hadoop(spark, f"{folder}/a")
    b = _hadoop(spark, f"{folder}/b")[2]
    with pytest.raises(FileExistsError):
        _renamed(jvm, conf, fs.makeQualified(a), fs.makeQualified(b))
    c = _hadoop(spark, f"{folder}/c")[2]
    _renamed(jvm, conf, fs.makeQualified(a), fs.makeQualified(c))
    assert fs.exists(c) and not fs.exists(a)


def test_versions_of_many_writers_have_no_gap_and_no_copy(spark):
    versions = ModelVersions(spark, fresh_path(spark, "versions"))
    got, lock = [], threading.Lock()

    def register(writer):
        for i in range(25):
            n = versions.register("sales/weekly", f"run-{writer}-{i}", {"writer": str(writer)})
            with lock:
                got.append(n)

    writers = [threading.Thread(target=register, args=(w,)) for w in range(8)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(got) == list(range(1, 201))
    assert versions.register("other", "r") == 1 and versions.latest("none") is None
    table = versions.frame()
    assert table.where("name = 'sales/weekly'").count() == 200 == table.where("name = 'sales/weekly'").select("run_id").distinct().count()
    assert versions.latest("sales/weekly")["version"] == 200


# features


def test_steps_equal_one_build_and_read_their_own_weeks(spark):
    warehouse = Warehouse(spark, FOLDER)
    log = FeatureLog(spark, fresh_path(spark, "log"))
    assert log.read().isEmpty()
    assert [log.advance(warehouse, until) for until in (STEPS[0], STEPS[0], STEPS[1])] == [1, 1, 2]
    step = log.log.read(2)
    mine = spark.read.parquet(step["features"])
    assert mine.agg(F.min("event_timestamp")).first()[0] >= datetime.fromisoformat(log.log.read(1)["until"])
    plan = warehouse.sales_base(STEPS[0], STEPS[1])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    log.advance(warehouse)
    first, _ = warehouse.ship_span
    assert rows_of(log.read()) == rows_of(retail.build_sales_features(warehouse.sales_base(), first))
    assert log.advance(warehouse) == 3
    tails = spark.read.parquet(log.log.last()[1]["tail"]).groupBy("store_id", "dept_id").count()
    assert tails.agg(F.max("count")).first()[0] <= DEPTH
    columns = [f.name for f in retail.sales_schema()]
    whole, merged = prep.Scaler.fit(log.read(), columns), log.scaler().scaler()
    assert merged.means == pytest.approx(whole.means) and merged.stds == pytest.approx(whole.stds)


def test_a_step_that_was_not_committed_is_not_read(spark, monkeypatch):
    warehouse = Warehouse(spark, FOLDER)
    log = FeatureLog(spark, fresh_path(spark, "log"))
    log.advance(warehouse, STEPS[0])
    before = log.read().count()
    monkeypatch.setattr(CommitLog, "put", lambda *a: False)
    with pytest.raises(RuntimeError, match="another writer"):
        log.advance(warehouse)
    monkeypatch.undo()
    assert log.read().count() == before and log.advance(warehouse) == 2


def test_rows_before_the_end_of_a_series_are_refused(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "k string, at int, v double")
    tail = windows.tails(df, ["k"], "at", 1)
    assert rows_of(tail) == [("a", 2, 2.0)]

    def sums(rows):
        return windows.over_series(rows, ["k"], "at", lambda w: {"s": F.sum("v").over(w)}, 1, None)

    new = spark.createDataFrame([("a", 3, 4.0), ("b", 1, 1.0)], df.schema)
    assert rows_of(windows.continued(tail, new, ["k"], "at", sums)) == [("a", 3, 4.0, 6.0), ("b", 1, 1.0, 1.0)]
    assert rows_of(windows.continued(None, new, ["k"], "at", sums)) == [("a", 3, 4.0, 4.0), ("b", 1, 1.0, 1.0)]
    with pytest.raises(Exception, match="not after the end of its series"):
        windows.continued(tail, df, ["k"], "at", sums).collect()


def test_scaler_states_merge_in_any_order(spark):
    df = spark.range(100).select(F.when(F.col("id") % 7 > 0, F.col("id") * 1e6 + 1e9).alias("a"), F.lit(3.0).alias("b"), F.lit(None).cast("double").alias("c"))
    parts = [prep.scaler_state(df.where(F.col("a") % 3 == i) if i < 3 else df.where("a IS NULL"), ["a", "b", "c"]) for i in range(4)]
    one = parts[0].merged(parts[1]).merged(parts[2].merged(parts[3]))
    two = parts[3].merged(parts[2]).merged(parts[1]).merged(parts[0])
    whole = prep.Scaler.fit(df, ["a", "b", "c"])
    for state in (one, two, prep.ScalerState.from_json(one.to_json())):
        assert state.scaler().means == pytest.approx(whole.means) and state.scaler().stds == pytest.approx(whole.stds)


# materialization


def event_store(spark, path, root):
    view = FeatureView(
        "v", (Entity("k"),), (Field("x", T.DoubleType()),), Source("s", path=path, timestamp_field="ts"),
    )
    return FeatureStore(spark, [view], root=root)


def events(spark, first, last, keys):
    rows = [(k, T0 + timedelta(hours=h), float(h)) for h in range(first, last) for k in keys]
    return spark.createDataFrame(rows, "k bigint, ts timestamp_ntz, x double")


def bucket_files(path):
    found = glob.glob(path.replace("file:", "") + "/key_buckets=*/key_bucket=*/*.parquet")
    return {f: os.stat(f).st_mtime_ns for f in found}


def test_only_touched_buckets_are_written(spark):
    path, root = fresh_path(spark, "events"), fresh_path(spark, "root")
    events(spark, 0, 5, range(200)).write.parquet(path)
    store = event_store(spark, path, root)
    assert store.materialize_incremental() == {"v": 200}
    table = store._entry("v")["path"]
    before = bucket_files(table)
    assert len(before) == online.MIN_BUCKETS
    assert store.materialize_incremental() == {"v": 0} and bucket_files(table) == before
    events(spark, 7, 9, [3, 1000]).write.mode("append").parquet(path)
    assert event_store(spark, path, root).materialize_incremental() == {"v": 2}  # as another session
    after = bucket_files(table)
    numbers = {r[0] for r in spark.createDataFrame([(3,), (1000,)], "k bigint").select(online.key_bucket(["k"], online.MIN_BUCKETS)).collect()}
    for f in before:
        touched = any(f"/key_bucket={n}/" in f for n in numbers)
        assert (after.get(f) != before[f]) == touched
    assert len(after) == len(before)
    full = event_store(spark, path, None)
    full.materialize()
    store = event_store(spark, path, root)
    assert rows_of(store.online("v").select("k", "ts", "x")) == rows_of(full.online("v").select("k", "ts", "x"))
    assert store.materialize_incremental(end=T0) == {"v": 0}


def test_a_broken_upsert_is_finished_by_the_next_run(spark, monkeypatch):
    path, root = fresh_path(spark, "events"), fresh_path(spark, "root")
    events(spark, 0, 2, range(20)).write.parquet(path)
    store = event_store(spark, path, root)
    store.materialize_incremental()
    events(spark, 3, 4, range(5)).write.mode("append").parquet(path)

    def broken(*a):
        raise OSError("lost")

    monkeypatch.setattr(online, "apply_upsert", broken)
    with pytest.raises(OSError):
        store.materialize_incremental()
    monkeypatch.undo()
    other = event_store(spark, path, root)
    newest = {r["k"]: r["x"] for r in other.online("v").collect()}
    assert newest == {k: 3.0 if k < 5 else 1.0 for k in range(20)}


def test_late_rows_within_the_allowance_count(spark):
    path, root = fresh_path(spark, "events"), fresh_path(spark, "root")
    events(spark, 10, 11, [1]).write.parquet(path)
    store = event_store(spark, path, root)
    store.materialize_incremental()
    events(spark, 6, 7, [2]).write.mode("append").parquet(path)
    assert store.materialize_incremental() == {"v": 0} and store.online("v").count() == 1
    store.materialize_incremental(late=timedelta(hours=4))
    assert store.online("v").count() == 2


# cache and lineage


def test_cache_is_rebuilt_when_what_it_depends_on_changes(spark):
    source, folder = fresh_path(spark, "source"), fresh_path(spark, "cache")
    events(spark, 0, 3, range(4)).write.parquet(source)

    def build(ttl):
        view = FeatureView("v", (Entity("k"),), (Field("x", T.DoubleType()),), Source("s", path=source, timestamp_field="ts"), ttl)
        asked = spark.read.parquet(source).select("k", F.expr("ts + interval 1 hour").alias("event_timestamp"))
        return FeatureStore(spark, [view]).get_historical_features(asked, ["v:x"], strategy="window")

    def tables():
        return {os.path.basename(p) for p in glob.glob(folder.replace("file:", "") + "/*") if os.path.isdir(p)}

    first = cached(build(None), folder)
    assert tables() == {fingerprint(build(None))} and first.count() == 12
    times = {p: os.stat(p).st_mtime_ns for p in glob.glob(folder.replace("file:", "") + "/*/*")}
    cached(build(None), folder)
    assert times == {p: os.stat(p).st_mtime_ns for p in glob.glob(folder.replace("file:", "") + "/*/*")}
    cached(build(timedelta(minutes=30)), folder)
    assert len(tables()) == 2
    events(spark, 3, 4, [0]).write.mode("append").parquet(source)
    assert cached(build(None), folder).count() == 13 and len(tables()) == 3
    assert len(glob.glob(folder.replace("file:", "") + "/*.json")) == 3


def test_closure_of_lineage(spark):
    registry = Registry(retail.definitions("a", "b"))
    found = {(r["from_node"], r["to_node"]): r["hops"] for r in closure(registry.feature_edges_frame(spark)).collect()}
    assert found["source:sales_source", "feature:derived_features.momentum"] == 2
    assert found["source:store_source", "service:training_features"] == 2
    assert ("source:store_source", "feature:sales_features.lag_1") not in found
    ring = spark.createDataFrame([("a", "b"), ("b", "a")], "from_node string, to_node string")
    with pytest.raises(Exception, match="(?i)recursion"):
        closure(ring, 10).collect()
