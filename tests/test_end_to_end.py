"""The whole path on the demonstration data: features, training set, model, scored requests."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weekloom import FeatureStore, scoring
from weekloom.operators import prep
from weekloom.plans import retail, training
from weekloom.session import fresh_path, stored
from weekloom.sources import generator, spines

T0 = datetime(2022, 1, 1)
KEYS = list(retail.KEYS)


@pytest.fixture(scope="module")
def paths(spark):
    raw = generator.generate_sales(spark).select(*KEYS, retail.TS, retail.TARGET)
    sales, stores = fresh_path(spark, "sales"), fresh_path(spark, "stores")
    retail.build_sales_features(raw, F.lit("2022-01-01").cast("date")).write.parquet(sales)
    generator.generate_stores(spark).write.parquet(stores)
    return sales, stores


@pytest.fixture(scope="module")
def grid(spark):
    return spines.series_grid(spark, 45, 14)


@pytest.fixture(scope="module")
def table(spark, paths, grid):
    store = FeatureStore(spark, retail.definitions(*paths))
    spine = spines.weeks_from(grid, T0, 104)
    return stored(store.get_historical_features(spine, "training_features"), "training")


def test_training_set_is_complete(table):
    assert table.count() == 65_520 and len(table.columns) == 3 + 22
    assert table.dropna().count() == 65_520


def test_each_request_of_a_feature_time_gets_that_very_row(spark, paths, table):
    sales = spark.read.parquet(paths[0])
    joined = table.select(*sales.columns)
    assert joined.exceptAll(sales).isEmpty() and sales.exceptAll(joined).isEmpty()


def test_short_store_ttl_expires_half_of_the_weeks(spark, paths, grid):
    store = FeatureStore(spark, retail.definitions(*paths, store_ttl=retail.SHORT_STORE_TTL))
    spine = spines.weeks_from(grid, T0, 104)
    out = store.get_historical_features(spine, ["store_features:region"])
    assert out.where("region IS NULL").count() == 32_130


def test_requests_of_an_earlier_decade_find_nothing(spark, paths, grid):
    store = FeatureStore(spark, retail.definitions(*paths))
    a, b = (F.lit(d).cast("date") for d in ("2010-02-05", "2012-10-26"))
    out = store.get_historical_features(spines.anchored(grid, a, b), "training_features")
    assert out.count() == 90_090 and prep.drop_null_target(out).isEmpty()


def test_train_and_score(spark, paths, table):
    rows = stored(training.prepare(table), "prepared")
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sizes == {"train": 52_416, "val": 13_104}
    last_train = rows.where("split = 'train'").agg(F.max(retail.TS)).first()[0]
    assert rows.where("split = 'val'").agg(F.min(retail.TS)).first()[0] >= last_train

    columns = prep.numeric_features(rows)
    assert len(columns) == 19
    model = scoring.train(rows.where("split = 'train'"), columns, "gbt", maxIter=10, maxDepth=5, seed=1)
    quality = scoring.evaluate(model, rows.where("split = 'val'")).first()
    assert quality["n_rows"] == 13_104 and quality["mape"] < 15

    store = FeatureStore(spark, retail.definitions(*paths))
    store.materialize()
    entities = [{"store_id": s, "dept_id": d} for s in (1, 10, 25, 45) for d in (1, 5, 10, 14)]
    data = [{"name": "entities", "shape": [16], "datatype": "BYTES", "data": entities}]
    asked = spark.createDataFrame([(1, json.dumps({"inputs": data}))], "request_id long, payload string")
    answer = scoring.score_requests(
        asked, model, lambda e: store.get_online_features(e, "inference_features")
    ).first()
    output = json.loads(answer["response"])["outputs"][0]
    assert output["shape"] == [16] and output["datatype"] == "FP32"

    newest = rows.where(F.col(retail.TS) == F.lit("2023-12-23").cast("timestamp_ntz"))
    direct = {(r["store_id"], r["dept_id"]): r["prediction"] for r in model.predict(newest.select(*KEYS, *columns)).collect()}
    want = [direct[(e["store_id"], e["dept_id"])] for e in entities]
    assert output["data"] == pytest.approx(want, rel=1e-5)
