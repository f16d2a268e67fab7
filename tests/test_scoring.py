import json

import pytest
from pyspark.sql import functions as F

from weekloom import scoring
from weekloom.session import fresh_path, stored

COLUMNS = ["lag_1", "size"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).select(
        F.col("id").alias("store_id"),
        (F.col("id") * 10.0 + 2000).alias("lag_1"),
        (F.col("id") % 7).cast("double").alias("size"),
        F.exp(F.col("id") / 200.0 + 8).alias("weekly_sales"),
    )


@pytest.mark.parametrize("kind,log", [("linear", True), ("linear", False), ("gbt", True)])
def test_fit_save_load_predict(spark, rows, kind, log):
    params = {"maxIter": 4} if kind == "gbt" else {}
    model = scoring.train(rows, COLUMNS, kind, use_log_transform=log, **params)
    path = fresh_path(spark, "model")
    model.save(spark, path)
    again = scoring.SalesModel.load(spark, path)
    assert again.use_log_transform is log and again.feature_columns == tuple(COLUMNS)
    one = sorted(map(tuple, model.predict(rows).collect()))
    two = sorted(map(tuple, again.predict(rows).collect()))
    assert one == two and len(one) == 400
    loss = scoring.evaluate(again, rows).first()
    assert loss["n_rows"] == 400 and loss["val_loss"] < 0.2
    if kind == "gbt":
        losses = scoring.loss_by_iteration(model, rows)
        assert len(losses) == 4 and losses[-1] <= losses[0]
        assert losses[-1] == pytest.approx(loss["val_loss"], rel=1e-6)


def test_a_logarithmic_relation_is_learned_exactly(rows):
    model = scoring.train(rows.withColumn("size", F.col("size") * 0), COLUMNS)
    score = scoring.evaluate(model, rows.withColumn("size", F.lit(0.0))).first()
    assert score["mape"] < 0.1


def request(name, data):
    return {"inputs": [{"name": name, "shape": [len(data)], "datatype": "BYTES", "data": data}]}


def test_decode(spark):
    both = {"inputs": request("features", [[1.5, 2]])["inputs"] + request("entities", [])["inputs"]}
    payloads = [
        (1, json.dumps(request("entities", [{"store_id": 1, "dept_id": 3}, {"store_id": 2, "dept_id": 4}]))),
        (2, json.dumps(request("features", [[1.5, 2.5], [3, 4]]))),
        (3, json.dumps(both)),
        (4, json.dumps({"inputs": []})),
        (5, "not json"),
    ]
    df = spark.createDataFrame(payloads, "request_id long, payload string")
    decoded = scoring.decode_requests(df, on_error="column")
    asked = [tuple(r) for r in scoring.request_rows(decoded).orderBy("request_id", "pos").collect()]
    assert asked == [(1, 0, 1, 3), (1, 1, 2, 4)]
    given = scoring.feature_rows(decoded, COLUMNS).orderBy("request_id", "pos").collect()
    assert [tuple(r) for r in given] == [(2, 0, 1.5, 2.5), (2, 1, 3.0, 4.0), (3, 0, 1.5, 2.0)]
    assert [r["request_id"] for r in decoded.where("error is not null").orderBy("request_id").collect()] == [4, 5]
    with pytest.raises(Exception, match="entities"):
        scoring.decode_requests(df).collect()


def test_encode_keeps_order(spark):
    df = spark.createDataFrame([(7, 1, 2.5), (7, 0, 1.5)], "request_id long, pos int, prediction double")
    got = json.loads(scoring.encode_responses(df).first()["response"])
    assert got["model_name"] == "sales-forecast" and got["id"] == "7"
    assert got["outputs"] == [{"name": "predictions", "shape": [2], "datatype": "FP32", "data": [1.5, 2.5]}]


def test_score_requests_from_entities_and_features(spark, rows):
    model = scoring.train(rows, COLUMNS)
    online = rows.select("store_id", *COLUMNS)
    payloads = [
        (1, json.dumps(request("entities", [{"store_id": 5, "dept_id": 1}]))),
        (2, json.dumps(request("features", [[2050.0, 5.0]]))),
        (3, json.dumps({"inputs": []})),
    ]
    out = scoring.score_requests(
        spark.createDataFrame(payloads, "request_id long, payload string"),
        model,
        lambda asked: asked.join(online, "store_id", "left"),
    ).orderBy("request_id").collect()
    data = [json.loads(r["response"])["outputs"][0]["data"] for r in out[:2]]
    assert data[0] == data[1] and out[2]["response"] is None and "entities" in out[2]["error"]


def test_report(spark):
    df = spark.createDataFrame([(1, 3, 96763.45)], "store_id long, dept_id long, prediction double")
    assert tuple(scoring.prediction_report(df, ["store_id", "dept_id"]).first()) == (1, 3, "$96,763")


def test_every_request_has_one_answer(spark, rows):
    model = scoring.train(rows, COLUMNS)
    online = rows.select("store_id", *COLUMNS)
    payloads = [
        (1, json.dumps(request("entities", [{"store_id": 5, "dept_id": 1}]))),
        (2, json.dumps(request("features", []))),
        (3, json.dumps(request("entities", [{"store_id": "abc", "dept_id": 1}]))),
        (4, json.dumps(request("features", [[2050.0, 5.0]]))),
        (4, json.dumps(request("features", [[2050.0, 5.0]]))),
        (5, "not json"),
    ]
    out = scoring.score_requests(
        spark.createDataFrame(payloads, "request_id long, payload string"), model,
        lambda asked: asked.join(online, "store_id", "left"),
    ).collect()
    assert sorted(r["request_id"] for r in out) == [1, 2, 3, 4, 4, 5]
    by_id = {r["request_id"]: r for r in out}
    assert json.loads(by_id[2]["response"])["outputs"][0]["shape"] == [0] and by_id[2]["error"] is None
    assert "keys" in by_id[3]["error"] and "unique" in by_id[4]["error"] and by_id[5]["response"] is None


def test_other_keys(spark):
    df = spark.createDataFrame([(1, json.dumps(request("entities", [{"sku": "x"}])))], "request_id long, payload string")
    decoded = scoring.decode_requests(df, keys={"sku": "string"})
    assert [tuple(r) for r in scoring.request_rows(decoded).collect()] == [(1, 0, "x")]


def test_one_bad_entity_leaves_the_others(spark):
    payloads = [
        '{"inputs":[{"name":"entities","data":[{"store_id":1,"dept_id":2},{"store_id":"x","dept_id":3},{"dept_id":4},7,null]}]}',
        '{"inputs":[{"name":"entities","data":"[{\\"store_id\\":\\"5\\",\\"dept_id\\":6}]"}]}',
        '{"inputs":[{"name":"entities","data":[]}]}', "not json", None, '{"inputs":[{"name":"features","data":[[1.0]]}]}',
    ]
    df = spark.createDataFrame(list(enumerate(payloads)), "request_id int, payload string")
    got = sorted((tuple(r) for r in scoring.entity_rows(df).collect()), key=str)
    bad, none = "no usable store_id, dept_id", "request holds no rows of entities"
    assert got == sorted([
        (0, 0, 1, 2, None), (0, 1, None, 3, "no usable store_id"), (0, 2, None, 4, "no usable store_id"), (0, 3, None, None, bad),
        (0, 4, None, None, bad), (1, 0, 5, 6, None), *[(i, None, None, None, none) for i in (2, 3, 4, 5)],
    ], key=str)


def test_the_best_round_is_the_one_that_is_kept(spark):
    import random

    rng = random.Random(5)
    noise = [(float(i % 40), 2000.0 + 50 * (i % 40) + rng.uniform(-900, 900)) for i in range(160)]
    fit = spark.createDataFrame(noise[:80], "x double, weekly_sales double")
    check = spark.createDataFrame(noise[80:], "x double, weekly_sales double")
    model, log = scoring.train_to_best(fit, check, ["x"], maxIter=12, maxDepth=6, stepSize=0.8, seed=1)
    steps = {r["step"]: r["val_loss"] for r in log.collect()}
    best = log.where("best").first()["step"]
    assert len(steps) == 12 and best == min(steps, key=steps.get) < 12
    assert len(model.model.trees) == best
    path = fresh_path(spark, "model")
    model.save(spark, path)
    loaded = scoring.SalesModel.load(spark, path)
    assert len(loaded.model.trees) == best
    assert loaded.predict(check).first()["prediction"] == pytest.approx(model.predict(check).first()["prediction"])
    assert scoring.evaluate(model, check).first()["val_loss"] == pytest.approx(steps[best])
    stopped, short = scoring.train_to_best(fit, check, ["x"], patience=0.01, maxIter=12, maxDepth=6, stepSize=0.8, seed=1)
    assert short.count() < 12 and len(stopped.model.trees) <= short.count()


@pytest.mark.parametrize("n,params", [
    (300, {"maxIter": 3, "maxDepth": 3}),
    (30_000, {"maxIter": 4, "maxDepth": 4, "stepSize": 0.9}),
    (30_000, {"maxIter": 2, "maxDepth": 6, "maxBins": 300, "minInstancesPerNode": 40, "minInfoGain": 0.001}),
])
def test_rows_beyond_the_cache_give_the_trees_of_spark(spark, monkeypatch, n, params):
    from weekloom import boosting

    made = spark.range(0, n, 1, 5).select(
        (F.hash("id") % 977).cast("double").alias("a"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.hash("id", F.lit(1)) % 5000 / 7).alias("b"),
        (F.col("id") % 2).alias("c"), F.lit(3).alias("constant"), (F.hash("id", F.lit(2)) % 9).alias("d"),
    ).withColumn("weekly_sales", F.exp(F.col("a") / 400 + F.sin(F.col("b") / 100) + F.col("c") * F.col("d") / 9 + 8))
    rows, columns = stored(made, "boosted"), ["a", "b", "c", "constant", "d"]
    want = scoring.train(rows, columns, "gbt", seed=42, **params)

    def never(self, rows):
        raise AssertionError("rows beyond the cache went to Spark's learner")

    monkeypatch.setattr(boosting, "CACHED_ROWS", n - 1)
    monkeypatch.setattr(boosting, "PASS_CELLS", 700)  # a few nodes a pass
    monkeypatch.setattr(boosting.GBTRegressor, "_fit", never)
    got = scoring.train(rows, columns, "gbt", seed=42, **params)
    assert got.model.treeWeights == want.model.treeWeights

    def splits(model):
        return [line.split("Predict")[0] for line in model.model.toDebugString.splitlines()[1:]]

    assert splits(got) == splits(want)
    assert got.model.featureImportances.toArray() == pytest.approx(want.model.featureImportances.toArray(), rel=1e-6)
    assert scoring.loss_by_iteration(got, rows) == pytest.approx(scoring.loss_by_iteration(want, rows), rel=1e-9)
    path = fresh_path(spark, "model")
    got.save(spark, path)
    again = scoring.SalesModel.load(spark, path)
    assert scoring.loss_by_iteration(again, rows) == pytest.approx(scoring.loss_by_iteration(want, rows), rel=1e-9)


def test_the_best_round_of_rows_beyond_the_cache(spark, monkeypatch):
    from weekloom import boosting

    made = spark.range(0, 4000, 1, 3).select(
        (F.hash("id") % 40).cast("double").alias("x"), (F.hash("id", F.lit(1)) % 900 + 3000.0).alias("noise")
    ).withColumn("weekly_sales", 50 * F.col("x") + F.col("noise"))
    fit, check = stored(made.where("noise < 3500"), "fit"), stored(made.where("noise >= 3500"), "check")
    # Nodes of few rows have several splits of equal gain, of which either learner may take another.
    params = {"maxIter": 6, "maxDepth": 4, "stepSize": 0.9, "seed": 1, "minInstancesPerNode": 30}
    want, log = scoring.train_to_best(fit, check, ["x", "noise"], **params)

    def never(self, rows):
        raise AssertionError("rows beyond the cache went to Spark's learner")

    monkeypatch.setattr(boosting, "CACHED_ROWS", 100)
    monkeypatch.setattr(boosting.GBTRegressor, "_fit", never)
    got, again = scoring.train_to_best(fit, check, ["x", "noise"], **params)
    assert len(got.model.trees) == len(want.model.trees)
    for one, two in zip(log.orderBy("step").collect(), again.orderBy("step").collect()):
        assert one["best"] == two["best"] and one["val_loss"] == pytest.approx(two["val_loss"], rel=1e-9)
