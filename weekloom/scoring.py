"""Training a regressor, batch scoring, and JSON requests and responses."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .functions.scalar import from_target, to_target
from .operators import metrics
from .operators.prep import Scaler, feature_matrix, fill_zero
from .operators.skew import left_join
from .session import stored

TARGET = "weekly_sales"
MODELS = {"linear": LinearRegressionModel, "gbt": GBTRegressionModel}


@dataclass
class SalesModel:
    """A fitted regressor with all that scoring needs: column order, scalers, log flag."""

    kind: str
    model: Model
    feature_columns: tuple[str, ...]
    scaler_x: Scaler
    scaler_y: Scaler
    use_log_transform: bool

    def predict(self, matrix: DataFrame, output: str = "prediction") -> DataFrame:
        """Scale, predict, undo target scaling and logarithm. NULL and absent features are 0."""
        kept = [c for c in matrix.columns if c not in self.feature_columns]
        ready = self.scaler_x.transform(feature_matrix(matrix, self.feature_columns, keep=kept))
        scored = self.model.transform(assemble(ready, self.feature_columns))
        value = self.scaler_y.unscale(self.scaler_y.columns[0], F.col("prediction"))
        if self.use_log_transform:
            value = from_target(value)
        return scored.select(*kept, value.alias(output))

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        meta = {
            "kind": self.kind,
            "input_dim": len(self.feature_columns),
            "feature_columns": self.feature_columns,
            "scaler_x": self.scaler_x.to_json(),
            "scaler_y": self.scaler_y.to_json(),
            "use_log_transform": self.use_log_transform,
        }
        one = spark.createDataFrame([(json.dumps(meta),)], "value string")
        one.write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SalesModel":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        return cls(
            meta["kind"],
            MODELS[meta["kind"]].load(f"{path}/model"),
            tuple(meta["feature_columns"]),
            Scaler.from_json(meta["scaler_x"]),
            Scaler.from_json(meta["scaler_y"]),
            meta["use_log_transform"],
        )


def assemble(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(df)


def train(
    training: DataFrame,
    columns: Sequence[str],
    kind: str = "linear",
    target: str = TARGET,
    use_log_transform: bool = True,
    validation: DataFrame | None = None,
    **params,
) -> SalesModel:
    """Fit on the rows of ``training``: scaled features, scaled and by default log target.

    ``validation`` rows, for boosted trees, tell when to stop; scalers do not see them. More rows
    than can be cached are boosted by :mod:`weekloom.boosting`, with the same result.
    """
    goal = to_target(F.col(target)) if use_log_transform else F.col(target)

    def prepared(rows: DataFrame) -> DataFrame:
        return fill_zero(rows.select(target, *columns), columns).withColumn("__y", goal)

    filled = prepared(training)
    scaler = Scaler.fit(filled, [*columns, "__y"])
    scaler_x = Scaler(scaler.columns[:-1], scaler.means[:-1], scaler.stds[:-1])
    scaler_y = Scaler(scaler.columns[-1:], scaler.means[-1:], scaler.stds[-1:])
    held = F.lit(False).alias("held")
    rows = scaler.transform(filled).select("*", held)
    if validation is not None:
        rows = rows.unionByName(scaler.transform(prepared(validation)).select("*", F.lit(True).alias("held")))
        params["validationIndicatorCol"] = "held"
    ready = assemble(rows, columns).select("features", F.col("__y").alias("label"), "held")
    if kind == "gbt" and params.keys() <= boosting.PARAMS and (n := training.count()) > boosting.CACHED_ROWS:
        doubles = rows.select(*[F.col(c).cast("double").alias(c) for c in (*columns, "__y")])
        model = boosting.fit(doubles, columns, "__y", GBTRegressor(**params), n)
        return SalesModel(kind, model, tuple(columns), scaler_x, scaler_y, use_log_transform)
    if kind == "linear":
        learner = LinearRegression(**params)
    elif kind == "gbt":
        learner = GBTRegressor(**params)
    else:
        raise ValueError(f"unknown model kind {kind!r}")
    return SalesModel(kind, learner.fit(ready), tuple(columns), scaler_x, scaler_y, use_log_transform)


def evaluate(model: SalesModel, validation: DataFrame, target: str = TARGET) -> DataFrame:
    """One row: loss on the scaled target, MAPE on the sales scale, rows."""
    scored = model.predict(validation.select(target, *model.feature_columns))
    name = model.scaler_y.columns[0]
    forward = (lambda c: to_target(c)) if model.use_log_transform else (lambda c: c)
    actual = model.scaler_y.scale(name, forward(F.col(target)))
    predicted = model.scaler_y.scale(name, forward(F.col("prediction")))
    return scored.agg(
        metrics.mse(actual, predicted).alias("val_loss"),
        metrics.mape(F.col(target), F.col("prediction")).alias("mape"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def loss_by_iteration(model: SalesModel, validation: DataFrame, target: str = TARGET) -> list[float]:
    """Validation loss after each boosting round, on the scaled target."""
    if model.kind != "gbt":
        raise ValueError("only boosted models have iterations")
    goal = to_target(F.col(target)) if model.use_log_transform else F.col(target)
    label = model.scaler_y.scale(model.scaler_y.columns[0], goal).alias("label")
    ready = feature_matrix(validation.withColumn("label", label), model.feature_columns, keep=["label"])
    ready = assemble(model.scaler_x.transform(ready), model.feature_columns)
    return model.model.evaluateEachIteration(ready.select("features", "label"), "squared")


def truncated(model: SalesModel, rounds: int) -> SalesModel:
    """The boosted model after its first ``rounds`` rounds."""
    if model.kind != "gbt":
        raise ValueError("only boosted models have iterations")
    old = model.model._java_obj
    sc = SparkSession.active().sparkContext
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = old.trees()[i], old.treeWeights()[i]
    new = sc._jvm.org.apache.spark.ml.regression.GBTRegressionModel(old.uid(), trees, weights, old.numFeatures())
    return replace(model, model=GBTRegressionModel(old.copyValues(new, old.extractParamMap())))


def train_to_best(
    training: DataFrame, validation: DataFrame, columns: Sequence[str], target: str = TARGET, patience: float = 0.0, **params
) -> tuple[SalesModel, DataFrame]:
    """Boosted trees cut back to their best round, and the loss log (step from 1, val_loss, best).

    With ``patience`` Spark itself stops once a round lowers the validation loss by less than that
    share: the rows of both frames are then fitted together, told apart by an indicator column.
    Of the rounds that were run the first one of least loss decides what is kept.
    """
    model = train(training, columns, "gbt", target, validation=validation if patience else None, validationTol=patience, **params)
    losses = loss_by_iteration(model, validation, target)
    best = min(range(len(losses)), key=lambda i: losses[i])
    rows = [(i + 1, float(v), i == best) for i, v in enumerate(losses)]
    log = validation.sparkSession.createDataFrame(rows, "step int, val_loss double, best boolean")
    return truncated(model, best + 1), log


# -- JSON requests -----------------------------------------------------------

REQUEST = "inputs array<struct<name string, shape array<int>, datatype string, data string>>"
KEYS = {"store_id": "bigint", "dept_id": "bigint"}
FEATURE_ROWS = "array<array<float>>"


def decode_requests(
    df: DataFrame, payload: str = "payload", on_error: str = "raise", keys: dict[str, str] | None = None
) -> DataFrame:
    """Parse payloads into ``entities`` or ``features``; the other one is NULL.

    ``keys`` gives the names and types of an entity's keys. Non-empty entities win over
    features. A payload with neither, or with an entity that lacks a key or whose key is of
    another type, fails the job, or with ``on_error="column"`` fills ``error``.
    """
    keys = keys or KEYS
    entity_rows = f"array<struct<{', '.join(f'`{k}`: {t}' for k, t in keys.items())}>>"
    inputs = F.from_json(payload, REQUEST)["inputs"]

    def named(name: str, schema: str) -> Column:
        data = F.try_element_at(F.filter(inputs, lambda i: i["name"] == name), F.lit(-1))["data"]
        return F.from_json(data, schema)

    out = df.withColumns(
        {"entities": named("entities", entity_rows), "features": named("features", FEATURE_ROWS)}
    )
    given = F.coalesce(F.size("entities") > 0, F.lit(False))
    nothing = ~given & F.col("features").isNull()
    unkeyed = given & F.exists(
        "entities", lambda e: reduce(lambda a, b: a | b, (e[k].isNull() for k in keys), e.isNull())
    )
    message = F.when(nothing, F.lit("request holds no rows of entities and no features")).otherwise(
        F.lit("request holds an entity without usable keys")
    )
    failed = nothing | unkeyed
    if on_error == "raise":
        error = F.when(failed, F.raise_error(message))
    else:
        error = F.when(failed, message)
    return out.withColumns(
        {
            "features": F.when(~given, F.col("features")),
            "entities": F.when(given, F.col("entities")),
            "error": error.cast("string"),
        }
    )


def request_rows(decoded: DataFrame, request_id: str = "request_id") -> DataFrame:
    """One row per requested entity, with its place in the request."""
    return decoded.where(F.col("error").isNull()).select(
        request_id, F.posexplode("entities").alias("pos", "entity")
    ).select(request_id, "pos", "entity.*")


def entity_rows(
    df: DataFrame, payload: str = "payload", request_id: str = "request_id", keys: dict[str, str] | None = None
) -> DataFrame:
    """One row per requested entity, each with an error of its own: (request_id, pos, keys…, error).

    Payloads are parsed as VARIANT, so an entity without usable keys gets an error and its
    neighbours stay as they are. A payload that is no JSON, or has no entities, gives one row
    without a place. ``data`` may be an array or the text of one.
    """
    keys = keys or KEYS
    parsed = F.try_parse_json(payload)
    inputs = F.try_variant_get(parsed, "$.inputs", "array<variant>")
    named = F.filter(inputs, lambda i: F.try_variant_get(i, "$.name", "string") == "entities")
    data = F.try_variant_get(F.try_element_at(named, F.lit(-1)), "$.data", "variant")
    text = F.try_parse_json(F.try_variant_get(data, "$", "string"))
    rows = F.coalesce(F.try_variant_get(data, "$", "array<variant>"), F.try_variant_get(text, "$", "array<variant>"))
    each = df.select(request_id, F.posexplode_outer(rows).alias("pos", "entity"))
    got = each.withColumns({k: F.try_variant_get("entity", f"$.{k}", t) for k, t in keys.items()})
    lacking = F.array_compact(F.array(*[F.when(F.col(k).isNull(), F.lit(k)) for k in keys]))
    error = F.when(F.col("pos").isNull(), F.lit("request holds no rows of entities")).when(
        F.size(lacking) > 0, F.concat(F.lit("no usable "), F.array_join(lacking, ", "))
    )
    return got.select(request_id, "pos", *keys, error.alias("error"))


def feature_rows(decoded: DataFrame, columns: Sequence[str], request_id: str = "request_id") -> DataFrame:
    """One row per supplied feature array, as named columns; short arrays give NULL."""
    return decoded.where(F.col("error").isNull()).select(
        request_id, F.posexplode("features").alias("pos", "row")
    ).select(request_id, "pos", *[F.get("row", F.lit(i)).alias(c) for i, c in enumerate(columns)])


def encode_responses(
    df: DataFrame, model_name: str = "sales-forecast", request_id: str = "request_id", value: str = "prediction"
) -> DataFrame:
    """One JSON response per request, predictions in request order.

    A group holds the rows of one request document, so it is as small as that document.
    """
    row = F.when(F.col("pos").isNotNull(), F.struct("pos", F.col(value).cast("float").alias("p")))
    ordered = F.array_sort(F.collect_list(row))
    data = F.transform(ordered, lambda r: r["p"])
    grouped = df.groupBy(request_id).agg(data.alias("data"))
    output = F.struct(
        F.lit("predictions").alias("name"),
        F.array(F.size("data")).alias("shape"),
        F.lit("FP32").alias("datatype"),
        F.col("data"),
    )
    response = F.struct(
        F.lit(model_name).alias("model_name"),
        F.col(request_id).cast("string").alias("id"),
        F.array(output).alias("outputs"),
    )
    return grouped.select(request_id, F.to_json(response).alias("response"))


def score_requests(
    requests: DataFrame, model: SalesModel, online: Callable[[DataFrame], DataFrame], on_error: str = "column"
) -> DataFrame:
    """Decode, look up or take features, predict, encode: one answer for every request.

    A failed request has its error, one without rows an empty list of predictions. A
    request id that stands for several documents is an error of each of them.
    """
    repeats = requests.groupBy("request_id").agg(F.count(F.lit(1)).alias("__times"))
    decoded = left_join(decode_requests(requests, on_error=on_error), repeats, ["request_id"])
    twice = F.when(F.col("__times") > 1, F.lit("request id is not unique"))
    # Parsed once: everything below reads this table.
    decoded = stored(decoded.withColumn("error", F.coalesce(twice, "error")).drop("__times"), "decoded")
    looked_up = online(request_rows(decoded))
    given = feature_rows(decoded, model.feature_columns)
    keep = ["request_id", "pos"]
    scored = model.predict(
        feature_matrix(looked_up, model.feature_columns, keep).unionByName(
            feature_matrix(given, model.feature_columns, keep)
        )
    )
    answers = encode_responses(scored)
    right = decoded.where("error IS NULL").select("request_id")
    empty = F.lit(None).cast("int").alias("pos"), F.lit(None).cast("float").alias("prediction")
    bare = right.join(answers.select("request_id"), "request_id", "left_anti").select("request_id", *empty)
    failed = decoded.where("error IS NOT NULL").select("request_id", "error")
    return answers.unionByName(encode_responses(bare)).unionByName(failed, allowMissingColumns=True)


def prediction_report(scored: DataFrame, keys: Sequence[str], value: str = "prediction") -> DataFrame:
    """Entities beside their prediction as whole dollars."""
    money = F.concat(F.lit("$"), F.format_number(F.round(value, 0), 0))
    return scored.select(*keys, money.alias("prediction"))
