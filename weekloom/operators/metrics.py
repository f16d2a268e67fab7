"""Evaluation aggregates and tables of runs and model versions."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.commits import CommitLog
from .skew import left_join
from .windows import positions


def mape(actual: Column, predicted: Column, floor: float = 1000.0) -> Column:
    """Mean absolute percentage error over actuals above ``floor``; NULL if there are none."""
    return F.avg(F.when(actual > floor, F.abs((actual - predicted) / actual))) * 100


def mse(actual: Column, predicted: Column) -> Column:
    return F.avg((actual - predicted) * (actual - predicted))


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.sum(weight)


def profile(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def best_step(
    log: DataFrame, by: Sequence[str] = ("run_id",), loss: str = "val_loss", keep: Sequence[str] = ("step", "mape")
) -> DataFrame:
    """The step of lowest loss per run, the earliest of equals, with its other metrics."""
    best = F.min(F.struct(loss, *keep)).alias("b")
    return log.groupBy(*by).agg(best).select(*by, *[F.col("b")[c].alias(c) for c in (loss, *keep)])


def top_runs(runs: DataFrame, k: int = 5, order: str = "start_time", tie: str = "run_id") -> DataFrame:
    """The ``k`` most recent runs."""
    return runs.orderBy(F.col(order).desc(), F.col(tie)).limit(k)


def metrics_long(df: DataFrame, run_id: Column, step: Column, values: dict[str, Column]) -> DataFrame:
    """One row per (run, step, metric)."""
    pairs = [F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in values.items()]
    return df.select(
        run_id.alias("run_id"), step.alias("step"), F.inline(F.array(*pairs))
    )


def append_metrics(log: DataFrame, path: str) -> None:
    log.select("run_id", "step", "metric", "value").write.mode("append").parquet(path)


def append_params(spark: SparkSession, path: str, run_id: str, params: dict) -> None:
    """Parameters of one run as text, one row each."""
    rows = [(run_id, k, str(v)) for k, v in params.items()]
    spark.createDataFrame(rows, "run_id string, param string, value string").write.mode(
        "append"
    ).parquet(path)


def tag_versions(versions: DataFrame, tags: dict[str, Column]) -> DataFrame:
    """Add or replace entries of the ``tags`` map."""
    pairs = [p for k, v in tags.items() for p in (F.lit(k), v.cast("string"))]
    given = F.create_map(*pairs)
    if "tags" in versions.columns:
        kept = F.map_filter("tags", lambda k, _: ~k.isin(list(tags)))
        given = F.map_concat(kept, given)
    return versions.withColumn("tags", given)


def next_versions(
    new: DataFrame,
    current: DataFrame | None = None,
    name: str = "name",
    order: Sequence[str] = ("start_time", "run_id"),
) -> DataFrame:
    """Number new registrations per model name after its highest version so far."""
    out = positions(new, [name], order, "version")
    if current is None:
        return out
    last = current.groupBy(name).agg(F.max("version").alias("__last"))
    out = left_join(out, last, [name])
    return out.withColumn("version", F.col("version") + F.coalesce("__last", F.lit(0))).drop("__last")


def latest_version(versions: DataFrame, name: str = "name", keep: Sequence[str] = ()) -> DataFrame:
    newest = versions.groupBy(name).agg(F.max(F.struct("version", *keep)).alias("r"))
    return newest.select(name, *[F.col("r")[c].alias(c) for c in ("version", *keep)])


class ModelVersions:
    """Registered versions in one folder: a file for each, written only if its number is free.

    Two writers that see the same highest version both try the next one; one of them gets it and
    the other tries on, so numbers have no gap and no number is given twice.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.folder}/model-{quote(name, safe='')}")

    def register(self, name: str, run_id: str, tags: dict[str, str] | None = None) -> int:
        """The new version of the model ``name``."""
        return self._log(name).append(
            lambda n: {"name": name, "version": n, "run_id": run_id, "tags": tags or {}}
        )

    def latest(self, name: str) -> dict | None:
        return self._log(name).last()[1]

    def frame(self) -> DataFrame:
        """All versions of all models."""
        schema = "name string, version bigint, run_id string, tags map<string,string>"
        return self.spark.read.schema(schema).json(f"{self.folder}/model-*/*.json")
