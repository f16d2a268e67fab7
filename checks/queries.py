"""One callable per operator over the driver tables: (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom import Entity, FeatureService, FeatureStore, FeatureView, Field, Source
from weekloom.functions import calendar
from weekloom.functions.literals import moment
from weekloom.functions.scalar import from_target, to_target
from weekloom.operators import metrics, online, prep, windows
from weekloom.operators.pit import AsOf, point_in_time
from weekloom.plans import retail, training
from weekloom.plans.incremental import FeatureLog
from weekloom.plans.warehouse import Warehouse
from weekloom.registry import closure
from weekloom.session import fresh_path, stored
from weekloom.sources import generator, layout, tables
from weekloom import scoring

KEYS = list(retail.KEYS)
TS = retail.TS
LINE = ["l_orderkey", "l_linenumber"]
# Fridays and weekly features: few rows per series on both sides, so no measuring; the
# spine comes partitioned by series.
WEEKLY = {"strategy": "window", "requests_clustered": True}
FORECAST = ["lag_1", "rolling_mean_4w"]


ROUNDING = True


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to fixed digits, so that both engines agree on the last bits."""
    if not ROUNDING:
        return df
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.select(
        *[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns]
    )


# -- shared inputs ---------------------------------------------------------


@lru_cache(maxsize=None)
def at(spark: SparkSession, folder: str) -> Warehouse:
    return Warehouse(spark, folder)


def sales_features(spark: SparkSession, folder: str) -> DataFrame:
    first, _ = at(spark, folder).ship_span
    return retail.build_sales_features(at(spark, folder).sales_base(), first)


def feature_store(spark: SparkSession, folder: str, **ttl) -> FeatureStore:
    objects = retail.definitions(
        lambda s: sales_features(s, folder),
        lambda s: at(s, folder).store_features(),
        clustered=True,
        stores_clustered=True,
        **ttl,
    )
    return FeatureStore(spark, objects)


def shipment_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One request per order line: what was known when it shipped."""
    lines = at(spark, folder).shipments()
    return lines.select(*LINE, *KEYS, F.col("l_shipdate").alias(TS))


def training_table(spark: SparkSession, folder: str) -> DataFrame:
    return feature_store(spark, folder).get_historical_features(
        at(spark, folder).friday_spine(), "training_features", **WEEKLY
    )


def customer_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every customer asks for a series; department 7 does not exist."""
    return at(spark, folder).table("customer").select(
        F.col("c_custkey").alias("pos"),
        F.col("c_nationkey").cast("bigint").alias("store_id"),
        (F.col("c_custkey") % 7 + 1).alias("dept_id"),
    )


def sales_windows(spark: SparkSession, folder: str, **options) -> DataFrame:
    base = at(spark, folder).sales_base()
    options.setdefault("max_group_rows", None)  # at most one row per series and week
    return windows.sales_windows(base, **options)


# -- sources and sinks -----------------------------------------------------


def event_view(folder: str) -> FeatureView:
    return FeatureView(
        "user_events",
        (Entity("user_id"),),
        (Field("value", T.DoubleType()), Field("event_type", T.StringType())),
        Source("event_source", path=f"{folder}/events.parquet", timestamp_field="ts"),
    )


def scan_feature_view(spark, folder):
    return tables.scan_view(spark, event_view(folder))


def cached_training_set(spark, folder):
    """The second read finds the table by its fingerprint and builds nothing."""
    where = fresh_path(spark, "training-sets")
    first = tables.cached(training_table(spark, folder), where)
    again = tables.cached(training_table(spark, folder), where)
    if sorted(first.inputFiles()) != sorted(again.inputFiles()):
        raise AssertionError("built twice")
    return rounded(again)


def generate_sales(spark, folder, seed=42):
    spine = at(spark, folder).weekly_spine()
    first, _ = at(spark, folder).ship_span
    week = F.datediff(F.col(TS).cast("date"), first) / 7
    return generator.sales_rows(spine, week, seed)


def generate_sales_det(spark, folder):
    return generate_sales(spark, folder, seed=None)


def write_read_roundtrip(spark, folder):
    path = fresh_path(spark, "sales-features")
    made = sales_features(spark, folder)
    made.write.parquet(path)
    return rounded(spark.read.schema(made.schema).parquet(path))


def materialize_latest(spark, folder):
    return online.latest(
        tables.scan_view(spark, event_view(folder)),
        ["user_id"],
        ["value", "event_type"],
        "ts",
        datetime(2024, 1, 5),
        datetime(2024, 1, 25),
    )


def materialize_sales(spark, folder):
    store = feature_store(spark, folder)
    store.materialize(end=datetime(2000, 6, 30), views=["sales_features"])
    store.materialize(views=["sales_features"])
    return rounded(store.online("sales_features").drop(online.BUCKETS, online.BUCKET))


# Weeks at which incremental jobs stop in between.
STEPS = (datetime(1998, 1, 5), datetime(2000, 7, 3), None)


def _feature_log(spark, folder, steps=STEPS):
    log = FeatureLog(spark, fresh_path(spark, "feature-log"))
    for until in steps:
        log.advance(at(spark, folder), until)
    return log


def sales_features_incremental(spark, folder):
    """Three steps; each continues the series from their tails and reads its own weeks only."""
    return rounded(_feature_log(spark, folder).read())


def scaler_incremental(spark, folder):
    """Statistics merged from those of each step."""
    return rounded(_feature_log(spark, folder).scaler().scaler().frame(spark))


def materialize_incremental(spark, folder):
    """After each step only rows since the last one are read and only touched buckets written."""
    log = _feature_log(spark, folder, STEPS[:1])
    objects = retail.definitions(lambda s: log.read(), lambda s: at(s, folder).store_features())
    store = FeatureStore(spark, objects, root=fresh_path(spark, "store"))
    for until in STEPS[1:]:
        store.materialize_incremental(views=["sales_features"])
        log.advance(at(spark, folder), until)
    store.materialize_incremental(views=["sales_features"])
    return rounded(store.online("sales_features").drop(online.BUCKETS, online.BUCKET))


def scaler_stats(spark, folder):
    features = sales_features(spark, folder)
    return rounded(prep.scaler_stats(features, prep.numeric_features(features, retail.KEYS)))


# -- registry --------------------------------------------------------------


def registry_features(spark, folder):
    """Declared features with the rows and NULLs their views really hold."""
    registry = feature_store(spark, folder).registry
    measured = None
    for view in registry.views():
        scan = tables.scan_view(spark, view)
        counts = scan.agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in view.feature_names],
        )
        rows = [
            F.struct(F.lit(c).alias("feature"), F.col(f"nulls_{c}").alias("n_null"))
            for c in view.feature_names
        ]
        counts = counts.select(F.lit(view.name).alias("view"), "n_rows", F.inline(F.array(*rows)))
        measured = counts if measured is None else measured.unionByName(counts)
    declared = registry.features_frame(spark).drop("ord")
    return declared.join(measured, ["view", "feature"], "left")


def registry_lineage(spark, folder):
    """Definition edges; edges out of a source carry its row count."""
    registry = feature_store(spark, folder).registry
    counts = None
    for view in registry.views():
        n = view.source.read(spark).agg(F.count(F.lit(1)).alias("n_rows"))
        n = n.select(F.lit("source").alias("from_kind"), F.lit(view.source.name).alias("from_name"), "n_rows")
        counts = n if counts is None else counts.unionByName(n)
    return registry.lineage_frame(spark).join(counts, ["from_kind", "from_name"], "left")


def lineage_closure(spark, folder):
    """Every feature and service that depends on a source, however far, with the source's rows."""
    registry = feature_store(spark, folder).registry
    counts = None
    for view in registry.views():
        n = view.source.read(spark).agg(F.count(F.lit(1)).alias("n_rows"))
        n = n.select(F.lit(f"source:{view.source.name}").alias("from_node"), "n_rows")
        counts = n if counts is None else counts.unionByName(n)
    return closure(registry.feature_edges_frame(spark)).join(counts, "from_node", "left")


# -- projections and fills -------------------------------------------------


def service_projection(spark, folder):
    view = feature_store(spark, folder).registry.view("sales_features")
    part = view[["lag_1", "lag_2", "is_holiday"]]
    return rounded(tables.scan_view(spark, part.view, part.columns))


def inference_features(spark, folder):
    return rounded(
        feature_store(spark, folder).get_historical_features(
            at(spark, folder).friday_spine(), "inference_features", **WEEKLY
        )
    )


def feature_refs(spark, folder):
    refs = ["sales_features:weekly_sales", "sales_features:lag_1", "store_features:store_type"]
    return rounded(
        feature_store(spark, folder).get_historical_features(shipment_requests(spark, folder), refs)
    )


def drop_null_target(spark, folder):
    joined = _shipment_join(spark, folder, ttl=timedelta(days=2))
    return rounded(prep.drop_null_target(joined))


def numeric_features(spark, folder):
    table = training_table(spark, folder)
    return rounded(table.select(*KEYS, TS, *prep.numeric_features(table)))


def feature_matrix(spark, folder):
    table = training_table(spark, folder)
    columns = [*FORECAST, "store_size", "not_there"]
    # Floats near 1e5 keep two decimals.
    matrix = prep.feature_matrix(table, columns, keep=[*KEYS, TS])
    return matrix.select(
        *KEYS, TS, *[F.round(F.col(c).cast("double"), 1).alias(c) for c in columns]
    )


def fill_zero(spark, folder):
    short = feature_store(spark, folder, sales_ttl=timedelta(days=30), store_ttl=timedelta(days=365))
    table = short.get_historical_features(
        at(spark, folder).friday_spine(), "training_features", **WEEKLY
    )
    return rounded(prep.fill_zero(table, prep.numeric_features(table, retail.KEYS)))


# -- windows ---------------------------------------------------------------


def lag_features(spark, folder):
    return rounded(sales_windows(spark, folder).select(*KEYS, TS, *retail.LAG_FEATURES))


def lag_features_split(spark, folder):
    made = sales_windows(spark, folder, max_group_rows=30)
    return rounded(made.select(*KEYS, TS, *retail.LAG_FEATURES))


def rolling_mean(spark, folder):
    return rounded(sales_windows(spark, folder).select(*KEYS, TS, "rolling_mean_4w"))


def rolling_std(spark, folder):
    return rounded(sales_windows(spark, folder).select(*KEYS, TS, "rolling_std_4w"))


def sales_vs_avg(spark, folder):
    return rounded(sales_windows(spark, folder).select(*KEYS, TS, "sales_vs_avg"))


def event_windows(spark, folder, **options):
    """Lag and trailing mean over irregular events; user sizes are measured first."""
    events = at(spark, folder).table("events").select("user_id", "ts", "value")
    made = windows.sales_windows(events, ["user_id"], "ts", "value", lags=(1, 2), **options)
    return rounded(made.select("user_id", "ts", "lag_1", "lag_2", "rolling_mean_4w"))


def event_windows_split(spark, folder):
    """The same with every user of more than forty events cut into buckets."""
    return event_windows(spark, folder, max_group_rows=40)


# -- point-in-time joins ---------------------------------------------------


def _shipment_join(spark, folder, ttl=retail.SALES_TTL, **options):
    columns = ("weekly_sales", "lag_1", "rolling_mean_4w")
    features = sales_windows(spark, folder).select(*KEYS, TS, *columns)
    view = AsOf(features, retail.KEYS, columns, ttl, clustered=True)
    return point_in_time(shipment_requests(spark, folder), [view], **options)


def pit_join(spark, folder):
    return rounded(_shipment_join(spark, folder))


def pit_join_bucketed(spark, folder):
    """The same over views stored in buckets: only the requests are shuffled."""
    store = feature_store(spark, folder)
    stored_views = [
        layout.store_view(spark, v, f"{v.name}_{uuid.uuid4().hex}", path=fresh_path(spark, v.name))
        for v in store.registry.views()
    ]
    refs = ["sales_features:weekly_sales", "sales_features:lag_1", "sales_features:rolling_mean_4w"]
    return rounded(
        FeatureStore(spark, stored_views).get_historical_features(shipment_requests(spark, folder), refs)
    )


def pit_join_split(spark, folder):
    return rounded(_shipment_join(spark, folder, max_group_rows=60))


def pit_join_broadcast(spark, folder):
    """Every series on the last eight Fridays."""
    _, last = at(spark, folder).ship_span
    spine = at(spark, folder).friday_spine().where(
        F.col(TS) >= last - F.expr("interval 56 days")
    )
    store = feature_store(spark, folder)
    refs = ["sales_features:weekly_sales", "sales_features:lag_1", "store_features:region"]
    return rounded(store.get_historical_features(spine, refs, strategy="broadcast"))


def pit_join_ttl_expiry(spark, folder):
    store = feature_store(
        spark, folder, sales_ttl=retail.SHORT_SALES_TTL, store_ttl=retail.SHORT_STORE_TTL
    )
    refs = ["sales_features:weekly_sales", "store_features:store_size"]
    return rounded(
        store.get_historical_features(at(spark, folder).friday_spine(), refs, **WEEKLY)
    )


def pit_join_future_guard(spark, folder):
    """Requests 182 weeks early: about half of them precede all data."""
    spine = at(spark, folder).friday_spine()
    spine = spine.withColumn(TS, F.col(TS) - F.expr("interval 1274 days"))
    refs = ["sales_features:weekly_sales", "store_features:store_type"]
    return rounded(feature_store(spark, folder).get_historical_features(spine, refs, **WEEKLY))


def pit_join_events(spark, folder):
    """For every event the user's newest click of the three days up to it."""
    events = at(spark, folder).table("events")
    clicks = events.where("event_type = 'click'").select(
        "user_id", "ts", F.col("value").alias("click_value"), F.col("event_id").alias("click_id")
    )
    view = AsOf(clicks, ("user_id",), ("click_value", "click_id"), timedelta(days=3), "ts")
    requests = events.select("event_id", "user_id", "ts")
    return point_in_time(requests, [view], "ts", bound_time=True)


def training_features(spark, folder):
    return rounded(training_table(spark, folder))


# -- online reads ----------------------------------------------------------


def online_lookup(spark, folder, strategy="buckets"):
    columns = ["weekly_sales", "lag_1"]
    now = online.latest(sales_windows(spark, folder), KEYS, columns)
    path = fresh_path(spark, "online")
    online.write_online(now, path, KEYS)
    table = online.read_online(spark, path)
    asked = customer_requests(spark, folder)
    return rounded(online.lookup(asked, table, KEYS, columns, strategy=strategy))


def online_lookup_join(spark, folder):
    return online_lookup(spark, folder, strategy="join")


def online_service(spark, folder):
    store = feature_store(spark, folder)
    store.materialize()
    return rounded(store.get_online_features(customer_requests(spark, folder), "inference_features"))


# -- on-demand views -------------------------------------------------------


def _derived(spark, folder, make):
    store = feature_store(spark, folder)
    sales, stores = (store.registry.view(v) for v in ("sales_features", "store_features"))
    service = FeatureService("derived_only", (make(sales, stores),))
    made = store.get_historical_features(shipment_requests(spark, folder), service)
    return made.withColumns(
        {"sales_per_sqft": F.round("sales_per_sqft", 12), "momentum": F.round("momentum", 6)}
    )


def on_demand_features(spark, folder):
    return _derived(spark, folder, retail.derived_features)


def on_demand_pandas_udf(spark, folder):
    return _derived(spark, folder, retail.derived_features_pandas)


# -- calendar --------------------------------------------------------------


def calendar_features(spark, folder):
    lines = at(spark, folder).table("lineitem")
    made = calendar.calendar_columns(F.col("l_shipdate"))
    return lines.select(*LINE, "l_shipdate", *[c.alias(n) for n, c in made.items()])


def days_to_holiday_strict(spark, folder):
    lines = at(spark, folder).table("lineitem")
    days = calendar.days_to_holiday(
        F.col("l_shipdate"), calendar.HOLIDAY_WEEKS_NEW_YEAR, mode="strict"
    )
    return lines.select(*LINE, "l_shipdate", days.alias("days_to_holiday"))


# -- preparation -----------------------------------------------------------


def sorted_sales(spark, folder):
    return at(spark, folder).sales_base().orderBy(*KEYS, TS)


def head(spark, folder):
    return at(spark, folder).sales_base().orderBy(*KEYS, TS).limit(10)


def chrono_split(spark, folder):
    base = stored(at(spark, folder).sales_base(), "sales-base")
    return prep.chrono_split(base)


def chrono_split_three(spark, folder):
    """Train, validation and test by time: both cuts are found in the same rounds."""
    base = stored(at(spark, folder).sales_base(), "sales-base")
    return prep.chrono_splits(base, {"train": 0.7, "val": 0.15, "test": 0.15})


def hash_split(spark, folder):
    orders = at(spark, folder).table("orders").select("o_orderkey", "o_custkey")
    return prep.hash_split(orders, ["o_orderkey"])


def permutation_split(spark, folder):
    orders = at(spark, folder).table("orders").select("o_orderkey", "o_custkey")
    return prep.permutation_split(orders, ["o_orderkey"])


def target_transform(spark, folder):
    base = at(spark, folder).sales_base()
    y = to_target(F.col("weekly_sales"))
    return base.select(
        *KEYS, TS, F.round(y, 8).alias("y"), F.round(from_target(y), 2).alias("back")
    )


def scaled_features(spark, folder):
    features = stored(sales_features(spark, folder), "sales-features")
    columns = prep.numeric_features(features, retail.KEYS)
    scaler = prep.Scaler.fit(features, columns)
    return rounded(scaler.transform(features), 6)


def unscaled_features(spark, folder):
    """Scaled and scaled back."""
    features = stored(sales_features(spark, folder), "sales-features")
    scaler = prep.Scaler.fit(features, prep.numeric_features(features, retail.KEYS))
    return rounded(scaler.inverse(scaler.transform(features)))


def training_matrix(spark, folder):
    table = stored(training_table(spark, folder), "training-set")
    return rounded(training.training_matrix(table).rows, 6)


# -- evaluation and tracking -----------------------------------------------


def mape(spark, folder):
    made = sales_windows(spark, folder)
    return rounded(made.agg(metrics.mape(F.col("weekly_sales"), F.col("lag_1")).alias("mape")))


def mse(spark, folder):
    made = sales_windows(spark, folder)
    actual, guess = to_target(F.col("weekly_sales")), to_target(F.col("lag_1"))
    return rounded(made.agg(metrics.mse(actual, guess).alias("mse")), 6)


def profile(spark, folder):
    return metrics.profile(at(spark, folder).sales_base())


def weighted_loss(spark, folder):
    """Tax as loss of a batch, quantity as its size, ship year as epoch."""
    lines = at(spark, folder).table("lineitem")
    loss, size = F.col("l_tax").cast("decimal(8,4)"), F.col("l_quantity").cast("decimal(8,2)")
    made = lines.groupBy(F.year("l_shipdate").cast("bigint").alias("epoch")).agg(
        metrics.weighted_mean(loss, size).cast("double").alias("weighted_loss"),
        F.avg(loss).cast("double").alias("mean_loss"),
    )
    return rounded(made, 6)


def epoch_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a training log: user = run, day = step."""
    value = F.col("value").cast("decimal(18,4)")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    return (
        at(spark, folder).table("events")
        .groupBy(F.col("user_id").alias("run_id"), day.cast("bigint").alias("step"))
        .agg(
            F.round(F.avg(value), 4).cast("double").alias("train_loss"),
            F.min("value").alias("val_loss"),
            F.max("value").alias("mape"),
        )
    )


def metrics_log(spark, folder):
    wide = epoch_log(spark, folder)
    values = {m: F.col(m) for m in ("train_loss", "val_loss", "mape")}
    path = fresh_path(spark, "metrics")
    metrics.append_metrics(metrics.metrics_long(wide, F.col("run_id"), F.col("step"), values), path)
    best = metrics.best_step(wide)
    summary = {"best_mape": F.col("mape"), "best_val_loss": F.col("val_loss")}
    metrics.append_metrics(metrics.metrics_long(best, F.col("run_id"), F.col("step"), summary), path)
    return spark.read.parquet(path)


def best_epoch(spark, folder):
    return metrics.best_step(epoch_log(spark, folder))


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One run per user and kind of event, the kind being the model name."""
    return (
        at(spark, folder).table("events")
        .groupBy(F.col("event_type").alias("name"), F.col("user_id").alias("run_id"))
        .agg(F.min("ts").alias("start_time"), F.min("value").alias("best_mape"))
    )


def top_runs(spark, folder):
    return metrics.top_runs(runs(spark, folder).where("name = 'click'"), 5)


def model_versions(spark, folder):
    """Runs of the first half of the month are registered first, then the others."""
    early = F.col("start_time") < moment("2024-01-15")
    known = metrics.next_versions(runs(spark, folder).where(early))
    added = metrics.next_versions(runs(spark, folder).where(~early), known)
    return known.unionByName(added)


def model_latest_version(spark, folder):
    versions = model_versions(spark, folder).where(F.col("name") == "click")
    return metrics.latest_version(versions, keep=["run_id", "best_mape"])


# -- requests and models ---------------------------------------------------


def json_requests(spark: SparkSession, folder: str, rows: int = 16) -> DataFrame:
    """Sixteen customers to a request document."""
    asked = customer_requests(spark, folder)
    request = F.floor(F.col("pos") / rows).alias("request_id")
    entity = F.struct("pos", "store_id", "dept_id")
    grouped = asked.groupBy(request).agg(F.array_sort(F.collect_list(entity)).alias("rows"))
    data = F.transform("rows", lambda r: F.struct(r["store_id"].alias("store_id"), r["dept_id"].alias("dept_id")))
    given = F.struct(
        F.lit("entities").alias("name"),
        F.array(F.size("rows")).alias("shape"),
        F.lit("BYTES").alias("datatype"),
        data.alias("data"),
    )
    return grouped.select(
        "request_id", F.to_json(F.struct(F.array(given).alias("inputs"))).alias("payload")
    )


def decode_requests(spark, folder):
    decoded = scoring.decode_requests(json_requests(spark, folder))
    return scoring.request_rows(decoded).withColumn("pos", F.col("pos").cast("bigint"))


def decode_mixed_requests(spark, folder):
    """Entities with a key missing or of another type have an error; the others are read."""
    mixed = F.replace(F.replace("payload", F.lit('"dept_id":7'), F.lit('"dept_id":"seven"')), F.lit('"store_id":3,'), F.lit('"shop":3,'))
    rows = scoring.entity_rows(json_requests(spark, folder).withColumn("payload", mixed))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def decode_feature_rows(spark, folder):
    """Feature arrays in place of entities: account balance and nation of sixteen customers."""
    asked = at(spark, folder).table("customer").select(
        F.floor(F.col("c_custkey") / 16).alias("request_id"), "c_custkey",
        F.array(F.col("c_acctbal").cast("float"), F.col("c_nationkey").cast("float")).alias("row"),
    )
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", "row")))
    given = F.struct(F.lit("features").alias("name"), F.transform(rows, lambda r: r["row"]).alias("data"))
    payload = F.to_json(F.struct(F.array(given).alias("inputs"))).alias("payload")
    decoded = scoring.decode_requests(asked.groupBy("request_id").agg(payload))
    made = scoring.feature_rows(decoded, ["balance", "nation"])
    return made.select(
        "request_id", F.col("pos").cast("bigint").alias("pos"),
        F.round(F.col("balance").cast("double"), 1).alias("balance"), F.col("nation").cast("bigint").alias("nation"),
    )


def _mean_as_prediction(spark, folder):
    asked = scoring.request_rows(scoring.decode_requests(json_requests(spark, folder)))
    now = stored(online.latest(sales_windows(spark, folder), KEYS, ["rolling_mean_4w"]), "online")
    found = online.lookup(asked, now, KEYS, ["rolling_mean_4w"])
    guess = F.round(F.coalesce("rolling_mean_4w", F.lit(0.0)), 0)
    return found.select("request_id", "pos", *KEYS, guess.alias("prediction"))


def encode_responses(spark, folder):
    return scoring.encode_responses(_mean_as_prediction(spark, folder))


def prediction_report(spark, folder):
    found = _mean_as_prediction(spark, folder).withColumn("pos", F.col("pos").cast("bigint"))
    return scoring.prediction_report(found, ["request_id", "pos", *KEYS])


def _training_rows(spark, folder, features=None):
    """All rows of the training table, with all its features or only the ones that a model reads."""
    table = training_table(spark, folder)
    if features is not None:
        table = table.select(*KEYS, TS, scoring.TARGET, *features)
    return training.prepare(stored(table, "training-set"))


def _fit_one(spark, folder):
    rows = _training_rows(spark, folder)
    model = scoring.train(rows.where("split = 'train'"), ["rolling_mean_4w"], "linear")
    return rows, model


def train_eval_one_feature(spark, folder):
    rows, model = _fit_one(spark, folder)
    return rounded(scoring.evaluate(model, rows.where("split = 'val'")), 6)


def batch_score_one_feature(spark, folder):
    rows, model = _fit_one(spark, folder)
    asked = rows.select(*KEYS, TS, "rolling_mean_4w")
    return rounded(model.predict(asked).select(*KEYS, TS, "prediction"), 2)


def train_eval(spark, folder):
    """Boosted trees on all numeric features: a metrics log with one step per round."""
    rows = _training_rows(spark, folder)
    columns = prep.numeric_features(rows)
    fit, check = rows.where("split = 'train'"), rows.where("split = 'val'")
    model = scoring.train(fit, columns, "gbt", maxIter=5, maxDepth=4, seed=42)
    losses = scoring.loss_by_iteration(model, check)
    log = spark.createDataFrame([(i, float(v)) for i, v in enumerate(losses)], "step int, val_loss double")
    steps = metrics.metrics_long(log, F.lit("gbt"), F.col("step"), {"val_loss": F.col("val_loss")})
    final = metrics.metrics_long(
        scoring.evaluate(model, check),
        F.lit("gbt"),
        F.lit(len(losses) - 1),
        {"best_mape": F.col("mape"), "val_rows": F.col("n_rows")},
    )
    return steps.unionByName(final)


def train_early_stop(spark, folder):
    """The loss of every boosting round and the round that is kept; no SQL fits trees."""
    rows = _training_rows(spark, folder, FORECAST)
    fit, check = rows.where("split = 'train'"), rows.where("split = 'val'")
    model, log = scoring.train_to_best(fit, check, FORECAST, maxIter=6, maxDepth=4, stepSize=0.9, seed=42)
    kept = F.lit(len(model.model.trees))
    return log.withColumn("rounds_kept", kept.cast("int"))


def _fit_all(spark, folder):
    rows = _training_rows(spark, folder)
    columns = prep.numeric_features(rows)
    model = scoring.train(rows.where("split = 'train'"), columns, "linear", regParam=0.001)
    path = fresh_path(spark, "model")
    model.save(spark, path)
    return rows, scoring.SalesModel.load(spark, path)


def batch_score(spark, folder):
    rows, model = _fit_all(spark, folder)
    return rounded(model.predict(rows).select(*KEYS, TS, "prediction"), 2)


def train_stump(spark, folder):
    """One boosting round of depth one on one feature that has two values."""
    rows = _training_rows(spark, folder)
    model = scoring.train(rows.where("split = 'train'"), ["is_holiday"], "gbt", maxIter=1, maxDepth=1, seed=42)
    return rounded(scoring.evaluate(model, rows.where("split = 'val'")), 4)


def score_requests_one_feature(spark, folder):
    """Whole request documents scored on one feature; answers taken apart again."""
    _, model = _fit_one(spark, folder)
    now = stored(online.latest(sales_windows(spark, folder), KEYS, ["rolling_mean_4w"]), "online")
    answers = scoring.score_requests(
        json_requests(spark, folder), model,
        lambda asked: online.lookup(asked, now, KEYS, ["rolling_mean_4w"]),
    )
    data = F.from_json("response", "outputs array<struct<data array<double>>>")["outputs"][0]["data"]
    made = answers.select("request_id", "error", F.posexplode(data).alias("pos", "prediction"))
    # 32 bit floats keep seven digits.
    return made.select(
        "request_id", F.col("pos").cast("bigint").alias("pos"), "error",
        F.round(F.log(F.col("prediction") + 1), 4).alias("log_prediction"),
    )


def score_requests(spark, folder):
    _, model = _fit_all(spark, folder)
    store = feature_store(spark, folder)
    store.materialize()
    return scoring.score_requests(
        json_requests(spark, folder),
        model,
        lambda asked: store.get_online_features(asked, "inference_features"),
    )


QUERIES = {
    name: fn
    for name, fn in list(globals().items())
    if callable(fn) and getattr(fn, "__module__", "") == __name__ and not name.startswith("_")
}
for _helper in (
    "at", "rounded", "feature_store", "shipment_requests", "training_table", "customer_requests",
    "sales_windows", "event_view", "epoch_log", "runs", "json_requests",
):
    QUERIES.pop(_helper)
QUERIES["sales_features"] = lambda spark, folder: rounded(sales_features(spark, folder))
QUERIES["store_features"] = lambda spark, folder: at(spark, folder).store_features()
QUERIES["entity_spine_weekly"] = lambda spark, folder: at(spark, folder).weekly_spine()
QUERIES["entity_spine_friday"] = lambda spark, folder: at(spark, folder).friday_spine()
