"""The sales-forecasting feature store: entities, views, services, and its feature build."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..definitions import Entity, FeatureService, FeatureView, Field, Source, on_demand_view
from ..functions.calendar import HOLIDAY_WEEKS, calendar_columns
from ..functions.scalar import or_one
from ..operators.windows import sales_windows
from ..sources.generator import economy

KEYS = ("store_id", "dept_id")
TS = "event_timestamp"
TARGET = "weekly_sales"

# The feature names and types of the two views.
LAG_FEATURES = ("lag_1", "lag_2", "lag_4", "lag_8")
ROLLING_FEATURES = ("rolling_mean_4w", "rolling_std_4w", "sales_vs_avg")
CALENDAR_FEATURES = ("week_of_year", "month", "quarter", "week_of_month")
FLAG_FEATURES = ("is_month_end", "is_holiday", "days_to_holiday")
ECONOMIC_FEATURES = ("temperature", "fuel_price", "cpi", "unemployment")
STORE_FEATURES = {"store_type": T.StringType(), "store_size": T.LongType(), "region": T.StringType()}

SALES_TTL = timedelta(days=365 * 3)
STORE_TTL = timedelta(days=365 * 10)
SHORT_SALES_TTL = timedelta(days=90)
SHORT_STORE_TTL = timedelta(days=365)

store_entity = Entity("store_id", description="Number of a shop")
dept_entity = Entity("dept_id", description="Number of a department, the same in every shop")


def sales_schema(compact: bool = False) -> tuple[Field, ...]:
    """``compact`` declares 32 bit types, as the batch job does."""
    real, whole = (T.FloatType, T.IntegerType) if compact else (T.DoubleType, T.LongType)
    return (
        *[Field(n, real()) for n in (TARGET, *LAG_FEATURES, *ROLLING_FEATURES)],
        *[Field(n, whole()) for n in (*CALENDAR_FEATURES, *FLAG_FEATURES)],
        *[Field(n, real()) for n in ECONOMIC_FEATURES],
    )


def definitions(
    sales: Callable[[SparkSession], DataFrame] | str,
    stores: Callable[[SparkSession], DataFrame] | str,
    sales_ttl: timedelta | None = SALES_TTL,
    store_ttl: timedelta | None = STORE_TTL,
    clustered: bool = False,
    stores_clustered: bool = False,
    compact: bool = False,
) -> list:
    """All objects of the store over two sources, each a Parquet path or a lazy frame.

    ``clustered`` says that the sales frame comes straight from :func:`build_sales_features`
    and so is partitioned by series, ``stores_clustered`` the same of the stores.
    """

    def source(name: str, given, clustered: bool = False) -> Source:
        if isinstance(given, str):
            return Source(name, path=given)
        return Source(name, frame=given, clustered=clustered)

    tags = {"owner": "forecasting", "data": "weekly sales"}
    sales_view = FeatureView(
        "sales_features",
        (store_entity, dept_entity),
        sales_schema(compact),
        source("sales_source", sales, clustered),
        sales_ttl,
        tags=tags,
        description="Weekly sales with lag, rolling, calendar and economic features",
    )
    store_view = FeatureView(
        "store_features",
        (store_entity, dept_entity),
        tuple(Field(n, t) for n, t in STORE_FEATURES.items()),
        source("store_source", stores, stores_clustered),
        store_ttl,
        tags=tags,
        description="Static store attributes",
    )

    training = FeatureService(
        "training_features",
        (sales_view, store_view),
        {"use_case": "training"},
        "All features for training, with the target",
    )
    inference = FeatureService(
        "inference_features",
        (
            sales_view[LAG_FEATURES],
            sales_view[ROLLING_FEATURES],
            sales_view[CALENDAR_FEATURES],
            sales_view[FLAG_FEATURES],
            sales_view[ECONOMIC_FEATURES],
            store_view,
        ),
        {"use_case": "inference"},
        "Features for prediction, without the target",
    )
    derived = derived_features(sales_view, store_view)
    return [sales_view, store_view, derived, training, inference]


DERIVED_SCHEMA = (Field("sales_per_sqft", T.DoubleType()), Field("momentum", T.DoubleType()))


def derived_features(sales_view: FeatureView, store_view: FeatureView):
    """Sales per area and relative change to the week before, as columns."""

    @on_demand_view(
        sources=[sales_view[[TARGET, "lag_1"]], store_view[["store_size"]]],
        schema=DERIVED_SCHEMA,
        name="derived_features",
    )
    def derived(inputs):
        sales = F.coalesce(inputs[TARGET], F.lit(0.0))
        before = or_one(inputs["lag_1"])
        return {
            "sales_per_sqft": sales / or_one(inputs["store_size"].cast("double")),
            "momentum": (sales - before) / before,
        }

    return derived


def derived_features_pandas(sales_view: FeatureView, store_view: FeatureView):
    """The same view with a pandas function, for code that columns cannot express."""

    @on_demand_view(
        sources=[sales_view[[TARGET, "lag_1"]], store_view[["store_size"]]],
        schema=DERIVED_SCHEMA,
        mode="pandas",
        name="derived_features_pandas",
    )
    def derived(batch):
        sales = batch[TARGET].fillna(0.0)
        size = batch["store_size"].astype("float64").fillna(1.0).replace(0.0, 1.0)
        before = batch["lag_1"].fillna(1.0).replace(0.0, 1.0)
        return batch.assign(sales_per_sqft=sales / size, momentum=(sales - before) / before)

    return derived


def build_sales_features(
    base: DataFrame,
    first_week,
    seed: int | None = 42,
    holidays=HOLIDAY_WEEKS,
    mode: str = "nearest",
    max_group_rows: int | None = None,
) -> DataFrame:
    """The 19 sales features from (store_id, dept_id, event_timestamp, weekly_sales).

    One shuffle and one sort by series for all windows, the rest is a projection.
    ``first_week`` is the date (column) that week 0 starts on. With one row per series and
    week the calendar bounds a series, hence no measurement by default.
    """
    out = sales_windows(base, KEYS, TS, TARGET, max_group_rows=max_group_rows)
    names = (*KEYS, TS, *[f.name for f in sales_schema()])
    return with_calendar(out, first_week, seed, holidays, mode).select(*names)


def with_calendar(
    df: DataFrame, first_week, seed: int | None = 42, holidays=HOLIDAY_WEEKS, mode: str = "nearest"
) -> DataFrame:
    """Add the calendar and economic features, which depend on a row's own time only."""
    at = F.col(TS)
    df = df.withColumn("__week", F.floor(F.datediff(at.cast("date"), first_week) / 7))
    return df.withColumns({
        **calendar_columns(at, holidays, mode),
        **economy(F.weekofyear(at), F.col("__week"), seed),
    })
