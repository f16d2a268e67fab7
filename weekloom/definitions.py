"""Declarations: entities, sources, feature views, on-demand views and feature services."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...] = ()
    description: str = ""
    value_type: T.DataType = field(default_factory=T.LongType)

    def __post_init__(self):
        object.__setattr__(self, "join_keys", tuple(self.join_keys) or (self.name,))


@dataclass(frozen=True)
class Field:
    name: str
    dtype: T.DataType


@dataclass(frozen=True)
class Source:
    """A Parquet path, a catalog table, or a function of the session that returns a lazy DataFrame.

    ``clustered`` says that this frame is already partitioned by the keys of its view, ``buckets``
    that the table is bucketed by them into so many buckets
    (:func:`weekloom.sources.layout.write_bucketed`).
    """

    name: str
    path: str | None = None
    timestamp_field: str = "event_timestamp"
    frame: Callable[[SparkSession], DataFrame] | None = None
    clustered: bool = False
    table: str | None = None
    buckets: int | None = None

    @property
    def stored(self) -> bool:
        """Whether rows lie in files, so that filters reach a scan."""
        return self.frame is None

    def read(self, spark: SparkSession) -> DataFrame:
        if self.frame is not None:
            return self.frame(spark)
        if self.table is not None:
            return spark.table(self.table)
        return spark.read.parquet(self.path)


@dataclass(frozen=True)
class Projection:
    """Some columns of a view, written ``view[["a", "b"]]``."""

    view: "FeatureView | OnDemandView"
    columns: tuple[str, ...]


class _Selectable:
    def __getitem__(self, columns: Iterable[str]) -> Projection:
        columns = (columns,) if isinstance(columns, str) else tuple(columns)
        unknown = [c for c in columns if c not in self.feature_names]
        if unknown:
            raise KeyError(f"{self.name} has no feature {unknown}")
        return Projection(self, columns)

    @property
    def feature_names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema)


@dataclass(frozen=True)
class FeatureView(_Selectable):
    """A typed event-time table. ``ttl=None`` means that values never expire."""

    name: str
    entities: tuple[Entity, ...]
    schema: tuple[Field, ...]
    source: Source
    ttl: timedelta | None = None
    online: bool = True
    tags: dict = field(default_factory=dict, hash=False)
    description: str = ""

    def __post_init__(self):
        object.__setattr__(self, "entities", tuple(self.entities))
        object.__setattr__(self, "schema", tuple(self.schema))

    @property
    def join_keys(self) -> tuple[str, ...]:
        return tuple(k for e in self.entities for k in e.join_keys)


@dataclass(frozen=True)
class OnDemandView(_Selectable):
    """Columns derived after the join from columns of other views.

    ``mode="column"``: ``fn(inputs: dict[str, Column]) -> dict[str, Column]``.
    ``mode="pandas"``: ``fn(inputs: pandas.DataFrame) -> pandas.DataFrame`` on Arrow batches.
    """

    name: str
    sources: tuple[FeatureView | Projection, ...]
    schema: tuple[Field, ...]
    fn: Callable
    mode: str = "column"
    tags: dict = field(default_factory=dict, hash=False)
    description: str = ""

    def __post_init__(self):
        object.__setattr__(self, "sources", tuple(self.sources))
        object.__setattr__(self, "schema", tuple(self.schema))
        if self.mode not in ("column", "pandas"):
            raise ValueError(f"unknown on-demand mode {self.mode!r}")

    @property
    def inputs(self) -> list[tuple[FeatureView, tuple[str, ...]]]:
        return [
            (s.view, s.columns) if isinstance(s, Projection) else (s, s.feature_names)
            for s in self.sources
        ]

    def columns(self) -> dict[str, Column]:
        """Output name to column over a frame that holds the inputs under their bare names."""
        names = [c for _, cols in self.inputs for c in cols]
        if self.mode == "column":
            made = self.fn({c: F.col(c) for c in names})
            return {f.name: made[f.name].cast(f.dtype) for f in self.schema}
        fn, schema = self.fn, T.StructType([T.StructField(f.name, f.dtype) for f in self.schema])

        def run(batch):
            return fn(batch)[schema.names]

        run.__annotations__ = _pandas_hints()
        packed = F.pandas_udf(run, returnType=schema)(F.struct(*names))
        return {f.name: packed.getField(f.name) for f in self.schema}


def _pandas_hints() -> dict:
    import pandas as pd

    return {"batch": pd.DataFrame, "return": pd.DataFrame}


def on_demand_view(*, sources, schema, mode: str = "column", name: str | None = None, **extra):
    """Decorator that turns a function into an :class:`OnDemandView`."""

    def wrap(fn):
        return OnDemandView(name or fn.__name__, sources, schema, fn, mode, **extra)

    return wrap


@dataclass(frozen=True)
class FeatureService:
    """A named, ordered selection across views."""

    name: str
    features: tuple[FeatureView | OnDemandView | Projection, ...]
    tags: dict = field(default_factory=dict, hash=False)
    description: str = ""

    def __post_init__(self):
        object.__setattr__(self, "features", tuple(self.features))
