"""Registered definitions, what a request selects from them, and metadata tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .definitions import Entity, FeatureService, FeatureView, OnDemandView, Projection, Source
from .sources.tables import is_written

KINDS = {
    Entity: "entity",
    Source: "source",
    FeatureView: "feature_view",
    OnDemandView: "on_demand_view",
    FeatureService: "feature_service",
}


@dataclass
class Selection:
    """What to fetch per view, what to compute after it, and the output order."""

    views: dict[str, tuple[FeatureView, list[str]]]
    on_demand: list[OnDemandView]
    output: list[str]

    def fetched(self) -> list[str]:
        return [c for _, cols in self.views.values() for c in cols]


class Registry:
    def __init__(self, objects: Iterable = ()):
        self._objects: dict[tuple[str, str], object] = {}
        self.apply(objects)

    def apply(self, objects: Iterable) -> list[tuple[str, str]]:
        """Upsert by (kind, name); registering the same definition twice changes nothing.

        A definition differs if any part does: a function, a frame or a tag too.
        """
        changed = []
        for obj in objects:
            if isinstance(obj, FeatureView):
                changed += self.apply([*obj.entities, obj.source])
            key = (KINDS[type(obj)], obj.name)
            if self._objects.get(key) != obj:
                self._objects[key] = obj
                changed.append(key)
        return changed

    def _of(self, kind: str) -> list:
        return [o for (k, _), o in sorted(self._objects.items(), key=lambda e: e[0]) if k == kind]

    def _get(self, kind: str, name: str):
        try:
            return self._objects[(kind, name)]
        except KeyError:
            raise KeyError(f"no {kind} named {name!r} is registered") from None

    def entities(self) -> list[Entity]:
        return self._of("entity")

    def views(self) -> list[FeatureView]:
        return self._of("feature_view")

    def on_demand_views(self) -> list[OnDemandView]:
        return self._of("on_demand_view")

    def services(self) -> list[FeatureService]:
        return self._of("feature_service")

    def view(self, name: str) -> FeatureView:
        return self._get("feature_view", name)

    def service(self, name: str) -> FeatureService:
        return self._get("feature_service", name)

    def select(self, features: FeatureService | str | Iterable) -> Selection:
        """Resolve a service, its name, or a list of views, projections and ``view:column`` refs.

        Repeated projections of a view merge in first-seen order. Two views may not
        give the same bare output name.
        """
        if isinstance(features, str) and ":" not in features:
            features = self.service(features)
        if isinstance(features, FeatureService):
            features = features.features
        elif isinstance(features, str):
            features = [features]

        views: dict[str, tuple[FeatureView, list[str]]] = {}
        on_demand: list[OnDemandView] = []
        wanted: dict[str, str] = {}

        def fetch(view: FeatureView, columns: Iterable[str]):
            _, have = views.setdefault(view.name, (view, []))
            have.extend(c for c in columns if c not in have)

        for item in features:
            owner, columns = self._expand(item)
            owner = self._newest(owner)
            for column in columns:
                if wanted.setdefault(column, owner.name) != owner.name:
                    raise ValueError(f"{column} comes from both {wanted[column]} and {owner.name}")
            if isinstance(owner, OnDemandView):
                if owner not in on_demand:
                    on_demand.append(owner)
            else:
                fetch(owner, columns)
        output = list(wanted)
        for derived in on_demand:
            for view, columns in derived.inputs:
                fetch(self._newest(view), columns)
        fetched: dict[str, str] = {}
        for view, columns in views.values():
            for column in columns:
                if fetched.setdefault(column, view.name) != view.name:
                    raise ValueError(f"{column} comes from both {fetched[column]} and {view.name}")
        return Selection(views, on_demand, output)

    def _newest(self, owner):
        """The registered view of that name, so that a new definition reaches every service."""
        return self._objects.get((KINDS[type(owner)], owner.name), owner)

    def _expand(self, item):
        if isinstance(item, Projection):
            return item.view, item.columns
        if isinstance(item, str):
            view_name, sep, column = item.partition(":")
            if not sep:
                raise ValueError(f"{item!r} is not of the form view:column")
            owner = self._objects.get(("feature_view", view_name))
            owner = owner or self._get("on_demand_view", view_name)
            return owner, owner[[column]].columns
        return item, item.feature_names

    # -- metadata tables ---------------------------------------------------

    def objects_frame(self, spark: SparkSession) -> DataFrame:
        """One row per object with what it declares; ``declared`` is JSON by kind."""
        rows = [
            (kind, name, getattr(o, "description", ""), dict(getattr(o, "tags", {}) or {}),
             json.dumps(_declared(o), sort_keys=True))
            for (kind, name), o in sorted(self._objects.items(), key=lambda e: e[0])
        ]
        return spark.createDataFrame(
            rows, "kind string, name string, description string, tags map<string,string>, declared string"
        )

    def save(self, spark: SparkSession, path: str) -> None:
        """Upsert the objects by (kind, name) into the metadata table at ``path``.

        Every save is a new folder of its own; the newest finished one counts, so a broken
        save leaves the one before.
        """
        mine = self.objects_frame(spark)
        saved = saved_objects(spark, path)
        if saved is not None:
            mine = saved.join(mine, ["kind", "name"], "left_anti").unionByName(mine)
        mine.write.parquet(f"{path}/{time.time_ns():020d}-{uuid.uuid4().hex}")

    def features_frame(self, spark: SparkSession) -> DataFrame:
        """One row per declared feature."""
        rows = [
            (v.name, f.name, f.dtype.simpleString(), i)
            for v in [*self.views(), *self.on_demand_views()]
            for i, f in enumerate(v.schema)
        ]
        return spark.createDataFrame(rows, "view string, feature string, dtype string, ord int")

    def lineage_frame(self, spark: SparkSession) -> DataFrame:
        """Edges source -> view, entity -> view, view -> on-demand view, view -> service."""
        edges = set()
        for v in self.views():
            edges.add(("source", v.source.name, "feature_view", v.name))
            edges |= {("entity", e.name, "feature_view", v.name) for e in v.entities}
        for d in self.on_demand_views():
            edges |= {("feature_view", v.name, "on_demand_view", d.name) for v, _ in d.inputs}
        for s in self.services():
            for item in s.features:
                owner, _ = self._expand(item)
                edges.add((KINDS[type(owner)], owner.name, "feature_service", s.name))
        return spark.createDataFrame(
            sorted(edges), "from_kind string, from_name string, to_kind string, to_name string"
        )


    def feature_edges_frame(self, spark: SparkSession) -> DataFrame:
        """Edges between single features: (from_node, to_node), a node is ``kind:name``.

        source -> feature of a view -> feature of an on-demand view -> service. An on-demand
        feature depends on every input that its view declares.
        """
        edges = set()
        for v in self.views():
            edges |= {(f"source:{v.source.name}", f"feature:{v.name}.{c}") for c in v.feature_names}
        for d in self.on_demand_views():
            for v, columns in d.inputs:
                edges |= {(f"feature:{v.name}.{c}", f"feature:{d.name}.{o}") for c in columns for o in d.feature_names}
        for s in self.services():
            for item in s.features:
                owner, columns = self._expand(item)
                edges |= {(f"feature:{owner.name}.{c}", f"service:{s.name}") for c in columns}
        return spark.createDataFrame(sorted(edges), "from_node string, to_node string")


def closure(edges: DataFrame, limit: int = 100) -> DataFrame:
    """(from_node, to_node, hops): every pair that a path of edges joins, with its least hops.

    Upwards or downwards is a filter on one end: what breaks if a node changes, or what a node
    comes from. Paths of more than ``limit`` edges, as in a cycle, are an error.
    """
    name = f"lineage_edges_{uuid.uuid4().hex}"
    edges.select("from_node", "to_node").distinct().createOrReplaceTempView(name)
    spark = edges.sparkSession
    try:
        return spark.sql(f"""
            WITH RECURSIVE walk(from_node, to_node, hops) MAX RECURSION LEVEL {limit} AS (
              SELECT from_node, to_node, 1 FROM {name}
              UNION ALL
              SELECT w.from_node, e.to_node, w.hops + 1 FROM walk w JOIN {name} e ON e.from_node = w.to_node)
            SELECT from_node, to_node, min(hops) AS hops FROM walk GROUP BY from_node, to_node""")
    finally:
        spark.catalog.dropTempView(name)


def saved_objects(spark: SparkSession, path: str) -> DataFrame | None:
    """The registry saved last at ``path``, or None."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    folders = sorted((str(f.getPath().toString()) for f in fs.listStatus(root)), reverse=True)
    newest = next((f for f in folders if is_written(spark, f)), None)
    return None if newest is None else spark.read.parquet(newest)


def _declared(obj) -> dict:
    """Schema, keys, TTL and origin, as far as the kind has them."""
    out: dict = {}
    if isinstance(obj, Entity):
        out = {"join_keys": list(obj.join_keys), "value_type": obj.value_type.simpleString()}
    elif isinstance(obj, Source):
        out = {"path": obj.path, "table": obj.table, "timestamp_field": obj.timestamp_field, "frame": obj.frame is not None}
    elif isinstance(obj, FeatureView):
        out = {
            "keys": list(obj.join_keys), "source": obj.source.name, "online": obj.online,
            "ttl_seconds": None if obj.ttl is None else obj.ttl.total_seconds(),
        }
    elif isinstance(obj, OnDemandView):
        out = {"inputs": {v.name: list(c) for v, c in obj.inputs}, "mode": obj.mode}
    if isinstance(obj, (FeatureView, OnDemandView)):
        out["schema"] = {f.name: f.dtype.simpleString() for f in obj.schema}
    if isinstance(obj, FeatureService):
        out["features"] = {
            i.view.name if isinstance(i, Projection) else i.name:
            list(i.columns if isinstance(i, Projection) else i.feature_names)
            for i in obj.features
        }
    return out
