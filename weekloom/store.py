"""The feature store: one set of definitions behind training reads and online reads."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .definitions import FeatureService, FeatureView
from .operators import online as online_ops
from .operators.pit import AsOf, point_in_time
from .operators.skew import MAX_GROUP_ROWS, hot_keys
from .registry import Registry, Selection
from .session import fresh_path
from .sources.commits import CommitLog
from .sources.tables import scan_view


class FeatureStore:
    """Definitions plus the online tables made from them.

    With ``root``, a folder all executors share, online tables and registered metadata
    outlive the session; without it they live in the checkpoint folder.
    """

    def __init__(self, spark: SparkSession, objects: Iterable = (), root: str | None = None):
        self.spark = spark
        self.registry = Registry(objects)
        self.root = root.rstrip("/") if root else None
        self._online: dict[str, dict] = {}

    def apply(self, objects: Iterable) -> list[tuple[str, str]]:
        """Register; under a root the metadata table there is brought up to date too."""
        changed = self.registry.apply(objects)
        if self.root and changed:
            self.registry.save(self.spark, f"{self.root}/registry")
        return changed

    # -- training ------------------------------------------------------------

    def get_historical_features(
        self,
        requests: DataFrame,
        features: FeatureService | str | Iterable,
        ts: str = "event_timestamp",
        **options,
    ) -> DataFrame:
        """Requests plus the selected features as of each request time.

        ``options`` go to :func:`weekloom.operators.pit.point_in_time`. Over stored views
        ``bound_time`` is on unless given.
        """
        selection = self.registry.select(features)
        stored = all(view.source.stored for view, _ in selection.views.values())
        options.setdefault("bound_time", stored)
        views = [
            AsOf(
                scan_view(self.spark, view, columns),
                view.join_keys,
                tuple(columns),
                view.ttl,
                view.source.timestamp_field,
                clustered=view.source.clustered,
                buckets=view.source.buckets,
            )
            for view, columns in selection.views.values()
        ]
        joined = point_in_time(requests, views, ts, **options)
        return finish(joined, selection, requests.columns)

    # -- serving -------------------------------------------------------------

    def materialize(
        self,
        start: datetime | None = None,
        end: datetime | None = None,
        views: Sequence[str] | None = None,
    ) -> dict[str, str]:
        """Latest row per key of every online view, written as a new online table.

        Earlier materialized rows stay unless newer ones come. Returns path by view.
        """
        written = {}
        for view in self._online_views(views):
            ts = view.source.timestamp_field
            fresh = online_ops.latest(
                scan_view(self.spark, view), view.join_keys, view.feature_names, ts, start, end
            )
            entry = self._entry(view.name)
            if entry:
                fresh = online_ops.merge_latest(self.online(view.name), fresh, view.join_keys, ts)
            path = self._path(view)
            rows = online_ops.write_online(fresh, path, view.join_keys, rows=entry["rows"] if entry else None)
            self._commit(view.name, {"path": path, "rows": rows, "mark": self._newest(view, path), "staged": None})
            written[view.name] = path
        return written

    def materialize_incremental(
        self,
        end: datetime | None = None,
        views: Sequence[str] | None = None,
        late: timedelta = timedelta(0),
    ) -> dict[str, int]:
        """Bring online tables up to ``end``, reading what came since the last time only.

        The newest time of a table is its mark; source rows after the mark are reduced to one per
        key, and only the key buckets these fall into are written anew. ``late`` goes back by so
        much, for rows that come late or come later at the mark itself. The log names the staged buckets before they are put in place, so
        the next run finishes what a broken one began. A view that was never materialized, or
        has outgrown its buckets, is written whole. Returns fresh keys by view.
        """
        done = {}
        for view in self._online_views(views):
            entry = self._entry(view.name)
            if entry is None or not entry["rows"] or self._outgrown(entry):
                self.materialize(end=end, views=[view.name])
                done[view.name] = self._entry(view.name)["rows"]
                continue
            ts = view.source.timestamp_field
            since = datetime.fromisoformat(entry["mark"]) + (-late if late else timedelta(microseconds=1))
            fresh = online_ops.latest(scan_view(self.spark, view), view.join_keys, view.feature_names, ts, since, end)
            staged, done[view.name] = online_ops.stage_upsert(self.online(view.name), fresh, view.join_keys, ts)
            if done[view.name]:
                newest = self._newest(view, staged)
                begun = {**entry, "mark": max(newest, entry["mark"], key=datetime.fromisoformat), "staged": staged}
                self._finish(view.name, self._commit(view.name, begun))
        return done

    def _online_views(self, names: Sequence[str] | None) -> list[FeatureView]:
        return [v for v in self.registry.views() if v.online and (names is None or v.name in names)]

    def _newest(self, view: FeatureView, path: str) -> str | None:
        """Greatest time of a written online table; with its zone if it has one."""
        ts = view.source.timestamp_field
        schema = self._online_schema(view)
        newest = F.max(ts)
        if isinstance(schema[ts].dataType, T.TimestampType):
            newest = F.date_format(newest, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
        found = online_ops.read_online(self.spark, path, schema).agg(newest.cast("string")).first()[0]
        return datetime.fromisoformat(found).isoformat() if found else None

    def _outgrown(self, entry: dict) -> bool:
        return entry["rows"] > 2 * entry["counted"] + online_ops.ROWS_PER_BUCKET * online_ops.MIN_BUCKETS

    def _finish(self, view: str, entry: dict) -> dict:
        """Put staged buckets in place and say so."""
        declared = self.registry.view(view)
        schema = self._online_schema(declared)
        online_ops.apply_upsert(
            online_ops.read_online(self.spark, entry["staged"], schema), entry["path"], declared.join_keys
        )
        rows = online_ops.read_online(self.spark, entry["path"], schema).count()
        return self._commit(view, {**entry, "staged": None, "rows": rows})

    def _log(self, view: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/materialized/{view}")

    def _commit(self, view: str, entry: dict) -> dict:
        entry = {"counted": entry["rows"], **entry, "at": datetime.now(timezone.utc).isoformat()}
        self._online[view] = entry
        if self.root:
            self._log(view).append(entry)
        return entry

    def _entry(self, view: str) -> dict | None:
        """The newest entry of a view, also one that another session wrote under the root."""
        entry = self._log(view).last()[1] if self.root else None
        entry = entry or self._online.get(view)
        return self._finish(view, entry) if entry and entry["staged"] else entry

    def _path(self, view: FeatureView) -> str:
        if self.root:
            return f"{self.root}/online/{view.name}-{uuid.uuid4().hex}"
        return fresh_path(self.spark, f"online-{view.name}")

    def _online_schema(self, declared: FeatureView) -> T.StructType:
        ts = declared.source.timestamp_field
        kinds = {f.name: f.dtype for f in declared.schema}
        kinds |= {k: e.value_type for e in declared.entities for k in e.join_keys}
        kinds[ts] = declared.source.read(self.spark).schema[ts].dataType
        names = [*declared.join_keys, ts, *declared.feature_names]
        return T.StructType([T.StructField(n, kinds[n]) for n in names])

    def online(self, view: str) -> DataFrame:
        entry = self._entry(view)
        if entry is None:
            raise LookupError(f"{view} is not materialized")
        return online_ops.read_online(self.spark, entry["path"], self._online_schema(self.registry.view(view)))

    def get_online_features(
        self,
        requests: DataFrame,
        features: FeatureService | str | Iterable,
        order_by: str | None = None,
        strategy: str = "join",
    ) -> DataFrame:
        """Requests plus the latest materialized values; unknown keys get NULL.

        ``order_by`` sorts the answer, for callers that need the order of the requests.
        ``strategy`` goes to :func:`weekloom.operators.online.lookup`.
        """
        selection = self.registry.select(features)
        out, counted = requests, {}
        for view, columns in selection.views.values():
            table, keys = self.online(view.name), view.join_keys
            if strategy == "join" and keys not in counted:  # once for all views of these keys
                counted[keys] = hot_keys(requests.dropna(subset=list(keys)), keys, MAX_GROUP_ROWS)
            out = online_ops.lookup(out, table, keys, columns, strategy=strategy, hot=counted.get(keys, True))
        out = finish(out, selection, requests.columns)
        return out.orderBy(order_by) if order_by else out


def finish(joined: DataFrame, selection: Selection, keep: Sequence[str]) -> DataFrame:
    """Compute on-demand columns, then drop inputs that were not asked for."""
    for view in selection.on_demand:
        joined = joined.select("*", *[c.alias(n) for n, c in view.columns().items()])
    return joined.select(*keep, *selection.output)
