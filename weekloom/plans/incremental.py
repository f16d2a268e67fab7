"""Weekly features kept up to date without reading history again.

A step reads the order lines of its own weeks, continues every series from its stored tail (the
last rows that lags and rolling windows look back on), writes the features of the new weeks and
the new tails, and commits both in one log entry. A step that broke left nothing that is read.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import week_start
from ..functions.literals import moment
from ..operators.prep import ScalerState, scaler_state
from ..operators.windows import LAGS, ROLLING, continued, sales_windows, tails
from ..sources.commits import CommitLog
from .retail import KEYS, TARGET, TS, sales_schema, with_calendar
from .warehouse import Warehouse

DEPTH = max(*LAGS, ROLLING - 1)


class FeatureLog:
    """Sales features of a warehouse in steps of whole weeks, under one shared folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.log = CommitLog(spark, f"{self.folder}/steps")

    def advance(self, warehouse: Warehouse, until: datetime | None = None) -> int:
        """Add all whole weeks before ``until`` that no step has; the number of the step.

        The first step fixes week 0. Rows that came late for a week already done are not read:
        weeks are closed once committed.
        """
        number, last = self.log.last()
        start = datetime.fromisoformat(last["until"]) if last else None
        if until is None:
            newest = warehouse.table("lineitem").agg(week_start(F.max("l_shipdate")) + F.expr("interval 7 days")).first()[0]
            until = newest or start
        else:
            until = self.spark.range(1).select(week_start(moment(until))).first()[0]
        if until is None or (start and until <= start):
            return number
        first = last["first_week"] if last else None
        if first is None:
            found = warehouse.table("lineitem").agg(week_start(F.min("l_shipdate"))).first()[0]
            first = found.isoformat() if found else until.isoformat()

        base = warehouse.sales_base(start, until)
        tail = self.spark.read.parquet(last["tail"]) if last else None
        made = continued(tail, base, KEYS, TS, lambda df: sales_windows(df, KEYS, TS, TARGET, max_group_rows=None))
        made = with_calendar(made, F.lit(first).cast("date")).select(*KEYS, TS, *[f.name for f in sales_schema()])
        name = f"{number + 1}-{uuid.uuid4().hex}"
        path, tail_path = f"{self.folder}/features/{name}", f"{self.folder}/tails/{name}"
        made.write.parquet(path)
        mine = self.spark.read.parquet(path)
        rows = mine.select(*KEYS, TS, TARGET)
        if tail is not None:
            rows = rows.unionByName(tail)
        tails(rows, KEYS, TS, DEPTH).write.parquet(tail_path)
        state = scaler_state(mine, [f.name for f in sales_schema()])
        if last:
            state = ScalerState.from_json(last["scaler"]).merged(state)
        entry = {
            "until": until.isoformat(), "first_week": first, "features": path, "tail": tail_path, "scaler": state.to_json(),
        }
        if not self.log.put(number + 1, entry):
            raise RuntimeError(f"another writer committed step {number + 1} first")
        return number + 1

    def read(self) -> DataFrame:
        """Features of all committed steps."""
        paths = [e["features"] for e in self.log.entries()]
        schema = T.StructType([
            *[T.StructField(k, T.LongType()) for k in KEYS], T.StructField(TS, T.TimestampNTZType()),
            *[T.StructField(f.name, f.dtype) for f in sales_schema()],
        ])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def scaler(self) -> ScalerState:
        """Statistics of all committed rows, merged from those of the steps."""
        return ScalerState.from_json(self.log.last()[1]["scaler"])
