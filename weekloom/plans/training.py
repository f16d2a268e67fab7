"""From a joined training table to train and validation matrices."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import to_target
from ..operators.prep import Scaler, chrono_split, drop_null_target, fill_zero, numeric_features
from .retail import KEYS, TARGET, TS


@dataclass
class TrainingMatrix:
    """Scaled features and target with ``split``; statistics come from the train rows only."""

    rows: DataFrame
    feature_columns: tuple[str, ...]
    scaler_x: Scaler
    scaler_y: Scaler


def prepare(table: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS, target: str = TARGET) -> DataFrame:
    """Drop rows without target, mark the chronological split, fill NULL features with 0.

    ``table`` is read several times: pass a stored table, not a long lazy plan.
    """
    split = chrono_split(drop_null_target(table, target), ts, keys)
    return fill_zero(split, numeric_features(split, (*keys, ts, target)))


def training_matrix(
    table: DataFrame,
    keys: Sequence[str] = KEYS,
    ts: str = TS,
    target: str = TARGET,
    use_log_transform: bool = True,
) -> TrainingMatrix:
    ready = prepare(table, keys, ts, target)
    columns = numeric_features(ready, (*keys, ts, target))
    goal = to_target(F.col(target)) if use_log_transform else F.col(target)
    ready = ready.withColumn("y", goal)
    fitted = Scaler.fit(ready.where("split = 'train'"), [*columns, "y"])
    scaler_x = Scaler(fitted.columns[:-1], fitted.means[:-1], fitted.stds[:-1])
    scaler_y = Scaler(fitted.columns[-1:], fitted.means[-1:], fitted.stds[-1:])
    rows = fitted.transform(ready).select(*keys, ts, target, "split", *columns, "y")
    return TrainingMatrix(rows, tuple(columns), scaler_x, scaler_y)
