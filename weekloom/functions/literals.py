"""Literals that mean the same whatever the time zones of the driver and the session."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed(value, dtype: T.DataType) -> Column:
    """``value`` as a literal of ``dtype``. Times without zone go in as text; times with a
    zone mean UTC there."""
    if isinstance(value, datetime) and isinstance(dtype, T.TimestampNTZType):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(dtype)


def moment(value: datetime | str) -> Column:
    """A timestamp without time zone."""
    value = datetime.fromisoformat(value) if isinstance(value, str) else value
    return typed(value, T.TimestampNTZType())
