"""Weekly series features on Spark: define, join point in time, materialize, score."""

from .definitions import (
    Entity,
    FeatureService,
    FeatureView,
    Field,
    OnDemandView,
    Projection,
    Source,
    on_demand_view,
)
from .registry import Registry
from .session import build_session
from .store import FeatureStore

__all__ = [
    "Entity",
    "FeatureService",
    "FeatureStore",
    "FeatureView",
    "Field",
    "OnDemandView",
    "Projection",
    "Registry",
    "Source",
    "build_session",
    "on_demand_view",
]
