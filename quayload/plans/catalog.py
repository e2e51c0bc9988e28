"""Every query of the package, by name."""

from quayload.plans import (  # noqa: F401
    conform_queries,
    profile_queries,
    quality_queries,
    shape_queries,
    sizing_queries,
    source_queries,
    stream_queries,
    telemetry_queries,
)
from quayload.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
