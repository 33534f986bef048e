"""Named queries over the given tables, one module per topic."""

from tidegauge.workloads import (  # noqa: F401
    checking,
    drifting,
    monitoring,
    preparing,
    profiling,
    quality_of_models,
    registering,
    series,
    streaming,
)
from tidegauge.workloads.registry import WORKLOADS

__all__ = ["WORKLOADS"]
