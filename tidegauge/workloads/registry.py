"""The named queries of this package: a DataFrame builder and, where there is one, equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    name: str
    run: Builder
    sql: str | None


WORKLOADS: dict[str, Workload] = {}


def workload(sql: str | None = None) -> Callable[[Builder], Builder]:
    """Register a builder under its function name."""

    def add(run: Builder) -> Builder:
        if run.__name__ in WORKLOADS:
            raise ValueError(f"{run.__name__} is registered twice")
        WORKLOADS[run.__name__] = Workload(run.__name__, run, sql)
        return run

    return add
