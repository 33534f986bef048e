"""Which windows a refresh computes anew, the rows they need, and what of a result is theirs."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.spec import MonitorSpec


def first_window_starts(log: DataFrame, spec: MonitorSpec, since: str | dt.date) -> dict[str, str]:
    """Per granularity, from which window on a refresh computes anew.

    Stored metrics are replaced a day at a time, so that is the first window that starts on
    the day on which the window around ``since`` starts.
    """
    kind = log.schema[spec.timestamp_col].dataType
    row = log.sparkSession.range(1)
    for i, granularity in enumerate(spec.granularities):
        around = F.window(F.lit(str(since)).cast(kind), granularity)
        row = row.withColumn(f"_day{i}", F.to_date(around["start"]).cast(kind))
        first = F.window(f"_day{i}", granularity)
        row = row.withColumn(f"_w{i}", first).withColumn(
            f"_start{i}",
            F.when(F.col(f"_w{i}.start") == F.col(f"_day{i}"), F.col(f"_w{i}.start")).otherwise(F.col(f"_w{i}.end")),
        )
    found = row.select(*[F.col(f"_start{i}").cast("string") for i in range(len(spec.granularities))]).first()
    return dict(zip(spec.granularities, found))


def touched_rows(log: DataFrame, spec: MonitorSpec, starts: dict[str, str] | None) -> DataFrame:
    """The rows of all windows that a refresh computes again."""
    if starts is None:
        return log
    kind = log.schema[spec.timestamp_col].dataType
    moments = [F.lit(s).cast(kind) for s in starts.values()]
    return log.where(F.col(spec.timestamp_col) >= (F.least(*moments) if len(moments) > 1 else moments[0]))


def from_starts(metrics: DataFrame, starts: dict[str, str] | None) -> DataFrame:
    """Without the windows of a granularity before its start: only some of their rows were looked at."""
    if starts is None:
        return metrics
    kind = metrics.schema["window_start"].dataType
    kept = [(F.col("granularity") == g) & (F.col("window_start") >= F.lit(s).cast(kind)) for g, s in starts.items()]
    return metrics.where(reduce(or_, kept))
