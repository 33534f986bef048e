"""Serving health: traffic, errors and latency per window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where, join_groups, ratio
from tidegauge.operators.distribution import (
    approx_edges,
    exact_quantiles,
    numeric_long,
    value_counts,
)
from tidegauge.operators.profile import SKETCH_SIZE, sketched_quantiles
from tidegauge.operators.windows import grouped_rows
from tidegauge.spec import MonitorSpec

LATENCY_QUANTILES = {"latency_p50": 0.5, "latency_p95": 0.95, "latency_p99": 0.99}


def serving_health(
    log: DataFrame,
    spec: MonitorSpec,
    status_col: str = "status_code",
    latency_col: str = "execution_duration_ms",
    exact: bool = False,
) -> DataFrame:
    """Requests, error rate (status 400 and above) and latency per window.

    Latency quantiles are sketches in the same aggregate unless ``exact`` is asked for.
    """
    values = {"_status": F.col(status_col), "_latency": F.col(latency_col).cast("double")}
    rows, keys = grouped_rows(log, spec, values)
    probabilities = list(LATENCY_QUANTILES.values())
    aggregates = [
        F.count("*").alias("requests"),
        count_where(F.col("_status") >= 400).alias("errors"),
        F.avg("_latency").alias("latency_avg"),
    ]
    if not exact:
        aggregates += [
            F.kll_sketch_agg_double("_latency", SKETCH_SIZE).alias("_latency.ranks"),
        ]
    health = rows.groupBy(*keys).agg(*aggregates)
    if not exact:
        health = health.withColumn("_q", sketched_quantiles("_latency", probabilities))
    if exact:
        edges = approx_edges(log.select(F.col(latency_col).alias("_latency")), ["_latency"])
        by = [*keys, "column_name"]
        counts = value_counts(numeric_long(rows, keys, ["_latency"], edges), by)
        found = exact_quantiles(counts, by, probabilities)
        wide = found.groupBy(*keys).agg(
            F.array(
                *[
                    F.max(F.when(F.col("probability") == p, F.col("quantile_value")))
                    for p in probabilities
                ]
            ).alias("_q")
        )
        health = join_groups(health, wide, keys, "left")
    return health.select(
        *keys,
        "requests",
        "errors",
        ratio(F.col("errors"), F.col("requests")).alias("error_rate"),
        "latency_avg",
        *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(LATENCY_QUANTILES)],
    )


def status_breakdown(log: DataFrame, spec: MonitorSpec, status_col: str = "status_code") -> DataFrame:
    rows, keys = grouped_rows(log, spec, {"status_code": F.col(status_col)})
    return rows.groupBy(*keys, "status_code").agg(F.count("*").alias("requests"))
