"""Cutting a log into time windows, models and slices."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.spec import MonitorSpec

WINDOW_KEYS = ["granularity", "window_start", "window_end"]
SLICE_KEYS = ["slice_key", "slice_value"]

# Seconds per unit of a granularity.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def granularity_seconds(granularity: str) -> int:
    """Length of ``"30 minutes"``, ``"1 hour"``, ``"1 day"`` and the like."""
    number, _, unit = granularity.strip().partition(" ")
    unit = unit.strip().lower().removesuffix("s")
    if not number.isdigit() or unit not in UNIT_SECONDS:
        raise ValueError(f"Unknown granularity: {granularity}")
    return int(number) * UNIT_SECONDS[unit]


def nested_granularities(granularities: tuple[str, ...]) -> str | None:
    """The finest granularity if all others are made of whole windows of it, else None."""
    finest = min(granularities, key=granularity_seconds)
    step = granularity_seconds(finest)
    return finest if all(granularity_seconds(g) % step == 0 for g in granularities) else None


def with_windows(df: DataFrame, timestamp_col: str, granularities: tuple[str, ...]) -> DataFrame:
    """One row per granularity, with the tumbling window the row falls into.

    All granularities come from one scan: the rows are multiplied before the partial
    aggregation, which shrinks them again before anything is shuffled. Rows without a
    timestamp belong to no window.
    """
    naive = isinstance(df.schema[timestamp_col].dataType, T.TimestampNTZType)
    never = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz" if naive else "timestamp")

    def bound(i: int, side: str) -> Column:
        # never null, which lets joins on it be plain equi-joins that pass filters on
        return F.coalesce(F.col(f"_window{i}.{side}"), never).alias(f"window_{side}")

    staged, others = df, [F.col(f"`{c}`") for c in df.columns]
    for i, granularity in enumerate(granularities):
        staged = staged.withColumn(f"_window{i}", F.window(timestamp_col, granularity))
    choices = [
        F.struct(
            F.lit(g).alias("granularity"),
            bound(i, "start"),
            bound(i, "end"),
        )
        for i, g in enumerate(granularities)
    ]
    if len(choices) == 1:
        return staged.select(*others, choices[0].alias("_cut")).select(*others, "_cut.*")
    return staged.select(*others, F.inline(F.array(*choices)))


def with_slices(df: DataFrame, slicing_exprs: tuple[str, ...]) -> DataFrame:
    """One row per slice the row belongs to, and one (null, null) row for the whole table."""
    whole = F.struct(
        F.lit(None).cast("string").alias("slice_key"), F.lit(None).cast("string").alias("slice_value")
    )
    slices = [
        F.struct(F.lit(e).alias("slice_key"), F.expr(e).cast("string").alias("slice_value"))
        for e in slicing_exprs
    ]
    return df.select("*", F.inline(F.array(whole, *slices)))


def group_keys(spec: MonitorSpec, windowed: bool = True) -> list[str]:
    """The columns one metric row is for; those a monitor does not use are left out."""
    keys = list(WINDOW_KEYS) if windowed else []
    if spec.model_id_col and windowed:
        keys.append("model_id")
    if spec.slicing_exprs:
        keys += SLICE_KEYS
    return keys


def grouped_rows(
    df: DataFrame, spec: MonitorSpec, values: dict[str, Column], windowed: bool = True
) -> tuple[DataFrame, list[str]]:
    """Rows ready to be aggregated: group keys and the named value columns, nothing else."""
    rows = with_windows(df, spec.timestamp_col, spec.granularities) if windowed else df
    if spec.slicing_exprs:
        rows = with_slices(rows, spec.slicing_exprs)
    keys = group_keys(spec, windowed)
    model = [F.col(spec.model_id_col).cast("string").alias("model_id")] if "model_id" in keys else []
    return (
        rows.select(
            *[k for k in keys if k != "model_id"], *model, *[c.alias(n) for n, c in values.items()]
        ),
        keys,
    )


def with_unused_keys(metrics: DataFrame) -> DataFrame:
    """Add the key columns a monitor does not use as nulls, so all metric tables have one shape."""
    for name in ("model_id", *SLICE_KEYS):
        if name not in metrics.columns:
            metrics = metrics.withColumn(name, F.lit(None).cast("string"))
    return metrics


def totals_by_slice(
    df: DataFrame, keys: list[str], slice_cols: list[str], aggregates: list[Column]
) -> DataFrame:
    """Totals per group with and without each slice column, for slices that are plain columns."""
    sets = [[F.col(c) for c in keys], *[[F.col(c) for c in (*keys, s)] for s in slice_cols]]
    return df.groupingSets(sets, *keys, *slice_cols).agg(*aggregates)
