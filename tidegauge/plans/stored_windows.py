"""Refreshes from storage: window counts, profile states and baselines kept as tables.

A refresh reads the rows of the days it computes anew and nothing else of the log. What it needs
of earlier windows (the one before, for consecutive drift; the finest ones, for coarser profiles)
comes from counts or states of a fixed size per window that earlier refreshes stored.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import join_groups
from tidegauge.operators.distribution import (
    DEFAULT_BINS,
    Edges,
    approx_edges,
    bin_counts,
    category_long,
    numeric_long,
    value_counts,
)
from tidegauge.operators.drift import binned_order_measures, drift_table, reference_for, share_measures
from tidegauge.operators.profile import profile_of_merged_states, profiled_columns, row_states
from tidegauge.operators.windows import SLICE_KEYS, group_keys, grouped_rows, nested_granularities
from tidegauge.plans.touched import first_window_starts, from_starts, touched_rows
from tidegauge.sinks.tables import PARTITION_COLUMNS, read_metrics, save_metrics, stored_table
from tidegauge.spec import MonitorSpec


def cell_counts(
    df: DataFrame, spec: MonitorSpec, numeric: list[str], categorical: list[str], edges: Edges, windowed: bool = True
) -> DataFrame:
    """Rows per window, model, slice, column and cell: ``bin`` of a numeric column, ``value`` of a categorical one.

    Null values have neither and keep their count.
    """
    rows, keys = grouped_rows(df, spec, {c: F.col(c) for c in (*numeric, *categorical)}, windowed)
    parts = []
    by = [*keys, "column_name"]
    if numeric:
        bins = bin_counts(numeric_long(rows, keys, numeric, edges), by)
        parts.append(bins.withColumn("value", F.lit(None).cast("string")).select(*by, "bin", "value", "n"))
    if categorical:
        values = value_counts(category_long(rows, keys, categorical), by)
        parts.append(values.withColumn("bin", F.lit(None).cast("int")).select(*by, "bin", "value", "n"))
    if not parts:
        raise ValueError("no column to compare")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def drift_of_counts(
    counts: DataFrame, spec: MonitorSpec, numeric: list[str], categorical: list[str], edges: Edges, baseline: DataFrame | None = None
) -> DataFrame:
    """The drift table from stored counts: KS on the bins, total variation of categories.

    Each window is compared with ``baseline`` counts, or else with the window before it among ``counts``.
    """
    keys = [*group_keys(spec), "column_name"]
    drift_type = "consecutive" if baseline is None else "baseline"
    found = None
    for columns, cell in ((numeric, "bin"), (categorical, "value")):
        if not columns:
            continue
        named = F.col("column_name").isin(columns)
        base = None if baseline is None else baseline.where(named).drop("bin" if cell == "value" else "value")
        windows, reference, match = reference_for(drift_type, counts.where(named).select(*keys, cell, "n"), base, keys)
        if cell == "bin":
            measured, score = binned_order_measures(windows, reference, keys, match, {c: edges.get(c, []) for c in columns}), "ks"
        else:
            measured, score = share_measures(windows, reference, keys, match, "value"), "total_variation"
        part = drift_table(measured.withColumn("drift_type", F.lit(drift_type)), score)
        found = part if found is None else found.unionByName(part)
    if found is None:
        raise ValueError("no column to compare")
    return found


def save_edges(spark: SparkSession, edges: Edges, name: str) -> None:
    """Bin edges as a small table, ``column_name`` and ``edges``; a column without edges keeps an empty list."""
    rows = spark.createDataFrame(sorted(edges.items()), "column_name string, edges array<double>").coalesce(1)
    if "/" in name:
        rows.write.mode("overwrite").parquet(name)
    else:
        rows.write.mode("overwrite").saveAsTable(name)


def load_edges(spark: SparkSession, name: str) -> Edges | None:
    """Stored edges, or None when there are none yet: columns times bins numbers on the driver."""
    stored = stored_table(spark, name)
    return None if stored is None else {r["column_name"]: list(r["edges"]) for r in stored.collect()}


def windows_and_the_ones_before(counts: DataFrame, spec: MonitorSpec, starts: dict[str, str] | None) -> DataFrame:
    """The stored counts of the windows a refresh is for, and of the last earlier window of each group.

    Where that window lies is looked up among the stored groups; a group of a window that had
    no rows of a column does not count as its last.
    """
    if starts is None:
        return counts
    touched = from_starts(counts, starts)
    series = [k for k in (*group_keys(spec), "column_name") if k not in ("window_start", "window_end")]
    kind = counts.schema["window_start"].dataType
    # a granularity that is not refreshed has no earlier windows to offer
    start = F.create_map(*[x for g, s in starts.items() for x in (F.lit(g), F.lit(s).cast(kind))])[F.col("granularity")]
    earlier = counts.where(F.col("window_start") < start)
    last = earlier.groupBy(*series).agg(F.max("window_start").alias("_last"))
    before = join_groups(earlier, last, series, "inner").where(F.col("window_start") == F.col("_last")).drop("_last")
    return touched.unionByName(before)


def refresh_consecutive(
    log: DataFrame,
    spec: MonitorSpec,
    drift_table_name: str,
    counts_table: str,
    edges_table: str,
    since: str | dt.date | None = None,
    edges: Edges | None = None,
    bins: int = DEFAULT_BINS,
) -> None:
    """Drift of each window against the one before it, reading only the rows of touched days.

    The first refresh cuts the bins (``edges``, or quantiles of the log) and stores them; later
    ones use the stored ones, so repetitions agree to the digit. Counts of computed windows are
    stored in place of earlier versions, and the window before the first of them comes from storage.
    """
    spark = log.sparkSession
    numeric, categorical = profiled_columns(log, spec)
    known = load_edges(spark, edges_table)
    if known is None or not set(numeric) <= known.keys():
        known = edges if edges is not None else approx_edges(log, numeric, bins)
        save_edges(spark, {c: known.get(c, []) for c in numeric}, edges_table)
    starts = None if since is None else first_window_starts(log, spec, since)
    fresh = cell_counts(touched_rows(log, spec, starts), spec, numeric, categorical, known)
    save_metrics(from_starts(fresh, starts), counts_table)
    stored = read_metrics(spark, counts_table).drop("window_date")
    compared = windows_and_the_ones_before(stored, spec, starts)
    found = drift_of_counts(compared, spec, numeric, categorical, known)
    save_metrics(from_starts(found, starts), drift_table_name)


def save_baseline(
    baseline: DataFrame, spec: MonitorSpec, name: str, edges: Edges | None = None, bins: int = DEFAULT_BINS
) -> None:
    """A baseline as an artefact: its bin edges at ``<name>_edges`` and its counts per cell at ``<name>_counts``."""
    numeric, categorical = profiled_columns(baseline, spec)
    edges = approx_edges(baseline, numeric, bins) if edges is None else edges
    counts = cell_counts(baseline, spec, numeric, categorical, edges, windowed=False)
    save_edges(baseline.sparkSession, {c: edges.get(c, []) for c in numeric}, f"{name}_edges")
    if "/" in name:
        counts.write.mode("overwrite").parquet(f"{name}_counts")
    else:
        counts.write.mode("overwrite").saveAsTable(f"{name}_counts")


def refresh_against(
    log: DataFrame, spec: MonitorSpec, drift_table_name: str, baseline_name: str, since: str | dt.date | None = None
) -> None:
    """Drift of the touched windows against a stored baseline, which is not computed again.

    Two refreshes with one baseline agree to the digit, without edges being given.
    """
    spark = log.sparkSession
    edges, base = load_edges(spark, f"{baseline_name}_edges"), stored_table(spark, f"{baseline_name}_counts")
    if edges is None or base is None:
        raise ValueError(f"no baseline is stored at {baseline_name}")
    numeric, categorical = profiled_columns(log, spec)
    shared = {r["column_name"] for r in base.select("column_name").distinct().collect()}
    numeric, categorical = [c for c in numeric if c in shared], [c for c in categorical if c in shared]
    starts = None if since is None else first_window_starts(log, spec, since)
    counts = cell_counts(touched_rows(log, spec, starts), spec, numeric, categorical, edges)
    base = base.select(*(SLICE_KEYS if spec.slicing_exprs else []), "column_name", "bin", "value", "n")
    save_metrics(from_starts(drift_of_counts(counts, spec, numeric, categorical, edges, base), starts), drift_table_name)


def _finest(spec: MonitorSpec) -> MonitorSpec:
    finest = nested_granularities(spec.granularities)
    if finest is None:
        raise ValueError("coarser windows must be made of whole finest ones")
    return replace(spec, granularities=(finest,))


def refresh_states(log: DataFrame, spec: MonitorSpec, states_table: str, since: str | dt.date | None = None) -> None:
    """Store the mergeable states (counts, moments, rank and distinct sketches) of the finest touched windows."""
    base = _finest(spec)
    numeric, categorical = profiled_columns(log, spec)
    starts = None if since is None else first_window_starts(log, base, since)
    states, _ = row_states(touched_rows(log, base, starts), base, numeric, categorical)
    save_metrics(from_starts(states, starts), states_table)


def profile_from_states(
    spark: SparkSession,
    spec: MonitorSpec,
    states_table: str,
    numeric: list[str],
    categorical: list[str],
    from_time: str | None = None,
    to_time: str | None = None,
) -> DataFrame:
    """The profile at all granularities of ``spec`` from stored states of the finest; no row of the log is read.

    ``from_time`` and ``to_time`` choose finest windows; a coarser window at either end covers what is chosen.
    """
    _finest(spec)
    states = read_metrics(spark, states_table, from_time, to_time)
    if states is None:
        raise ValueError(f"no states are stored at {states_table}")
    return profile_of_merged_states(states.drop(*[c for c in PARTITION_COLUMNS if c != "granularity"]), spec, numeric, categorical)
