"""The monitor of one log table: refresh its metric tables, report on them, raise alerts."""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import join_groups, quoted
from tidegauge.operators.alerts import (
    alert_messages,
    drift_metrics,
    drift_report,
    evaluate_rules,
    recent_windows,
    rules_table,
    score_rows,
    top_drift,
    unknown_metrics,
)
from tidegauge.operators.distribution import Edges
from tidegauge.operators.drift import drift
from tidegauge.operators.performance import (
    auc_of_counts,
    averages_of_counts,
    binary_of_counts,
    quality_counts,
    regression_metrics,
)
from tidegauge.operators.profile import PROFILE_COLUMNS, long_metrics, profile, profiled_columns
from tidegauge.operators.windows import grouped_rows, with_unused_keys
from tidegauge.plans.stored_windows import refresh_consecutive
from tidegauge.plans.touched import first_window_starts, from_starts, touched_rows
from tidegauge.sinks.tables import read_metrics, save_metrics
from tidegauge.spec import AlertRule, MonitorSpec


def drift_columns(log: DataFrame, spec: MonitorSpec, baseline: DataFrame | None) -> tuple[list[str], list[str]]:
    """Columns to compare: the profiled ones that the baseline has too."""
    numeric, categorical = profiled_columns(log, spec)
    shared = set(log.columns if baseline is None else baseline.columns)
    return [c for c in numeric if c in shared], [c for c in categorical if c in shared]


def quality_per_window(log: DataFrame, spec: MonitorSpec) -> DataFrame:
    """Model quality per window, model and slice, once labels are there.

    Regression errors, or accuracy with class averages. With a score column the label is
    0/1, and the measures of its positive class and the ROC-AUC come along.
    """
    if spec.label_col is None or spec.prediction_col is None:
        raise ValueError("model quality needs a prediction and a label column")
    values = {"_label": F.col(spec.label_col), "_prediction": F.col(spec.prediction_col)}
    scored = spec.score_col is not None and spec.problem_type == "classification"
    if scored:
        values["_score"] = F.col(spec.score_col)
    rows, keys = grouped_rows(log, spec, values)
    if spec.problem_type == "regression":
        return with_unused_keys(regression_metrics(rows, "_label", "_prediction", keys))
    # one count table, read from one shuffle by all measures
    counts = quality_counts(rows, "_label", "_prediction", keys, "_score" if scored else None)
    found = averages_of_counts(counts, keys)
    if scored:
        binary = binary_of_counts(counts, keys).drop("n", "accuracy")
        found = join_groups(join_groups(found, binary, keys, "left"), auc_of_counts(counts, keys), keys, "left")
    return with_unused_keys(found)


def quality_metrics(log: DataFrame, spec: MonitorSpec) -> DataFrame:
    """``quality_per_window`` as rows of the profile table, under the column name ``:table``."""
    wide = quality_per_window(log, spec)
    keys = [c for c in PROFILE_COLUMNS if c in wide.columns]
    named = {(":table", c if c != "n" else "labelled_rows"): quoted(c) for c in wide.columns if c not in keys}
    return long_metrics(wide, keys, named).select(*PROFILE_COLUMNS)


def refresh(
    log: DataFrame,
    spec: MonitorSpec,
    profile_table: str,
    drift_table: str,
    baseline: DataFrame | None = None,
    since: str | dt.date | None = None,
    exact: bool = False,
    custom: dict[str, Column] | None = None,
    edges: Edges | None = None,
    counts_table: str | None = None,
    edges_table: str | None = None,
) -> None:
    """Compute the days of windows that reach past ``since`` and store them in place of earlier versions.

    The profile table gets the profile and, for a log with labels, the model's quality.
    Without a baseline each window is compared with the one before it, however far back
    that lies. With ``counts_table`` and ``edges_table`` the counts of computed windows and
    the bin edges are stored too, and a later refresh takes the window before from there and
    reads touched days only; without them drift is computed on the whole log and only the
    touched windows are stored. Give ``edges`` where drift must come out the same on every
    repetition; estimated ones are read from the baseline, or the log, anew.
    """
    if (counts_table is None) != (edges_table is None) or (counts_table is not None and (baseline is not None or exact)):
        raise ValueError("stored counts and edges come together, and are for binned drift without a baseline")
    starts = None if since is None else first_window_starts(log, spec, since)
    rows = touched_rows(log, spec, starts)
    metrics = profile(rows, spec, exact, custom)
    if spec.label_col is not None and spec.prediction_col is not None:
        metrics = metrics.unionByName(quality_metrics(rows, spec))
    save_metrics(from_starts(metrics, starts), profile_table)
    if counts_table is not None:
        refresh_consecutive(log, spec, drift_table, counts_table, edges_table, since, edges)
        return
    numeric, categorical = drift_columns(log, spec, baseline)
    compared = log if baseline is None else rows
    found = drift(compared, spec, numeric, categorical, baseline, exact=exact, edges=edges)
    save_metrics(from_starts(found, starts), drift_table)


def analyze_drift(
    spark: SparkSession, drift_table: str, days: int = 7, as_of: str | dt.date | None = None
) -> dict[str, DataFrame] | None:
    """The drift report of the last days: records, counts, top list. None without a table.

    A table that is not there yet is not an error; any other failure is.
    """
    drift_rows = read_metrics(spark, drift_table)
    if drift_rows is None:
        return None
    recent = recent_windows(score_rows(drift_rows), days, as_of)
    return {
        "records": recent,
        "report": drift_report(drift_rows, days, as_of),
        "top": top_drift(recent),
    }


def monitor_status(spark: SparkSession, profile_table: str, drift_table: str) -> DataFrame:
    """One row per metric table: whether it is there, its rows, and its newest window."""
    found = None
    for kind, name in (("profile", profile_table), ("drift", drift_table)):
        rows = read_metrics(spark, name)
        if rows is None:
            row = spark.range(1).select(
                F.lit(0).cast("long").alias("n_rows"), F.lit(None).cast("timestamp").alias("latest_window_start"),
                F.lit(None).cast("timestamp").alias("latest_window_end"), F.lit("missing").alias("status"),
            )
        else:
            newest = F.max(F.struct("window_end", "window_start"))
            row = rows.agg(F.count("*").alias("n_rows"), newest.alias("_newest")).select(
                "n_rows",
                F.col("_newest.window_start").cast("timestamp").alias("latest_window_start"),
                F.col("_newest.window_end").cast("timestamp").alias("latest_window_end"),
                F.when(F.col("n_rows") > 0, "active").otherwise("empty").alias("status"),
            )
        row = row.select(F.lit(kind).alias("kind"), F.lit(name).alias("table_name"), "*")
        found = row if found is None else found.unionByName(row)
    return found


def send_alerts(
    spark: SparkSession,
    drift_table: str,
    rules: list[AlertRule],
    environment: str,
    catalog: str = "",
    schema: str = "",
    as_of: str | dt.date | None = None,
    other_metrics: DataFrame | None = None,
) -> dict[str, DataFrame] | None:
    """Violations of all rules, their texts, and the rules nobody can check."""
    drift_rows = read_metrics(spark, drift_table)
    if drift_rows is None and other_metrics is None:
        return None
    metrics = other_metrics
    if drift_rows is not None:
        scores = drift_metrics(drift_rows)
        metrics = scores if other_metrics is None else scores.unionByName(other_metrics)
    table = rules_table(spark, rules)
    violations = evaluate_rules(metrics, table, 1, as_of)
    return {
        "violations": violations,
        "messages": alert_messages(
            violations.where(F.col("metric") == "prediction_drift"), environment, catalog, schema
        ),
        "warnings": unknown_metrics(table),
    }
