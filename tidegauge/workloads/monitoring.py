"""Monitors as a whole: refreshes into stored tables, status, reports and alerts from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.plans import monitoring as plans
from tidegauge.plans import stored_windows as stored
from tidegauge.operators.alerts import freshness_hours, metric_rows
from tidegauge.session import scratch_dir
from tidegauge.sinks.tables import read_metrics
from tidegauge.spec import AlertRule, MonitorSpec
from tidegauge.workloads.bindings import (
    AS_OF, BASE, CLASSIFIED, LOG, PRICED, baseline, classified_lines, inference_log, log_spec, monitored, priced_lines,
    rounded, table,
)
from tidegauge.workloads.drifting import CONSECUTIVE, DAY, SCORES, TV
from tidegauge.workloads.registry import workload

STEPS = {"1 hour": "1 hour", "5 hours": "5 hours", "1 day": "1 day"}


def _windows(step: str, ts: str) -> str:
    bucket = f"time_bucket(INTERVAL '{step}', {ts}, TIMESTAMP '1970-01-01')"
    return f"{bucket} AS window_start, {bucket} + INTERVAL '{step}' AS window_end"


@workload(
    f"WITH {LOG} "
    + " UNION ALL ".join(
        f"SELECT '{g}' AS granularity, {_windows(s, 'timestamp')}, count(*)::DOUBLE AS n_rows, round(avg(value), 6) AS avg_value "
        "FROM log GROUP BY ALL"
        for g, s in STEPS.items()
    )
)
def refresh_since_midday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored profiles after a full refresh and one from noon of a day in the middle: every window is there."""
    out = scratch_dir(spark, "refresh_since_midday")
    log, spec = inference_log(spark, sf_dir), log_spec(granularities=tuple(STEPS))
    for since in (None, "2024-01-20 12:00:00"):
        plans.refresh(log, spec, f"{out}/profile", f"{out}/drift", baseline(spark, sf_dir), since)
    metrics = read_metrics(spark, f"{out}/profile").where("column_name = 'value' and metric_name in ('count', 'avg')")
    wide = metrics.groupBy("granularity", "window_start", "window_end").pivot("metric_name", ["count", "avg"]).sum("metric_value")
    return rounded(
        wide.select("granularity", "window_start", "window_end", F.col("count").alias("n_rows"), F.col("avg").alias("avg_value")),
        "avg_value",
    )


VALUE_EDGES = [10.0 * x for x in range(1, 49)]
CONSECUTIVE_SCORES = f"""{CONSECUTIVE},
e AS (SELECT unnest([{', '.join(map(repr, VALUE_EDGES))}]) AS edge),
f AS (SELECT {DAY} AS window_start, edge, avg((value < edge)::INTEGER) AS q FROM log, e GROUP BY ALL),
k AS (SELECT *, lag(q) OVER (PARTITION BY edge ORDER BY window_start) AS p FROM f)
SELECT 'event_type' AS column_name, window_start, CASE WHEN max(i) > 1 THEN round({TV}, 6) END AS drift_score FROM paired GROUP BY window_start
UNION ALL SELECT 'value', window_start, round(max(abs(p - q)), 6) FROM k GROUP BY window_start"""


@workload(f"WITH {CONSECUTIVE_SCORES}")
def refresh_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored drift against the day before: a refresh of the first weeks, then one that reads touched days only."""
    out = scratch_dir(spark, "refresh_consecutive")
    log, spec = inference_log(spark, sf_dir), log_spec()
    first = log.where(F.col("timestamp") < F.lit("2024-01-21").cast("timestamp_ntz"))
    names = (f"{out}/drift", f"{out}/counts", f"{out}/edges")
    stored.refresh_consecutive(first, spec, *names, edges={"value": VALUE_EDGES})
    stored.refresh_consecutive(log, spec, *names, since="2024-01-20 12:00:00")
    return rounded(read_metrics(spark, f"{out}/drift").select("column_name", "window_start", "drift_score"), "drift_score")


@workload(f"""
WITH {BASE}
SELECT column_name, window_start, window_start + INTERVAL 1 DAY AS window_end, n AS window_count, true AS repeats, true AS in_range
FROM (SELECT date_trunc('day', timestamp)::TIMESTAMP AS window_start, count(*) AS n FROM live GROUP BY ALL),
     (VALUES ('value'), ('event_type')) c(column_name)""")
def refresh_against_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift against a stored baseline on the default bins; two refreshes agree to the digit without edges."""
    out = scratch_dir(spark, "refresh_against_baseline")
    log, spec = monitored(spark, sf_dir), log_spec()
    stored.save_baseline(baseline(spark, sf_dir), spec, f"{out}/baseline")
    for name in ("first", "second"):
        stored.refresh_against(log, spec, f"{out}/{name}", f"{out}/baseline")
    keys = ["column_name", "window_start", "window_end"]
    ours, again = (read_metrics(spark, f"{out}/{name}") for name in ("first", "second"))
    again = again.select(*keys, F.col("drift_score").alias("_again"))
    return ours.join(again, keys).select(
        *keys, "window_count", (F.col("drift_score") == F.col("_again")).alias("repeats"), F.col("drift_score").between(0, 1).alias("in_range")
    )


def _stored_quality(spark: SparkSession, log: DataFrame, spec: MonitorSpec, metrics: list[str]) -> DataFrame:
    out = scratch_dir(spark, "refresh_quality")
    plans.refresh(log, spec, f"{out}/profile", f"{out}/drift")
    kept = read_metrics(spark, f"{out}/profile").where(F.col("column_name") == ":table")
    wide = kept.groupBy("model_id", "window_start").pivot("metric_name", metrics).agg(F.first("metric_value"))
    return rounded(wide, *metrics)


@workload(f"""
WITH {CLASSIFIED},
w AS (SELECT *, time_bucket(INTERVAL '7 days', timestamp, TIMESTAMP '1970-01-01') AS window_start FROM classified),
ranked AS (SELECT *, rank() OVER g + (count(*) OVER (PARTITION BY window_start, model_id, score) - 1) / 2 AS r
           FROM w WINDOW g AS (PARTITION BY window_start, model_id ORDER BY score))
SELECT model_id, window_start, count(*)::DOUBLE AS labelled_rows, round(avg((label = prediction)::INTEGER), 6) AS accuracy,
       round(coalesce(count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (prediction = 1), 0), 0), 6) AS precision,
       round(coalesce(count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (label = 1), 0), 0), 6) AS recall,
       round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2)
             / nullif(count(*) FILTER (label = 1) * count(*) FILTER (label = 0), 0), 6) AS roc_auc
FROM ranked GROUP BY ALL""")
def refresh_quality_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of two return forecasts per week, read back from the stored profile table."""
    spec = MonitorSpec(
        granularities=("7 days",), model_id_col="model_id", label_col="label", score_col="score", numeric_cols=("score",), categorical_cols=()
    )
    return _stored_quality(spark, classified_lines(spark, sf_dir), spec, ["labelled_rows", "accuracy", "precision", "recall", "roc_auc"])


@workload(f"""
WITH {PRICED}
SELECT model_id, time_bucket(INTERVAL '30 days', timestamp, TIMESTAMP '1970-01-01') AS window_start, count(*)::DOUBLE AS labelled_rows,
       round(avg(abs(label - prediction)), 6) AS mae, round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse
FROM priced GROUP BY ALL""")
def refresh_quality_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a price forecast per 30 days, read back from the stored profile table."""
    spec = MonitorSpec(
        problem_type="regression", granularities=("30 days",), model_id_col="model_id", label_col="label",
        numeric_cols=("prediction",), categorical_cols=(),
    )
    return _stored_quality(spark, priced_lines(spark, sf_dir), spec, ["labelled_rows", "mae", "rmse"])


def _refreshed(spark: SparkSession, sf_dir: str, purpose: str) -> str:
    out = scratch_dir(spark, purpose)
    spec = log_spec(numeric_cols=())
    plans.refresh(monitored(spark, sf_dir), spec, f"{out}/profile", f"{out}/drift", baseline(spark, sf_dir))
    return out


@workload(f"""
WITH {BASE}
SELECT kind, status, max(date_trunc('day', timestamp))::TIMESTAMP AS latest_window_start,
       (max(date_trunc('day', timestamp)) + INTERVAL 1 DAY)::TIMESTAMP AS latest_window_end
FROM live, (VALUES ('profile', 'active'), ('drift', 'active')) k(kind, status) GROUP BY kind, status
UNION ALL SELECT kind, 'missing', NULL, NULL FROM (VALUES ('profile'), ('drift')) m(kind)""")
def monitor_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest windows of a monitor's tables, and those of a monitor that was never refreshed."""
    out = _refreshed(spark, sf_dir, "monitor_status")
    there = plans.monitor_status(spark, f"{out}/profile", f"{out}/drift")
    missing = plans.monitor_status(spark, f"{out}/no-profile", f"{out}/no-drift")
    bounds = {c: F.col(c).cast("timestamp_ntz") for c in ("latest_window_start", "latest_window_end")}
    return there.unionByName(missing).withColumns(bounds).drop("table_name", "n_rows")


@workload(f"""
WITH {SCORES}
SELECT drift_type, column_name, count(*) AS n_records, count(*) FILTER (drift_score > 0.1) AS n_high,
       round(max(drift_score), 6) AS max_score, max(window_end) AS last_window_end
FROM d WHERE window_end >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY ALL""")
def stored_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift report of the last week from the stored table."""
    out = _refreshed(spark, sf_dir, "stored_drift_report")
    return rounded(plans.analyze_drift(spark, f"{out}/drift", 7, AS_OF)["report"], "max_score")


@workload(f"""
WITH {SCORES}
SELECT 'prediction_drift' AS metric, 'warning' AS severity, column_name AS about, round(drift_score, 6) AS value
FROM d WHERE drift_score > 0.05 AND window_end >= DATE '{AS_OF}' - INTERVAL 1 DAY
UNION ALL
SELECT 'data_freshness', 'critical', event_type, round((epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(ts))) / 3.6e9, 6)
FROM events GROUP BY event_type
HAVING (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(ts))) / 3.6e9 > 24""")
def freshness_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a monitor: drift of the stored table, and logs without rows for more than a day."""
    out = _refreshed(spark, sf_dir, "freshness_rule")
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "model_id")
    ages = metric_rows(freshness_hours(events, "ts", "2024-03-01 00:00:00", ["model_id"]), "data_freshness", "hours_old", None)
    rules = [AlertRule("prediction_drift", 0.05), AlertRule("data_freshness", 24.0, "critical")]
    sent = plans.send_alerts(spark, f"{out}/drift", rules, "prod", as_of=AS_OF, other_metrics=ages)
    found = sent["violations"].select("metric", "severity", F.coalesce("column_name", "model_id").alias("about"), "value")
    return rounded(found, "value")
