"""Alert rules against metric tables, and the texts of the alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import join_groups, ratio
from tidegauge.functions.scalars import alert_subject, is_recent, violation_line
from tidegauge.spec import AlertRule

# The alert metrics, and the side of the threshold on which each fires.
DIRECTIONS = {
    "prediction_drift": "above",
    "data_quality_score": "below",
    "mae_increase": "above",
    "forecast_accuracy_drop": "above",
    "data_freshness": "above",
}
HIGH_DRIFT = 0.1
# What a metric row says about where its number comes from.
ORIGIN = ["granularity", "model_id", "slice_key", "slice_value"]
RULE_SCHEMA = (
    "metric string, threshold double, severity string, notification_type string, recipients array<string>"
)


def rules_table(spark: SparkSession, rules: list[AlertRule]) -> DataFrame:
    """The rules of a settings file as a table."""
    return spark.createDataFrame(
        [(r.metric, r.threshold, r.severity, r.notification_type, list(r.recipients)) for r in rules],
        RULE_SCHEMA,
    )


def _fires(metric: Column, value: Column, threshold: Column) -> Column:
    below = [m for m, side in DIRECTIONS.items() if side == "below"]
    return F.when(metric.isin(below), value < threshold).otherwise(value > threshold)


def recent_windows(metrics: DataFrame, days: int, as_of: str | dt.date | None = None) -> DataFrame:
    """Windows that end on or after the day ``days`` before ``as_of``."""
    return metrics.where(is_recent("window_end", days, as_of))


def score_rows(drift: DataFrame) -> DataFrame:
    """The scores of a drift table, which may hold further measures beside them."""
    return drift.where(F.col("metric_name") == "drift_score") if "metric_name" in drift.columns else drift


def above_threshold(drift: DataFrame, threshold: float = HIGH_DRIFT) -> DataFrame:
    """Strictly above; a null score never passes, and only score rows are looked at."""
    return score_rows(drift).where(F.col("drift_score") > threshold)


def drift_violations(
    drift: DataFrame,
    threshold: float,
    days: int = 1,
    as_of: str | dt.date | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Recent drift above a threshold. Any column counts unless ``columns`` narrows it."""
    found = above_threshold(recent_windows(drift, days, as_of), threshold)
    if columns is not None:
        found = found.where(F.col("column_name").isin(columns))
    return found.select("column_name", "drift_score", "drift_type", "window_end")


def top_drift(drift: DataFrame, n: int = 10, threshold: float = HIGH_DRIFT) -> DataFrame:
    """The greatest scores above the threshold; equal scores in order of name and time."""
    return (
        above_threshold(drift, threshold)
        .select("column_name", "drift_score", "window_end")
        .orderBy(F.desc("drift_score"), "column_name", "window_end")
        .limit(n)
    )


def drift_report(
    drift: DataFrame, days: int = 7, as_of: str | dt.date | None = None, threshold: float = HIGH_DRIFT
) -> DataFrame:
    """Recent drift scores and how many of them are high, per drift type and column: one pass."""
    high = F.col("drift_score") > threshold
    return (
        recent_windows(score_rows(drift), days, as_of)
        .groupBy("drift_type", "column_name")
        .agg(
            F.count("*").alias("n_records"),
            F.count(F.when(high, True)).alias("n_high"),
            F.max("drift_score").alias("max_score"),
            F.max("window_end").alias("last_window_end"),
        )
    )


def drift_metrics(drift: DataFrame) -> DataFrame:
    """Drift scores as alert metric rows, with the granularity, model and slice each is for."""
    return score_rows(drift).select(
        F.lit("prediction_drift").alias("metric"),
        "column_name",
        "drift_type",
        F.col("drift_score").alias("value"),
        "window_end",
        *_origin(drift),
    )


def _origin(table: DataFrame) -> list[Column]:
    """The origin columns, null where a table has none."""
    return [F.col(c) if c in table.columns else F.lit(None).cast("string").alias(c) for c in ORIGIN]


def metric_rows(
    values: DataFrame, metric: str, value: str, window_end: str | None = "window_end", column_name: str | None = None
) -> DataFrame:
    """Any number as alert metric rows; ``window_end`` is None for one that belongs to no window."""
    return values.select(
        F.lit(metric).alias("metric"),
        F.lit(column_name).cast("string").alias("column_name"),
        F.lit(None).cast("string").alias("drift_type"),
        F.col(value).cast("double").alias("value"),
        (F.col(window_end) if window_end else F.lit(None).cast("timestamp")).alias("window_end"),
        *_origin(values),
    )


def evaluate_rules(
    metrics: DataFrame, rules: DataFrame, days: int | None = 1, as_of: str | dt.date | None = None
) -> DataFrame:
    """Every rule against every metric row in one join; one row per violation.

    ``metrics`` holds ``metric, column_name, drift_type, value, window_end`` and where a row
    comes from. A row without a window, such as the age of a log, is always current. How the
    rules reach the tasks is left to the measured size of their table.
    """
    current = F.col("window_end").isNull()
    recent = metrics if days is None else metrics.where(current | is_recent("window_end", days, as_of))
    joined = recent.join(rules, "metric")
    return joined.where(_fires(F.col("metric"), F.col("value"), F.col("threshold")))


def unknown_metrics(rules: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Rules whose metric nobody computes: a warning per rule, not a failure."""
    if known is None:
        missing = rules.where(~F.col("metric").isin(list(DIRECTIONS)))
    else:
        missing = rules.join(known.select("metric").distinct(), "metric", "left_anti")
    return missing.select(
        "metric", "severity", F.concat(F.lit("Unknown alert metric: "), F.col("metric")).alias("warning")
    )


def alert_summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("metric", "severity").agg(F.count("*").alias("n_violations"))


def alert_messages(
    violations: DataFrame, environment: str, catalog: str = "", schema: str = "", part_size: int = 1000
) -> DataFrame:
    """Subject and body per rule, at most ``part_size`` lines in one message.

    More lines make as many parts as needed, so every violation is written out and no
    message, nor the task that puts it together, is unbounded. Equal violations are counted
    before they are dealt out, and each copy has a line. The subject counts columns.
    """
    rule = ["metric", "severity", "threshold"]
    sizes = violations.groupBy(*rule).agg(
        F.count("*").alias("n_violations"), F.count_distinct("column_name").alias("n_columns")
    )
    told = ["column_name", "drift_type", "value", "window_end", *[c for c in ORIGIN if c in violations.columns]]
    copies = violations.groupBy(*rule, *told).agg(F.count("*").alias("_copies"))
    each = copies.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    spread = F.pmod(F.xxhash64(*told, "_copy"), F.ceil(F.col("n_violations") / part_size))
    origin = [F.col(c) for c in ("model_id", "slice_key", "slice_value") if c in violations.columns]
    named = F.concat_ws(", ", *origin)
    line = F.concat(
        violation_line(F.col("column_name"), F.col("value"), F.col("drift_type")),
        F.when(named != "", F.concat(F.lit(" in "), named)).otherwise(""),
    )
    lines = join_groups(each, sizes, rule, "inner").select(
        *rule, "n_violations", "n_columns", spread.cast("int").alias("_bin"), line.alias("_line")
    )
    inside = Window.partitionBy(*rule, "_bin").orderBy("_line")
    block = F.floor((F.row_number().over(inside) - 1) / part_size).cast("int")
    body = F.concat_ws(
        "\n",
        F.lit(f"{environment}, {catalog}.{schema}"),
        F.concat(F.lit("Threshold "), F.col("threshold").cast("string")),
        F.col("violation_lines"),
    )
    return (
        lines.withColumn("_block", block)
        .groupBy(*rule, "n_violations", "n_columns", "_bin", "_block")
        .agg(F.array_join(F.sort_array(F.collect_list("_line")), "\n").alias("violation_lines"))
        .select(
            "metric",
            "severity",
            # bins come first; what a bin holds beyond one message follows after all bins
            (F.col("_block") * F.ceil(F.col("n_violations") / part_size) + F.col("_bin")).cast("int").alias("part"),
            "n_violations",
            alert_subject(environment, F.col("n_columns")).alias("subject"),
            "violation_lines",
            body.alias("body"),
        )
    )


def relative_change(
    windows: DataFrame, value: str, reference: float | None = None, keys: list[str] | None = None
) -> DataFrame:
    """Change of a per-window metric, relative to a given reference or to the window before.

    ``windows`` is a metric table: one row per window, model and slice. A fall is
    negative whatever the sign of the reference; there is no change relative to 0.
    """
    if reference is None:
        order = Window.partitionBy(*(keys or [])).orderBy("window_start")
        base = F.lag(value).over(order)
    else:
        base = F.lit(float(reference))
    sized = windows.withColumn("reference_value", base)
    return sized.withColumn(
        "relative_change", ratio(F.col(value) - F.col("reference_value"), F.abs("reference_value"))
    )


def freshness_hours(log: DataFrame, timestamp_col: str, as_of: str, keys: list[str] | None = None) -> DataFrame:
    """Hours between the newest row and ``as_of``, fractions kept."""
    def micros(c: Column) -> Column:
        return F.unix_micros(c.cast("timestamp"))

    age = (micros(F.lit(as_of)) - micros(F.col("newest"))) / 3.6e9
    return log.groupBy(*(keys or [])).agg(F.max(timestamp_col).alias("newest")).select(
        *(keys or []), "newest", age.alias("hours_old")
    )
