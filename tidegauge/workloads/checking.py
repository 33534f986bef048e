"""Data quality rules and their score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import quality as dq
from tidegauge.operators.windows import grouped_rows
from tidegauge.workloads.bindings import (
    BASE,
    LOG,
    SERIES,
    baseline,
    daily_orders,
    inference_log,
    log_spec,
    monitored,
    rounded,
    table,
)
from tidegauge.workloads.registry import WORKLOADS, workload

DAY = "time_bucket(INTERVAL '1 day', timestamp)"


def verdict(rule: str, column: str, checked: str, failed: str, limit: float, extra: str = "") -> str:
    checked, failed = f"({checked})", f"({failed})"
    return f"""'{rule}' AS rule, '{column}' AS column_name, {checked} AS checked, {failed} AS failed,
       {limit}::DOUBLE AS max_failed,
       round(1 - CASE WHEN {checked} = 0 THEN 0 ELSE {failed} / {checked} END, 6) AS pass_share,
       CASE WHEN {checked} = 0 THEN 0 ELSE {failed} / {checked} END <= {limit} AS passed{extra}"""


def _shares(checks: DataFrame) -> DataFrame:
    return rounded(checks, "pass_share")


@workload(f"""
SELECT {verdict('null_check', 'quality', 'count(*)', 'count(*) - count(quality)', 0.5)}
FROM documents LEFT JOIN labels USING (doc_id)""")
def dq_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label, half of them allowed."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    joined = documents.join(labels, "doc_id", "left")
    return _shares(dq.check_rows(joined, [dq.null_check("quality", 0.5)]))


@workload(f"""
WITH t AS (SELECT ts, props[2:5] AS text, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'n/a'
                                               ELSE value::VARCHAR END AS v FROM events)
SELECT {verdict('type_check', 'v', 'count(v)', 'count(v) FILTER (TRY_CAST(v AS DOUBLE) IS NULL)', 0.1)} FROM t
UNION ALL
SELECT {verdict('type_check', 'text', 'count(text)', 'count(text) FILTER (TRY_CAST(text AS DOUBLE) IS NULL)', 0.1)} FROM t""")
def dq_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 4 == 0, F.lit(None)).when(F.col("event_id") % 5 == 0, "n/a")
    events = table(spark, sf_dir, "events").select(
        text.otherwise(F.col("value").cast("string")).alias("v"), F.substring("props", 2, 4).alias("text")
    )
    return _shares(dq.check_rows(events, [dq.type_check("v", "double", 0.1), dq.type_check("text", "double", 0.1)]))


@workload(f"""
WITH {BASE}, r AS (SELECT min(value) AS lo, max(value) AS hi FROM base)
SELECT {verdict('range_check', 'value', 'count(value)', 'count(value) FILTER (NOT value BETWEEN lo AND hi)', 0.001)}
FROM live, r""")
def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live values outside the baseline's extremes."""
    low, high = dq.baseline_range(baseline(spark, sf_dir), "value")
    return _shares(dq.check_rows(monitored(spark, sf_dir), [dq.range_check("value", low, high, 0.001)]))


@workload(f"""
WITH {BASE}, c AS (SELECT value, count(*) AS n FROM live WHERE value IS NOT NULL GROUP BY value),
u AS (SELECT c.*, c.value NOT IN (SELECT value FROM base) AS unseen FROM c),
a AS (SELECT count(*) AS distinct_count, count(*) FILTER (unseen) AS unseen_values, sum(n)::BIGINT AS checked,
             coalesce(sum(n) FILTER (unseen), 0)::BIGINT AS failed FROM u)
SELECT 'cardinality_check' AS rule, 'value' AS column_name, distinct_count, unseen_values, checked, failed,
       0.2::DOUBLE AS max_failed, round(1 - failed / checked, 6) AS pass_share, failed / checked <= 0.2 AS passed
FROM a""")
def dq_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct live values and the rows whose value the baseline has never had."""
    found = dq.cardinality_check(
        monitored(spark, sf_dir), ["value"], {"value": (1, 10**12)}, baseline(spark, sf_dir), 0.2
    )
    return _shares(found)


@workload(f"""
WITH {BASE}
SELECT value, count(*) AS n FROM live WHERE value NOT IN (SELECT value FROM base) GROUP BY value""")
def unseen_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.unseen_values(monitored(spark, sf_dir), baseline(spark, sf_dir), "value")


@workload(f"""
WITH {BASE},
q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM base),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT {verdict('outlier_check', 'value', 'count(value)', 'count(value) FILTER (NOT value BETWEEN lo AND hi)', 0.05)}
FROM live, f""")
def dq_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fences = dq.baseline_fences(baseline(spark, sf_dir), "value", exact=True)
    return _shares(dq.check_rows(monitored(spark, sf_dir), [dq.outlier_check("value", fences, 0.05)]))


@workload("""
WITH s AS (SELECT c_mktsegment, date_trunc('day', o_orderdate)::TIMESTAMP AS d, o_orderdate AS t
           FROM orders JOIN customer ON o_custkey = c_custkey),
spans AS (SELECT c_mktsegment, date_diff('day', min(d), max(d)) + 1 AS checked, count(DISTINCT d) AS present FROM s GROUP BY 1),
repeats AS (SELECT c_mktsegment, (count(*) - count(DISTINCT t))::BIGINT AS duplicate_timestamps FROM s GROUP BY 1)
SELECT c_mktsegment, 'temporal_consistency' AS rule, 'o_orderdate' AS column_name, checked, checked - present AS failed,
       duplicate_timestamps, 0.25::DOUBLE AS max_failed, round(1 - (checked - present) / checked, 6) AS pass_share,
       (checked - present) / checked <= 0.25 AS passed
FROM spans JOIN repeats USING (c_mktsegment)""")
def dq_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without orders and repeated order times, per market segment."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return _shares(dq.temporal_consistency(joined, "o_orderdate", "daily", ["c_mktsegment"], 0.25))


@workload(f"""
WITH {SERIES},
l AS (SELECT *, lag(total, 7) OVER (PARTITION BY o_orderpriority ORDER BY period) AS earlier FROM series)
SELECT o_orderpriority, 'seasonality_check' AS rule, 'total' AS column_name, count(earlier) AS checked,
       round(corr(total, earlier), 6) AS autocorrelation,
       CASE WHEN corr(total, earlier) >= 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS pass_share, corr(total, earlier) >= 0 AS passed
FROM l GROUP BY o_orderpriority""")
def dq_seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dq.seasonality_check(daily_orders(spark, sf_dir), "period", "total", 7, 0.0, ["o_orderpriority"])
    return rounded(found, "autocorrelation")


@workload(f"""
WITH {LOG},
c AS (SELECT {DAY} AS window_start, count(*) AS n, count(*) FILTER (event_type IS NULL) AS nulls,
             count(*) FILTER (NOT value BETWEEN 1 AND 200) AS range_failed,
             count(*) FILTER (NOT value BETWEEN 0 AND 100) AS outliers,
             count(*) FILTER (TRY_CAST(event_type AS DOUBLE) IS NULL) AS mistyped FROM log GROUP BY 1)
SELECT window_start, 4::BIGINT AS n_rules,
       ((nulls = 0)::INTEGER + (range_failed / n <= 0.03)::INTEGER + (outliers / n <= 0.05)::INTEGER + (mistyped / n <= 0)::INTEGER)::BIGINT AS n_passed,
       round(((1 - nulls / n) + (1 - range_failed / n) + (1 - outliers / n) + (1 - mistyped / n)) / 4, 6) AS data_quality_score
FROM c""")
def dq_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rules per day in one pass, and their mean pass share."""
    rows, keys = grouped_rows(
        inference_log(spark, sf_dir), log_spec(), {c: F.col(c) for c in ("value", "event_type")}
    )
    rules = [
        dq.null_check("event_type"),
        dq.range_check("value", 1, 200, 0.03),
        dq.outlier_check("value", (0, 100), 0.05),
        dq.type_check("event_type", "double"),
    ]
    found = dq.quality_score(dq.check_rows(rows, rules, keys), keys)
    return rounded(found.drop("granularity", "window_end"), "data_quality_score")


ALL_RULES = {
    "null_check": "dq_null", "type_check": "dq_type", "range_check": "dq_range", "cardinality_check": "dq_cardinality",
    "outlier_check": "dq_outlier", "temporal_consistency": "dq_temporal", "seasonality_check": "dq_seasonality",
}


@workload(
    "SELECT count(*) AS n_rules, count(*) FILTER (passed) AS n_passed, round(avg(pass_share), 5) AS data_quality_score FROM ("
    + " UNION ALL ".join(f"SELECT pass_share, passed FROM ({WORKLOADS[name].sql}) q{i}" for i, name in enumerate(ALL_RULES.values()))
    + ") checks"
)
def dq_score_all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One score over all seven rules, as a template names them."""
    available = {rule: WORKLOADS[name].run(spark, sf_dir) for rule, name in ALL_RULES.items()}
    return rounded(dq.quality_score(dq.checks_named(tuple(ALL_RULES), available)), "data_quality_score", digits=5)
