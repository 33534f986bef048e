"""Streams over the event table, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.alerts import rules_table
from tidegauge.operators.distribution import category_long, value_counts
from tidegauge.operators.profile import profile_of_merged_states
from tidegauge.operators.windows import with_windows
from tidegauge.session import scratch_dir
from tidegauge.spec import AlertRule
from tidegauge.streaming import log_streams as streams
from tidegauge.workloads.bindings import BASE, BASELINE_END, log_spec, rounded, table
from tidegauge.workloads.drifting import CONSECUTIVE, DAY, EVENT_TYPES, TV
from tidegauge.workloads.registry import workload

DELAY = "1 day"
# windows stay open until the newest event is a day past their end
CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM events)"


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    # a pattern, because the table may be one file or a folder of files
    return streams.read_log_stream(spark, f"{sf_dir}/events.parque[t]", schema, "ts")


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@workload(f"""
SELECT '1 day' AS granularity, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS n_rows,
       count(*) - count(value) AS value_num_nulls, round(avg(value), 6) AS value_avg, min(value) AS value_min,
       max(value) AS value_max, round(stddev_samp(value), 6) AS value_stddev, quantile_disc(value, 0.5) AS value_median
FROM (SELECT *, time_bucket(INTERVAL '1 day', ts) AS window_start FROM events)
WHERE window_start + INTERVAL 1 DAY <= {CLOSED} GROUP BY window_start""")
def stream_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily profile of the closed windows."""
    out = scratch_dir(spark, "stream_profile")
    spec = log_spec(timestamp_col="ts")
    profile = streams.stream_profile(_event_stream(spark, sf_dir), spec, ["value"], DELAY)
    streams.run_available(profile, f"{out}/data", f"{out}/checkpoint")
    return rounded(_naive(spark.read.parquet(f"{out}/data"), "window_start", "window_end"), "value_avg", "value_stddev")


@workload("SELECT event_id, ts, event_type, value FROM events")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per request id of a stream that delivers every event twice."""
    out = scratch_dir(spark, "stream_dedupe")
    events = _event_stream(spark, sf_dir).select("event_id", "ts", "event_type", "value")
    unique = streams.stream_unique_requests(events.unionByName(events), "event_id", "ts", DELAY)
    streams.run_available(unique, f"{out}/data", f"{out}/checkpoint")
    return _naive(spark.read.parquet(f"{out}/data"), "ts")


@workload(f"""
WITH {EVENT_TYPES}
SELECT 'event_type' AS column_name, 'baseline' AS drift_type, window_start, round({TV}, 6) AS total_variation
FROM paired WHERE window_start + INTERVAL 1 DAY <= {CLOSED} GROUP BY window_start""")
def stream_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of each closed day against the first week, scored batch by batch."""
    out = scratch_dir(spark, "stream_drift")
    first_week = F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz")
    base = table(spark, sf_dir, "events").where(first_week)
    baseline_counts = value_counts(category_long(base, [], ["event_type"]), ["column_name"])
    later = _event_stream(spark, sf_dir).where(F.col("ts") >= F.lit(BASELINE_END).cast("timestamp"))
    counts = streams.stream_value_counts(later, log_spec(timestamp_col="ts"), ["event_type"], DELAY)
    streams.run_available_batches(counts, streams.drift_sink(baseline_counts, f"{out}/data"), f"{out}/checkpoint")
    found = _naive(spark.read.parquet(f"{out}/data"), "window_start").select(
        "column_name", "drift_type", "window_start", "total_variation"
    )
    return rounded(found, "total_variation")


def _categories_by_model() -> str:
    """Drift of event types by model: windows of each model against the baseline of all."""
    return f"""{BASE},
wc AS (SELECT model_id, {DAY} AS window_start, event_type AS v, count(*) AS n FROM live GROUP BY ALL),
bc AS (SELECT event_type AS v, count(*) AS n FROM base GROUP BY ALL),
groups AS (SELECT DISTINCT model_id, window_start FROM wc),
cells AS (SELECT model_id, window_start, v FROM groups CROSS JOIN (SELECT v FROM bc) UNION SELECT model_id, window_start, v FROM wc),
paired AS (
  SELECT c.*, coalesce(bc.n, 0) / (SELECT sum(n) FROM bc) AS p,
         coalesce(wc.n, 0) / sum(wc.n) OVER (PARTITION BY c.model_id, c.window_start) AS q
  FROM cells c LEFT JOIN wc USING (model_id, window_start, v) LEFT JOIN bc USING (v)),
scores AS (SELECT model_id, window_start, {TV} AS score FROM paired
           WHERE window_start + INTERVAL 1 DAY <= {CLOSED} GROUP BY ALL)"""


def _model_stream(spark, sf_dir):
    """The event stream of the monitored time with a model id, and the baseline's value counts."""
    model = F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string"))
    later = _event_stream(spark, sf_dir).where(F.col("ts") >= F.lit(BASELINE_END).cast("timestamp"))
    base = table(spark, sf_dir, "events").where(F.col("ts") < F.lit(BASELINE_END).cast("timestamp_ntz"))
    return later.withColumn("model_id", model), value_counts(category_long(base, [], ["event_type"]), ["column_name"])


def _scored_stream(spark, sf_dir, purpose: str) -> str:
    out, spec = scratch_dir(spark, purpose), log_spec(timestamp_col="ts", model_id_col="model_id")
    events, base = _model_stream(spark, sf_dir)
    counts = streams.stream_value_counts(events, spec, ["event_type"], DELAY)
    rules = rules_table(spark, [AlertRule("prediction_drift", 0.1, "critical")])
    sink = streams.drift_sink(base, f"{out}/data", spec, rules, f"{out}/alerts")
    streams.run_available_batches(counts, sink, f"{out}/checkpoint")
    return out


@workload(f"WITH {_categories_by_model()} SELECT model_id, window_start, round(score, 6) AS total_variation FROM scores")
def stream_drift_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of each model's closed days against the first week."""
    out = _scored_stream(spark, sf_dir, "stream_drift_by_model")
    found = _naive(spark.read.parquet(f"{out}/data"), "window_start")
    return rounded(found.select("model_id", "window_start", "total_variation"), "total_variation")


@workload(f"""
WITH {_categories_by_model()}
SELECT 'critical' AS severity, model_id, 'event_type' AS column_name, window_start + INTERVAL 1 DAY AS window_end, round(score, 6) AS value
FROM scores WHERE score > 0.1""")
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts raised batch by batch, with the model each is about."""
    out = _scored_stream(spark, sf_dir, "stream_alerts")
    found = _naive(spark.read.parquet(f"{out}/alerts"), "window_end")
    return rounded(found.select("severity", "model_id", "column_name", "window_end", "value"), "value")


@workload(f"""
WITH sliced AS (
  SELECT *, NULL::VARCHAR AS slice_key, NULL::VARCHAR AS slice_value FROM events
  UNION ALL SELECT *, 'event_type = ''error''', (event_type = 'error')::VARCHAR FROM events),
cut AS (
  SELECT '1 day' AS granularity, INTERVAL 1 DAY AS step, * FROM sliced UNION ALL SELECT '6 hours', INTERVAL 6 HOUR, * FROM sliced),
w AS (SELECT *, time_bucket(step, ts, TIMESTAMP '1970-01-01') AS window_start FROM cut)
SELECT granularity, window_start, slice_key, slice_value, count(*) AS n_rows, round(avg(value), 6) AS value_avg, max(value) AS value_max
FROM w WHERE window_start + step <= {CLOSED} GROUP BY ALL""")
def stream_profile_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of closed windows at two granularities, for all events and for errors and others."""
    out = scratch_dir(spark, "stream_profile_by_slice")
    spec = log_spec(timestamp_col="ts", granularities=("1 day", "6 hours"), slicing_exprs=("event_type = 'error'",))
    profile = streams.stream_profile(_event_stream(spark, sf_dir), spec, ["value"], DELAY)
    streams.run_available(profile, f"{out}/data", f"{out}/checkpoint")
    found = _naive(spark.read.parquet(f"{out}/data"), "window_start")
    return rounded(
        found.select("granularity", "window_start", "slice_key", "slice_value", "n_rows", "value_avg", "value_max"), "value_avg"
    )


@workload(f"""
WITH {CONSECUTIVE}
SELECT 'event_type' AS column_name, window_start, CASE WHEN max(i) > 1 THEN round({TV}, 6) END AS total_variation
FROM paired WHERE window_start + INTERVAL 1 DAY <= {CLOSED} GROUP BY window_start""")
def stream_drift_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of each closed day from the day before, whose counts the stream keeps as state."""
    out = scratch_dir(spark, "stream_drift_consecutive")
    events = _event_stream(spark, sf_dir)
    counts = streams.stream_value_counts(events, log_spec(timestamp_col="ts"), ["event_type"], DELAY)
    streams.run_available(streams.consecutive_counts(counts), f"{out}/data", f"{out}/checkpoint", streams.KEYED_STATE)
    scored = streams.consecutive_scores(spark.read.parquet(f"{out}/data"))
    found = _naive(scored, "window_start").select("column_name", "window_start", "total_variation")
    return rounded(found, "total_variation")


@workload("""
WITH labels AS (SELECT event_id, ts + INTERVAL 6 HOUR AS labelled_at, (value > 50)::INTEGER::DOUBLE AS label FROM events
                WHERE event_type = 'purchase' AND event_id % 3 <> 0),
closed AS (SELECT least((SELECT max(ts) FROM events), (SELECT max(labelled_at) FROM labels)) - INTERVAL 1 DAY AS t)
SELECT e.event_id, e.event_type, l.label FROM events e LEFT JOIN labels l USING (event_id)
WHERE l.event_id IS NOT NULL OR e.ts + INTERVAL 12 HOUR < (SELECT t FROM closed)""")
def stream_late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with labels that arrive hours later in a stream of their own; rows whose time is over come without one."""
    out = scratch_dir(spark, "stream_late_labels")
    log = _event_stream(spark, sf_dir).select("event_id", "event_type", "ts")
    purchases = _event_stream(spark, sf_dir).where((F.col("event_type") == "purchase") & (F.col("event_id") % 3 != 0))
    labels = purchases.select("event_id", (F.col("ts") + F.expr("INTERVAL 6 HOURS")).alias("labelled_at"), (F.col("value") > 50).cast("double").alias("label"))
    joined = streams.stream_late_labels(log, labels, "event_id", "ts", "labelled_at", "12 HOURS", DELAY)
    streams.run_available(joined, f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data").select("event_id", "event_type", "label")


STEPS = {"6 hours": "INTERVAL 6 HOUR", "1 day": "INTERVAL 1 DAY"}


@workload(f"""
WITH closed AS (SELECT * FROM events WHERE time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') + INTERVAL 6 HOUR <= {CLOSED}),
cut AS ({' UNION ALL '.join(f"SELECT '{g}' AS granularity, time_bucket({s}, ts, TIMESTAMP '1970-01-01') AS window_start, value FROM closed" for g, s in STEPS.items())})
SELECT granularity, window_start, count(*)::DOUBLE AS n_rows, round(avg(value), 6) AS avg_value, round(stddev_samp(value), 6) AS stddev_value,
       max(value) AS max_value, true AS median_is_close, true AS distinct_is_close
FROM cut GROUP BY ALL""")
def stream_profile_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles at two granularities from sketches that the stream keeps for the finer one.

    Medians and distinct counts are held against exact ones of the same windows: within 2 % of
    rank, and within 10 % of the number of values.
    """
    out = scratch_dir(spark, "stream_profile_sketched")
    spec = log_spec(timestamp_col="ts", granularities=tuple(STEPS))
    states = streams.stream_profile_states(_event_stream(spark, sf_dir), spec, ["value"], DELAY)
    streams.run_available(states, f"{out}/data", f"{out}/checkpoint")
    stored = spark.read.parquet(f"{out}/data")
    keys = ["granularity", "window_start"]
    long = _naive(profile_of_merged_states(stored, spec, ["value"], []), "window_start")
    names = {"count": "n_rows", "avg": "avg_value", "stddev": "stddev_value", "max": "max_value", "median": "_median", "distinct_count": "_distinct"}
    wide = long.groupBy(*keys).pivot("metric_name", list(names)).agg(F.first("metric_value")).select(*keys, *[F.col(m).alias(c) for m, c in names.items()])
    rows = table(spark, sf_dir, "events").select("ts", "value")
    cut = with_windows(rows, "ts", spec.granularities)
    same = cut.join(wide.select(*keys, "_median", F.col("_distinct").alias("_estimate")), keys)
    checked = same.groupBy(*keys).agg(
        F.avg((F.col("value") < F.col("_median")).cast("int")).alias("_below"), F.avg((F.col("value") <= F.col("_median")).cast("int")).alias("_up_to"),
        F.countDistinct("value").alias("_exact"), F.max("_estimate").alias("_estimate"), F.count("*").alias("_all"),
    )
    # a day whose last quarters are not closed has fewer rows in the stream than in the table
    whole = F.col("_all") == F.col("n_rows")
    found = wide.join(checked, keys).select(
        *keys, *[c for c in names.values() if not c.startswith("_")],
        (~whole | ((F.col("_below") <= 0.52) & (F.col("_up_to") >= 0.48))).alias("median_is_close"),
        (~whole | (F.abs(F.col("_estimate") - F.col("_exact")) <= 0.1 * F.col("_exact"))).alias("distinct_is_close"),
    )
    return rounded(found, "avg_value", "stddev_value")
