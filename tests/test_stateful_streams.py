"""Streams that keep the window before, wait for labels, and store sketches."""

import pytest
from pyspark.sql import functions as F

from tidegauge import MonitorSpec
from tidegauge.operators.profile import numeric_profile, profile_of_merged_states
from tidegauge.session import scratch_dir
from tidegauge.streaming import log_streams as streams

SPEC = MonitorSpec(timestamp_col="ts", granularities=("1 hour",), model_id_col="model", numeric_cols=("value",), categorical_cols=("kind",))


def written(spark, rows, schema, purpose):
    """Rows as a stream of one file per batch, in the order given."""
    path = scratch_dir(spark, purpose)
    for batch in rows:
        spark.createDataFrame(batch, schema).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    return streams.read_log_stream(spark, path, spark.read.parquet(path).schema, "ts", maxFilesPerTrigger="1")


def test_each_window_meets_the_one_before_across_batches(spark):
    at = "2024-01-01 {:02d}:10:00".format
    batches = [
        [(at(0), "a", "x", 1.0), (at(0), "a", "y", 1.0), (at(1), "a", "x", 1.0), (at(1), None, "z", 1.0)],
        [(at(4), "a", "x", 1.0), (at(4), "a", None, 1.0), (at(4), None, "z", 1.0)],
        [(at(9), "a", "y", 1.0)],
        [(at(23), "a", "y", 1.0)],
    ]
    stream = written(spark, batches, "ts string, model string, kind string, value double", "windows")
    out = scratch_dir(spark, "pairs")
    pairs = streams.consecutive_counts(streams.stream_value_counts(stream, SPEC, ["kind"], "0 seconds"))
    streams.run_available(pairs, f"{out}/data", f"{out}/checkpoint", streams.KEYED_STATE)
    got = {
        (r.model_id, r.window_start.hour): (r.window_count, r.reference_count, r.total_variation)
        for r in streams.consecutive_scores(spark.read.parquet(f"{out}/data")).collect()
    }
    assert got == {
        ("a", 0): (2, 0, None), ("a", 1): (1, 2, 0.5), ("a", 4): (1, 1, 0.0), ("a", 9): (1, 1, 1.0),
        (None, 1): (1, 0, None), (None, 4): (1, 1, 0.0),
    }


def test_labels_in_time_and_rows_without(spark):
    at = "2024-01-01 {:02d}:00:00".format
    log = written(spark, [[(at(0), 1), (at(0), 2), (at(1), 3)], [(at(9), 4)], [(at(20), 5)]], "ts string, id long", "log")
    labels = written(spark, [[(at(1), 1, 0), (at(8), 2, 1)], [(at(9), 4, 1), (at(9), 4, 0)], [(at(20), 9, 1)]], "ts string, id long, label long", "labels")
    joined = streams.stream_late_labels(log, labels.withColumnRenamed("ts", "told"), "id", "ts", "told", "2 HOURS", "0 seconds")
    out = scratch_dir(spark, "joined")
    streams.run_available(joined, f"{out}/data", f"{out}/checkpoint")
    got = sorted((r.id, r.label) for r in spark.read.parquet(f"{out}/data").collect() if r.label is not None)
    without = [r.id for r in spark.read.parquet(f"{out}/data").where("label IS NULL").collect()]
    assert got == [(1, 0), (4, 0), (4, 1)]
    assert sorted(without) == [2, 3]  # each once; 5 may still get a label


def test_sketched_states_give_the_profile_of_all_granularities(spark):
    rows = [[(f"2024-01-01 {h:02d}:{m:02d}:00", "a", "x", float(h * m % 13) if m % 7 else None) for h in range(6) for m in range(60)], [("2024-01-02 00:00:00", "a", "x", 1.0)]]
    schema = "ts string, model string, kind string, value double"
    spec = MonitorSpec(timestamp_col="ts", granularities=("1 hour", "2 hours"), model_id_col="model", numeric_cols=("value",), categorical_cols=())
    out = scratch_dir(spark, "states")
    streams.run_available(streams.stream_profile_states(written(spark, rows, schema, "rows"), spec, ["value"], "0 seconds"), f"{out}/data", f"{out}/checkpoint")
    found = profile_of_merged_states(spark.read.parquet(f"{out}/data"), spec, ["value"], [])
    batch = spark.createDataFrame(rows[0], schema).withColumn("ts", F.col("ts").cast("timestamp"))

    def shown(df):
        return sorted((r.granularity, str(r.window_start), r.metric_name, r.metric_value and round(r.metric_value, 9)) for r in df.collect())

    assert shown(found) == shown(numeric_profile(batch, spec, ["value"]))
    with pytest.raises(ValueError, match="whole finest"):
        streams.stream_profile_states(batch, MonitorSpec(timestamp_col="ts", granularities=("5 hours", "2 hours")), ["value"])
