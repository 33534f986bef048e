"""Refreshes from storage against full ones, and what they read."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidegauge import MonitorSpec
from tidegauge.operators.drift import drift
from tidegauge.operators.profile import profile
from tidegauge.plans import stored_windows as stored
from tidegauge.plans.monitoring import refresh
from tidegauge.session import scratch_dir
from tidegauge.sinks.tables import read_metrics

ROWS = [
    (f"2024-01-{day:02d} {hour:02d}:30:00", "a" if day % 3 else None, float(day * hour % 17) if hour % 5 else None, "x" if hour % 2 else "y")
    for day in (1, 2, 3, 5, 6, 9)
    for hour in range(0, 24, 3)
]
SPEC = MonitorSpec(
    granularities=("12 hours", "1 day"), model_id_col="model", numeric_cols=("value",), categorical_cols=("kind",),
    slicing_exprs=("kind = 'x'",),
)
EDGES = {"value": [2.0, 5.0, 9.0, 13.0]}


@pytest.fixture
def log(spark):
    return spark.createDataFrame(ROWS, "timestamp string, model string, value double, kind string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def rows(df):
    shown = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}).drop("window_date")
    found = [tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in sorted(shown.columns))) for r in shown.collect()]
    return sorted(found, key=str)


@pytest.mark.parametrize("since", ["2024-01-05", "2024-01-06 13:00:00", "2024-01-09 00:00:00"])
def test_refresh_since_equals_a_full_one(spark, log, since):
    out = scratch_dir(spark, "consecutive")
    names = [f"{out}/{n}" for n in ("drift", "counts", "edges")]
    stored.refresh_consecutive(log.where(F.col("timestamp") < F.lit(since).cast("timestamp_ntz")), SPEC, *names, edges=EDGES)
    stored.refresh_consecutive(log, SPEC, *names, since=since)
    assert stored.load_edges(spark, names[2]) == EDGES
    want = drift(log, SPEC, ["value"], ["kind"], edges=EDGES)
    assert rows(read_metrics(spark, names[0])) == rows(want)


def test_the_monitors_refresh_uses_storage(spark, log):
    out = scratch_dir(spark, "monitor")
    tables = {"profile_table": f"{out}/profile", "drift_table": f"{out}/drift", "counts_table": f"{out}/counts", "edges_table": f"{out}/edges"}
    early = log.where("timestamp < '2024-01-06'")
    refresh(early, SPEC, edges=EDGES, **tables)
    refresh(log.where("timestamp >= '2024-01-06'"), SPEC, since="2024-01-06", **tables)  # older rows are not there any more
    assert rows(read_metrics(spark, f"{out}/drift")) == rows(drift(log, SPEC, ["value"], ["kind"], edges=EDGES))
    with pytest.raises(ValueError, match="come together"):
        refresh(log, SPEC, "a/b", "c/d", counts_table="e/f")


def test_only_touched_days_of_the_log_are_read(spark, log):
    """The rows of a refresh carry a filter on the time that reaches the scan; earlier windows come from counts."""
    path = f"{scratch_dir(spark, 'log')}/log"
    log.write.parquet(path)
    starts = stored.first_window_starts(log, SPEC, "2024-01-06")
    touched = stored.cell_counts(stored.touched_rows(spark.read.parquet(path), SPEC, starts), SPEC, ["value"], ["kind"], EDGES)
    plan = touched._jdf.queryExecution().toString()
    assert len(re.findall(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(timestamp,2024-01-06", plan)) == len(re.findall("FileScan", plan)) > 0
    counts = stored.cell_counts(log, SPEC, ["value"], ["kind"], EDGES)
    kept = stored.windows_and_the_ones_before(counts, SPEC, starts)
    days = {(r.granularity, r.window_start.day) for r in kept.collect()}
    assert ("1 day", 5) in days and ("1 day", 3) in days and not {("1 day", 1), ("1 day", 2)} & days  # the model of day 3 has no later day before


def test_refreshes_against_a_stored_baseline(spark, log):
    out = scratch_dir(spark, "baseline")
    early, late = log.where("timestamp < '2024-01-05'"), log.where("timestamp >= '2024-01-05'")
    spec = replace(SPEC, model_id_col=None)
    stored.save_baseline(early, spec, f"{out}/base", edges=EDGES)
    stored.refresh_against(late, spec, f"{out}/drift", f"{out}/base")
    assert rows(read_metrics(spark, f"{out}/drift")) == rows(drift(late, spec, ["value"], ["kind"], early, edges=EDGES))
    with pytest.raises(ValueError, match="no baseline"):
        stored.refresh_against(late, spec, f"{out}/drift", f"{out}/nothing")


def test_profiles_of_stored_states(spark, log):
    out = scratch_dir(spark, "states")
    stored.refresh_states(log.where("timestamp < '2024-01-05'"), SPEC, f"{out}/states")
    stored.refresh_states(log, SPEC, f"{out}/states", since="2024-01-04")
    found = stored.profile_from_states(spark, SPEC, f"{out}/states", ["value"], ["kind"])
    assert rows(found) == rows(profile(log, SPEC))
    part = stored.profile_from_states(spark, SPEC, f"{out}/states", ["value"], ["kind"], from_time="2024-01-09 00:00:00")
    assert {r.window_start.day for r in part.collect()} == {9}
    with pytest.raises(ValueError, match="whole finest"):
        stored.refresh_states(log, replace(SPEC, granularities=("5 hours", "12 hours")), f"{out}/other")


def test_nothing_to_compare(spark, log):
    with pytest.raises(ValueError, match="no column"):
        stored.cell_counts(log, SPEC, [], [], {})
