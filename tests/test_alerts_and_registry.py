import datetime as dt

import pytest

from tidegauge.functions import scalars
from tidegauge.operators import alerts
from tidegauge.operators import registry as reg
from tidegauge.spec import AlertRule
from pyspark.sql import functions as F

AS_OF = "2024-01-31"


def drift(spark, *rows):
    """rows of (column, score, window_end)"""
    data = [(c, "baseline", s, e) for c, s, e in rows]
    return spark.createDataFrame(data, "column_name string, drift_type string, drift_score double, window_end timestamp")


def test_recency_bound_is_included_and_threshold_is_not(spark):
    on_bound = dt.datetime(2024, 1, 30)
    table = drift(
        spark,
        ("kept", 0.2, on_bound),
        ("too_old", 0.2, on_bound - dt.timedelta(seconds=1)),
        ("equal", 0.1, on_bound),
        ("null", None, on_bound),
    )
    found = alerts.drift_violations(table, 0.1, 1, AS_OF).collect()
    assert [r["column_name"] for r in found] == ["kept"]


def test_columns_narrow_the_alert(spark):
    table = drift(spark, ("a", 0.2, dt.datetime(2024, 1, 31)), ("b", 0.3, dt.datetime(2024, 1, 31)))
    assert alerts.drift_violations(table, 0.1, 1, AS_OF, ["a"]).count() == 1


def test_further_measures_are_not_scores(spark):
    table = drift(spark, ("a", 0.5, dt.datetime(2024, 1, 31))).withColumn("metric_name", F.lit("psi"))
    assert alerts.above_threshold(table, 0.1).count() == 0


def test_top_list_breaks_ties_by_name(spark):
    end = dt.datetime(2024, 1, 31)
    table = drift(spark, ("b", 0.3, end), ("a", 0.3, end), ("c", 0.9, end), ("d", 0.01, end))
    assert [r["column_name"] for r in alerts.top_drift(table, 2).collect()] == ["c", "a"]


def test_quality_fires_below_and_drift_above(spark):
    rules = alerts.rules_table(
        spark, [AlertRule("prediction_drift", 0.1), AlertRule("data_quality_score", 0.8, "critical")]
    )
    end = dt.datetime(2024, 1, 31)
    metrics = spark.createDataFrame(
        [
            ("prediction_drift", "a", "baseline", 0.2, end),
            ("prediction_drift", "b", "baseline", 0.05, end),
            ("data_quality_score", None, None, 0.7, end),
            ("data_quality_score", None, None, 0.9, end),
        ],
        "metric string, column_name string, drift_type string, value double, window_end timestamp",
    )
    found = alerts.evaluate_rules(metrics, rules, 1, AS_OF)
    assert sorted(r["value"] for r in found.collect()) == [0.2, 0.7]
    summary = {r["metric"]: (r["severity"], r["n_violations"]) for r in alerts.alert_summary(found).collect()}
    assert summary == {"prediction_drift": ("warning", 1), "data_quality_score": ("critical", 1)}


def test_message_text(spark):
    end = dt.datetime(2024, 1, 31)
    violations = spark.createDataFrame(
        [("prediction_drift", "warning", 0.1, c, "baseline", v, end) for c, v in (("b", 0.25), ("a", 0.12345))],
        "metric string, severity string, threshold double, column_name string, drift_type string, value double, window_end timestamp",
    )
    found = alerts.alert_messages(violations, "dev", "main", "models").collect()
    assert len(found) == 1
    assert found[0]["subject"] == "[DEV] Prediction Drift Alert - 2 columns"
    assert found[0]["violation_lines"] == "  - a: 0.1235 (baseline)\n  - b: 0.2500 (baseline)"
    assert "Threshold 0.1\n" in found[0]["body"]


def test_many_violations_make_several_whole_parts(spark):
    violations = spark.range(950).select(
        F.lit("prediction_drift").alias("metric"),
        F.lit("warning").alias("severity"),
        F.lit(0.1).alias("threshold"),
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("column_name"),
        F.lit("baseline").alias("drift_type"),
        (F.col("id") / 10.0).alias("value"),
        F.lit(dt.datetime(2024, 1, 31)).alias("window_end"),
    )
    found = alerts.alert_messages(violations, "dev", part_size=100).collect()
    assert len(found) >= 10 and {r["n_violations"] for r in found} == {950}
    assert all(len(r["violation_lines"].split("\n")) <= 100 for r in found)
    assert sum(len(r["violation_lines"].split("\n")) for r in found) == 950


def test_unknown_metrics_warn(spark):
    rules = alerts.rules_table(spark, [AlertRule("prediction_drift", 0.1), AlertRule("other", 1.0)])
    assert [r["metric"] for r in alerts.unknown_metrics(rules).collect()] == ["other"]


def test_rows_without_a_window_are_current(spark):
    """A log that is silent for 672 hours against a rule of 24."""
    logs = spark.createDataFrame([("m1", dt.datetime(2024, 1, 3)), ("m2", dt.datetime(2024, 1, 31))], "model_id string, ts timestamp")
    ages = alerts.freshness_hours(logs, "ts", "2024-01-31 00:00:00", ["model_id"])
    metrics = alerts.metric_rows(ages, "data_freshness", "hours_old", None)
    rules = alerts.rules_table(spark, [AlertRule("data_freshness", 24.0)] * 20_000)
    found = alerts.evaluate_rules(metrics, rules.distinct(), 1, AS_OF).collect()
    assert [(r["model_id"], r["value"]) for r in found] == [("m1", 672.0)]


def test_equal_violations_are_all_written_in_bounded_parts(spark):
    violations = spark.range(5000).select(
        F.lit("prediction_drift").alias("metric"),
        F.lit("warning").alias("severity"),
        F.lit(0.1).alias("threshold"),
        F.lit("c").alias("column_name"),
        F.lit("baseline").alias("drift_type"),
        F.lit(0.5).alias("value"),
        F.lit(dt.datetime(2024, 1, 31)).alias("window_end"),
        F.when(F.col("id") < 4000, "m1").alias("model_id"),
    )
    found = alerts.alert_messages(violations, "dev", part_size=100).collect()
    sizes = [len(r["violation_lines"].split("\n")) for r in found]
    assert sum(sizes) == 5000 and max(sizes) <= 100 and len({r["part"] for r in found}) == len(found)
    assert {r["subject"] for r in found} == {"[DEV] Prediction Drift Alert - 1 columns"}
    assert sum(r["violation_lines"].count(" in m1") for r in found) == 4000


def test_report_looks_at_scores_only(spark):
    end = dt.datetime(2024, 1, 31)
    scores = drift(spark, ("a", 0.05, end), ("a", 0.02, end)).withColumn("metric_name", F.lit("drift_score"))
    further = scores.withColumns({"metric_name": F.lit("chi_square"), "drift_score": F.lit(9.0)})
    row = alerts.drift_report(scores.unionByName(further), 7, AS_OF).first()
    assert (row["n_records"], row["n_high"], row["max_score"]) == (2, 0, 0.05)


def versions(spark, *pairs):
    return spark.createDataFrame(list(pairs), "name string, version string")


def test_versions_compare_as_numbers(spark):
    table = versions(spark, *[("m", v) for v in ("1", "2", "9", "10", "3")])
    assert reg.latest_versions(table).first()["version"] == "10"
    assert [r["version"] for r in reg.list_versions(table, "m", 3).collect()] == ["10", "9", "3"]
    assert sorted(r["version"] for r in reg.top_versions(table, 2).collect()) == ["10", "9"]


def test_long_and_odd_versions(spark):
    table = versions(spark, ("m", "7"), ("m", "20240131120000"), ("m", "20240131120001"), ("long", "20240131120000"), ("odd", "x"), ("pad", "007"), ("m", "x"))
    found = {r["name"]: r["version"] for r in reg.latest_versions(table).collect()}
    assert found == {"m": "20240131120001", "long": "20240131120000", "odd": None, "pad": "007"}
    assert [r["version"] for r in reg.list_versions(table, "m", 2).collect()] == ["20240131120001", "20240131120000"]


def test_unknown_alias_and_model_give_null(spark):
    names = spark.createDataFrame([("m",), ("other",)], "name string")
    aliases = spark.createDataFrame([("m", "champion", "2")], "name string, alias string, version string")
    table = versions(spark, ("m", "2"), ("m", "3"))
    found = {r["name"]: r["version"] for r in reg.resolve_versions(names, table, aliases, "champion").collect()}
    assert found == {"m": "2", "other": None}
    latest = {r["name"]: r["version"] for r in reg.resolve_versions(names, table, aliases).collect()}
    assert latest == {"m": "3", "other": None}
    wanted = versions(spark, ("m", "9"), ("m", "3"))
    assert [r["version"] for r in reg.model_metadata(table, wanted).collect()] == ["3"]


def test_latest_run(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [
        ("a", "e", "FINISHED", True, at),
        ("b", "e", "FINISHED", False, at + dt.timedelta(1)),
        ("c", "e", "FAILED", True, at + dt.timedelta(2)),
    ]
    runs = spark.createDataFrame(rows, "run_id string, experiment string, status string, should_register boolean, start_time timestamp")
    assert reg.latest_run(runs).first()["run_id"] == "a"
    assert reg.latest_runs(runs).first()["run_id"] == "a"
    assert reg.latest_run(runs.where("run_id <> 'a'")).count() == 0


@pytest.mark.parametrize("n, status, valid", [(4, "passed", True), (3, "passed_with_warnings", True), (2, "failed", False)])
def test_scorecard(spark, n, status, valid):
    rows = [("m", c, i < n) for i, c in enumerate(reg.SCORECARD_CHECKS)]
    checks = spark.createDataFrame(rows, "name string, check_name string, passed boolean")
    found = reg.validation_scorecard(checks, ["name"]).first()
    assert (found["checks_passed"], found["status"], found["is_valid"]) == (n, status, valid)


def test_uris(spark):
    row = spark.range(1).select(
        scalars.model_uri(F.lit("a.b.c"), F.lit("3")).alias("v"),
        scalars.model_uri(F.lit("a.b.c"), F.lit("3"), F.lit("champion")).alias("a"),
        scalars.flat_name(F.lit("a.b.c")).alias("f"),
        scalars.full_name("a", "b", "c").alias("n"),
    ).first()
    assert tuple(row) == ("models:/a.b.c/3", "models:/a.b.c@champion", "a_b_c", "a.b.c")
    with pytest.raises(ValueError):
        scalars.model_uri(F.lit("m"))
