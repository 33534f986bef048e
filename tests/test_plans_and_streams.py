import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import scoring
from tidegauge.operators.distribution import category_long, value_counts
from tidegauge.plans import monitoring, training
from tidegauge.session import scratch_dir
from tidegauge.sinks.tables import read_metrics
from tidegauge.spec import AlertRule, MonitorSpec
from tidegauge.streaming import log_streams as streams

START = dt.datetime(2024, 1, 1)
SPEC = MonitorSpec(
    timestamp_col="ts", prediction_col="c", numeric_cols=("x",), categorical_cols=("c",), granularities=("12 hours", "1 day")
)


def event_rows(n_days=4, per_day=40):
    return [
        (d * per_day + i, START + dt.timedelta(days=d, minutes=36 * i), float(i % 9 + d), "abc"[i % (2 + (d > 1))])
        for d in range(n_days)
        for i in range(per_day)
    ]


@pytest.fixture
def log(spark):
    return spark.createDataFrame(event_rows(), "id long, ts timestamp, x double, c string")


def stored(spark, name):
    """All rows; sums may differ in their last digits with the order of their terms."""
    return sorted(str([round(v, 9) + 0.0 if isinstance(v, float) else v for v in row]) for row in spark.table(name).collect())


@pytest.mark.parametrize("with_baseline", [True, False])
def test_refresh_twice_and_in_part_is_the_same(spark, fresh_schema, log, with_baseline):
    profile, drift = f"{fresh_schema}.profile_metrics", f"{fresh_schema}.drift_metrics"
    baseline = log.where(F.col("ts") < F.lit(START + dt.timedelta(days=1))) if with_baseline else None
    monitoring.refresh(log, SPEC, profile, drift, baseline, exact=True)
    first = stored(spark, profile), stored(spark, drift)
    monitoring.refresh(log, SPEC, profile, drift, baseline, since="2024-01-03 05:00:00", exact=True)
    assert (stored(spark, profile), stored(spark, drift)) == first


@pytest.mark.parametrize("granularities", [("1 hour",), ("5 hours",), ("1 hour", "5 hours", "1 day")])
@pytest.mark.parametrize("since", ["2024-01-02 12:00:00", "2024-01-02"])
def test_partial_refresh_keeps_every_window(spark, fresh_schema, log, granularities, since):
    from dataclasses import replace

    spec = replace(SPEC, granularities=granularities)
    profile, drift = f"{fresh_schema}.profile_metrics", f"{fresh_schema}.drift_metrics"
    baseline = log.where(F.col("ts") < F.lit(START + dt.timedelta(days=1)))
    monitoring.refresh(log, spec, profile, drift, baseline, exact=True)
    first = stored(spark, profile), stored(spark, drift)
    monitoring.refresh(log, spec, profile, drift, baseline, since=since, exact=True)
    assert (stored(spark, profile), stored(spark, drift)) == first


def test_partial_refresh_in_another_time_zone(spark, fresh_schema, log):
    from dataclasses import replace

    spec = replace(SPEC, granularities=("1 hour", "1 day"))
    profile, drift = f"{fresh_schema}.profile_metrics", f"{fresh_schema}.drift_metrics"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        monitoring.refresh(log, spec, profile, drift, exact=True)
        first = spark.table(profile).count(), spark.table(drift).count()
        monitoring.refresh(log, spec, profile, drift, since="2024-01-02", exact=True)
        assert (spark.table(profile).count(), spark.table(drift).count()) == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_labelled_logs_store_quality(spark, fresh_schema, log):
    labelled = log.withColumns({"y": (F.col("x") > 4).cast("int"), "p": (F.col("x") > 5).cast("int")})
    spec = MonitorSpec(timestamp_col="ts", prediction_col="p", label_col="y", score_col="x", numeric_cols=("x",), categorical_cols=("c",))
    profile = f"{fresh_schema}.profile_metrics"
    monitoring.refresh(labelled, spec, profile, f"{fresh_schema}.drift_metrics")
    found = spark.table(profile).where("column_name = ':table'").collect()
    assert {"accuracy", "precision", "recall", "f1", "roc_auc", "labelled_rows"} <= {r["metric_name"] for r in found}
    assert {r["metric_value"] for r in found if r["metric_name"] == "roc_auc"} == {1.0}
    status = {r["kind"]: r for r in monitoring.monitor_status(spark, profile, f"{fresh_schema}.nothing").collect()}
    assert status["profile"]["status"] == "active" and status["drift"]["status"] == "missing"


def test_ages_fire_through_the_plan(spark, fresh_schema):
    from tidegauge.operators.alerts import metric_rows

    ages = spark.createDataFrame([(672.0,)], "hours_old double")
    sent = monitoring.send_alerts(
        spark, f"{fresh_schema}.nothing", [AlertRule("data_freshness", 24.0)], "dev", as_of="2024-01-31",
        other_metrics=metric_rows(ages, "data_freshness", "hours_old", None),
    )
    assert sent["violations"].count() == 1


def test_reports_and_alerts_from_stored_tables(spark, fresh_schema, log):
    drift = f"{fresh_schema}.drift_metrics"
    baseline = log.where(F.col("ts") < F.lit(START + dt.timedelta(days=1)))
    monitoring.refresh(log, SPEC, f"{fresh_schema}.profile_metrics", drift, baseline)
    report = monitoring.analyze_drift(spark, drift, 7, "2024-01-05")
    assert report["records"].count() == 2 * (4 + 8)
    assert report["top"].count() == 10 or report["top"].count() > 0
    rules = [AlertRule("prediction_drift", 0.1), AlertRule("unheard_of", 1.0)]
    sent = monitoring.send_alerts(spark, drift, rules, "dev", "main", "models", "2024-01-05")
    assert sent["violations"].count() > 0
    assert sent["messages"].first()["subject"].startswith("[DEV] Prediction Drift Alert - ")
    assert sent["warnings"].count() == 1


def test_missing_metric_table_is_not_an_error(spark, fresh_schema):
    assert monitoring.analyze_drift(spark, f"{fresh_schema}.nothing") is None
    assert monitoring.send_alerts(spark, f"{fresh_schema}.nothing", [], "dev") is None


def test_metrics_of_a_time_range(spark, fresh_schema, log):
    profile = f"{fresh_schema}.profile_metrics"
    monitoring.refresh(log, SPEC, profile, f"{fresh_schema}.drift_metrics")
    found = read_metrics(spark, profile, "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert {r["window_start"].day for r in found.collect()} == {2}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "window_date" in plan.split("PartitionFilters: ")[1][:300]


def test_quality_per_window(spark, log):
    labelled = log.withColumn("y", F.col("x") + 1)
    spec = MonitorSpec(problem_type="regression", timestamp_col="ts", prediction_col="x", label_col="y")
    assert {r["mae"] for r in monitoring.quality_per_window(labelled, spec).collect()} == {1.0}
    with pytest.raises(ValueError):
        monitoring.quality_per_window(log, MonitorSpec(timestamp_col="ts"))


@pytest.fixture(scope="module")
def training_rows(spark):
    return spark.range(400).select(
        "id",
        (F.col("id") % 20).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 20 >= 10).cast("int").alias("target"),
    )


def test_training_from_source_to_verdict(spark, fresh_schema, training_rows):
    source, ledger = f"{fresh_schema}.source", f"{fresh_schema}.versions"
    train_name, test_name = f"{fresh_schema}.train", f"{fresh_schema}.test"
    training_rows.write.saveAsTable(source)
    facts = training.prepare_training_data(
        spark, train_name, test_name, ledger, "id", "target", source_table=source
    ).first()
    assert facts["total_count"] == 400 and facts["train_count"] + facts["test_count"] == 400
    assert (facts["feature_count"], facts["model_feature_count"]) == (3, 2)
    train, test = spark.table(train_name), spark.table(test_name)
    model, gate, importance = training.train_candidate(
        train, test, "target", 0.5, {"n_estimators": 3, "max_depth": 2}, exclude=("id",)
    )
    row = gate.first()
    assert row["f1"] == 1.0 and row["roc_auc"] == 1.0 and row["should_register"]
    assert [r["feature"] for r in importance.collect()] == ["a", "b"]
    metadata = spark.createDataFrame([("m", "1")], "name string, version string")
    verdict = training.validate_candidate(model, test, "a double, b double", metadata).first()
    assert (verdict["checks_passed"], verdict["status"]) == (4, "passed")
    worse = training.validate_candidate(model, test, "a double, z double", metadata).first()
    assert worse["status"] == "passed_with_warnings"
    nothing = training.validate_candidate(None, test, "a double", metadata.limit(0)).first()
    assert nothing["status"] == "failed"


def test_input_contract(spark):
    df = spark.createDataFrame([], "a int, b string, c double")
    found = {r["column_name"]: r["problem"] for r in scoring.input_contract(df, "a int, b double, d int").collect()}
    assert found == {"b": "type", "c": "unexpected", "d": "missing"}


class Doubler:
    def predict(self, features):
        return features["a"] * 2


def test_scoring_with_any_object(spark, training_rows):
    scored = scoring.score_with(training_rows, Doubler, ["a"])
    assert scored.where("prediction <> a * 2").count() == 0
    assert scoring.scoring_check(scored).first()["passed"]
    assert not scoring.scoring_check(scored.limit(0)).first()["passed"]


def write_batches(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "id long, ts timestamp, x double, c string").coalesce(1).write.parquet(f"{folder}/b{i}")


def stream_of(spark, folder, pattern="b*"):
    schema = spark.createDataFrame([], "id long, ts timestamp, x double, c string").schema
    return streams.read_log_stream(spark, f"{folder}/{pattern}", schema, "ts", maxFilesPerTrigger="1")


def test_stream_drops_late_rows_and_keeps_open_windows_open(spark):
    folder = scratch_dir(spark, "late")
    rows = event_rows(4)
    late = [(999, START + dt.timedelta(hours=1), 5.0, "a")]
    write_batches(spark, folder, [rows])
    spec = MonitorSpec(timestamp_col="ts", prediction_col=None)

    def run(pattern):
        profile = streams.stream_profile(stream_of(spark, folder, pattern), spec, ["x"], "1 hour")
        streams.run_available(profile, f"{folder}/out", f"{folder}/checkpoint")
        return {r["window_start"].day: r["n_rows"] for r in spark.read.parquet(f"{folder}/out").collect()}

    assert run("b*") == {1: 40, 2: 40, 3: 40}
    spark.createDataFrame(late, "id long, ts timestamp, x double, c string").coalesce(1).write.parquet(f"{folder}/b9")
    assert run("b*") == {1: 40, 2: 40, 3: 40}


def test_stream_keeps_one_row_per_request(spark):
    folder = scratch_dir(spark, "twice")
    rows = event_rows(1)
    write_batches(spark, folder, [rows, rows, rows[:3]])
    unique = streams.stream_unique_requests(stream_of(spark, folder), "id", "ts", "1 day")
    streams.run_available(unique, f"{folder}/out", f"{folder}/checkpoint")
    assert spark.read.parquet(f"{folder}/out").count() == 40


def test_stream_drift_equals_batch_and_survives_a_replay(spark, log):
    from tidegauge.operators.drift import categorical_drift

    folder = scratch_dir(spark, "drift")
    rows = event_rows(4)
    write_batches(spark, folder, [rows[:50], rows[50:120], rows[120:]])
    spec = MonitorSpec(timestamp_col="ts", prediction_col=None)
    base = log.where(F.col("ts") < F.lit(START + dt.timedelta(days=1)))
    counts = value_counts(category_long(base, [], ["c"]), ["column_name"])
    store = streams.drift_sink(counts, f"{folder}/out")
    seen = []

    def twice(batch, batch_id):
        store(batch, batch_id)
        store(batch, batch_id)
        seen.append(batch_id)

    streams.run_available_batches(
        streams.stream_value_counts(stream_of(spark, folder), spec, ["c"], "1 hour"), twice, f"{folder}/checkpoint"
    )
    got = {r["window_start"].day: r["total_variation"] for r in spark.read.parquet(f"{folder}/out").collect()}
    expected = {
        r["window_start"].day: r["total_variation"] for r in categorical_drift(log, spec, ["c"], base).collect()
    }
    assert len(seen) > 1
    assert got == {d: pytest.approx(v) for d, v in expected.items() if d < 4}


def test_a_rule_that_never_fires_leaves_an_empty_table(spark):
    from tidegauge.operators.alerts import rules_table
    from tidegauge.spec import AlertRule

    folder = scratch_dir(spark, "quiet")
    rows = event_rows(3)
    write_batches(spark, folder, [rows])
    spec = MonitorSpec(timestamp_col="ts", prediction_col=None)
    base = value_counts(category_long(spark.read.parquet(f"{folder}/b0"), [], ["c"]), ["column_name"])
    rules = rules_table(spark, [AlertRule("prediction_drift", 1.0, "critical")])
    store = streams.drift_sink(base, f"{folder}/out", spec, rules, f"{folder}/alerts")
    counts = streams.stream_value_counts(stream_of(spark, folder), spec, ["c"], "1 hour")
    streams.run_available_batches(counts, store, f"{folder}/checkpoint")
    found = spark.read.parquet(f"{folder}/alerts")
    assert spark.read.parquet(f"{folder}/out").count() > 0
    assert found.count() == 0 and {"severity", "column_name", "window_end", "value"} <= set(found.columns)


def test_scratch_folder_needs_a_shared_place_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        scratch_dir(Session(), "x")


def test_trees_are_built_from_one_row_for_rows_alike_in_all_bins(spark, training_rows, monkeypatch):
    seen, fit = [], scoring.GBTClassifier._fit
    monkeypatch.setattr(scoring.GBTClassifier, "_fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    rows = training_rows.union(training_rows.withColumn("id", F.col("id") + 1000)).withColumn("odd", F.col("id") % 2 == 1)
    model = scoring.fit_classifier(rows, "target", {"n_estimators": 3, "max_depth": 3}, exclude=("id",))
    scored = scoring.score(rows, model)
    assert seen == [rows.select("a", "b", "odd", "target").distinct().count()] and seen[0] < rows.count()
    assert scored.columns == [*rows.columns, "probability", "prediction"]
    assert scored.where("prediction <> target").isEmpty()
    importance = {r["feature"]: r["importance"] for r in scoring.feature_importance(model, spark).collect()}
    assert set(importance) == {"a", "b", "odd"} and importance["a"] > 0.9


def test_cuts_lie_between_values_and_keep_rare_ones_apart(spark):
    from tidegauge.operators.distribution import even_cuts

    rows = spark.range(100_000).selectExpr("id % 50 + 1 AS many", "CAST(id = 77 AS int) AS rare", "CAST(NULL AS double) AS none")
    cuts = even_cuts(rows, ["many", "rare", "none"], 32)
    assert len(cuts["many"]) == 31 and 25.5 in cuts["many"] and all(x % 1 == 0.5 for x in cuts["many"])
    assert cuts["rare"] == [0.5] and cuts["none"] == []
