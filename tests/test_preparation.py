import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import prepare
from tidegauge.operators.split import split_train_test
from tidegauge.sinks import tables as sinks
from tidegauge.sources import inference_log as logs
from tidegauge.sources import tables as sources

TEN_ROWS = [(i, float(i), i * 10, (i - 1) % 2) for i in range(1, 11)]


@pytest.fixture
def ten(spark):
    return spark.createDataFrame(TEN_ROWS, "id long, feature1 double, feature2 long, target long")


def test_split_is_a_partition_and_keeps_columns(ten):
    train, test = split_train_test(ten, 0.2, 42, "id")
    assert train.columns == test.columns == ten.columns
    assert sorted(r["id"] for r in train.union(test).collect()) == list(range(1, 11))


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000)
    parts = [
        sorted(r["id"] for r in split_train_test(df.repartition(n), 0.2, 42, "id")[1].collect()) for n in (1, 7)
    ]
    assert parts[0] == parts[1]
    assert len(parts[0]) == pytest.approx(1000, abs=100)


def test_split_without_key_falls_back(ten):
    train, test = split_train_test(ten, 0.2, 42)
    assert train.count() + test.count() == 10


def test_split_of_an_empty_table(ten):
    train, test = split_train_test(ten.limit(0), 0.2, 42, "id")
    assert train.count() == test.count() == 0


@pytest.mark.parametrize("size", [-0.1, 0.0, 1.0, 1.5, 2.0])
def test_bad_test_size(ten, size):
    with pytest.raises(ValueError):
        split_train_test(ten, size, 42, "id")


def test_feature_columns(ten):
    assert prepare.feature_columns(ten, "target") == ["id", "feature1", "feature2"]
    assert prepare.feature_columns(ten, "target", ("id",)) == ["feature1", "feature2"]
    with pytest.raises(ValueError):
        prepare.feature_columns(ten, "nothing")


def test_source_choice():
    with pytest.raises(ValueError):
        sources.check_source_choice("a", "b", "k")
    with pytest.raises(ValueError):
        sources.check_source_choice(None, "b", None)
    sources.check_source_choice(None, "b", "k")


def test_sample_rows_when_no_source_is_named(spark):
    df = sources.load_training_source(spark)
    assert df.columns == ["id", "age", "income", "target"] and df.count() == 5


def test_feature_table_with_labels(spark, fresh_schema, ten):
    features, labels = f"{fresh_schema}.features", f"{fresh_schema}.labels"
    ten.drop("target").write.saveAsTable(features)
    ten.where("id <= 6").select("id", "target", F.lit("x").alias("noise")).write.saveAsTable(labels)
    df = sources.load_training_source(
        spark, feature_table=features, lookup_key="id", feature_columns=["feature2", "id"], label_table=labels
    )
    assert df.columns == ["id", "feature2", "target"] and df.count() == 6


def test_join_loss_is_not_hidden_by_repeated_labels(spark):
    features = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    labels = spark.createDataFrame([(1,), (1,), (1,), (None,)], "k long")
    found = prepare.join_loss(features, labels, "k").first()
    assert found["joined_count"] == features.join(labels, "k").count() == 3
    assert found["row_difference"] == 0
    assert found["unmatched_rows"] == 2 and found["warn"]
    assert found["duplicate_label_keys"] == 1


def test_join_loss_of_empty_tables(spark):
    empty = spark.createDataFrame([], "k long")
    assert prepare.join_loss(empty, empty, "k").first()["feature_count"] == 0


def test_null_keys_in_set_operations(spark):
    left = spark.createDataFrame([(1,), (None,), (2,), (2,)], "k long")
    right = spark.createDataFrame([(1,)], "k long")
    assert {r["k"] for r in prepare.missing_keys(left, right, "k").collect()} == {None, 2}
    assert prepare.rows_without_label(left, right, "k").count() == 3
    coverage = prepare.key_coverage(left, right, "k").first()
    assert (coverage["feature_keys"], coverage["keys_missing_labels"]) == (2, 1)


def test_versions_follow_the_ledger(spark, fresh_schema, ten):
    name, ledger = f"{fresh_schema}.train", f"{fresh_schema}.versions"
    assert sinks.save_table(ten, name, ledger) == "1"
    assert sinks.save_table(ten.where("id > 3"), name, ledger) == "2"
    rows = {r["version"]: r["row_count"] for r in spark.table(ledger).collect()}
    assert rows == {1: 10, 2: 7}
    assert spark.table(name).count() == 7
    with pytest.raises(ValueError):
        sinks.append_ledger(spark, ledger, name, 1, "something")


def test_retention_keeps_the_bound(spark):
    rows = [(dt.datetime(2024, 1, 1),), (dt.datetime(2023, 12, 31, 23, 59),)]
    log = spark.createDataFrame(rows, "ts timestamp")
    assert sinks.within_retention(log, "ts", 30, "2024-01-31").count() == 1


def test_expired_days_are_dropped_as_partitions(spark, fresh_schema):
    name = f"{fresh_schema}.log"
    rows = [(i, dt.date(2024, 1, i)) for i in range(1, 6)]
    spark.createDataFrame(rows, "id int, day date").write.partitionBy("day").saveAsTable(name)
    dropped = sinks.drop_expired_days(spark, name, "day", 2, dt.date(2024, 1, 5))
    assert dropped == ["2024-01-01", "2024-01-02"]
    assert spark.table(name).count() == 3


def test_table_status(spark, fresh_schema):
    assert sources.table_status(spark, f"{fresh_schema}.nothing").first()["status"] == "missing"
    spark.createDataFrame([], "a int").write.saveAsTable(f"{fresh_schema}.empty")
    found = sources.table_status(spark, f"{fresh_schema}.empty").first()
    assert (found["table_exists"], found["has_data"], found["status"]) == (True, False, "empty")


def test_bad_json_is_kept_and_marked(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "{broken"), (3, None)], "id int, body string")
    found = {r["id"]: (r["k"], r["body_unparsed"]) for r in logs.unpack_payload(df, "body", "k long").collect()}
    assert found == {1: (5, False), 2: (None, True), 3: (None, False)}


def test_records_pair_with_predictions(spark):
    rows = [
        (1, '{"dataframe_records": [{"x": 1.5}, {"x": 2.5}]}', '{"predictions": [0.1, 0.2]}'),
        (2, "oops", None),
    ]
    log = spark.createDataFrame(rows, "request_id int, request string, response string")
    found = logs.unpack_records(log, "x double").collect()
    assert sorted((r["request_id"], r["x"], r["prediction"]) for r in found if r["x"]) == [
        (1, 1.5, 0.1),
        (1, 2.5, 0.2),
    ]
    assert [r["request_unparsed"] for r in found if r["request_id"] == 2] == [True]


def test_late_labels_do_not_multiply_rows(spark):
    log = spark.createDataFrame([(1,), (2,)], "request_id long")
    labels = spark.createDataFrame(
        [(1, 0, dt.datetime(2024, 1, 1)), (1, 1, dt.datetime(2024, 1, 2))], "request_id long, label int, at timestamp"
    )
    found = {r["request_id"]: r["label"] for r in logs.attach_labels(log, labels, "request_id", "label", "at").collect()}
    assert found == {1: 1, 2: None}


def test_feature_importance_csv(spark, tmp_path):
    df = spark.createDataFrame([("b", 0.1), ("a", 0.9)], "feature string, importance double")
    sinks.save_feature_importance(df, str(tmp_path / "out"))
    assert [r["feature"] for r in spark.read.csv(str(tmp_path / "out"), header=True).collect()] == ["a", "b"]


def test_expired_days_at_any_level(spark, fresh_schema):
    """The day behind or before another level, with values that need quoting, and rows without a day."""
    rows = [(i, dt.date(2024, 1, i), g) for i in range(1, 6) for g in ("1 day", "it's 5/6=x")] + [(9, None, "1 day"), (9, dt.date(2024, 1, 1), None)]
    data = spark.createDataFrame(rows, "id int, day date, granularity string")
    for order in (["granularity", "day"], ["day", "granularity"]):
        name = f"{fresh_schema}.log_{order[0]}"
        data.write.partitionBy(*order).saveAsTable(name)
        assert sinks.drop_expired_days(spark, name, "day", 2, dt.date(2024, 1, 5)) == ["2024-01-01", "2024-01-02"]
        assert spark.table(name).count() == 7
    data.write.partitionBy("granularity").saveAsTable(f"{fresh_schema}.other")
    with pytest.raises(ValueError):
        sinks.drop_expired_days(spark, f"{fresh_schema}.other", "day", 2, dt.date(2024, 1, 5))
