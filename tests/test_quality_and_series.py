import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import quality as dq
from tidegauge.operators import timeseries as ts


def days(spark, *offsets):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(start + dt.timedelta(days=d), float(d)) for d in offsets], "t timestamp, v double")


def test_row_rules_by_hand(spark):
    df = spark.createDataFrame([(None, "1"), (5.0, "x"), (50.0, None), (7.0, "2.5")], "v double, s string")
    rules = [
        dq.null_check("v", 0.3),
        dq.type_check("s", "double", 0.2),
        dq.range_check("v", 0, 10, 0.5),
        dq.outlier_check("v", (0, 10), 0.1),
    ]
    found = {r["rule"]: (r["checked"], r["failed"], r["passed"]) for r in dq.check_rows(df, rules).collect()}
    assert found == {
        "null_check": (4, 1, True),
        "type_check": (3, 1, False),
        "range_check": (3, 1, True),
        "outlier_check": (3, 1, False),
    }
    score = dq.quality_score(dq.check_rows(df, rules)).first()
    assert score["data_quality_score"] == pytest.approx((0.75 + 3 * (2 / 3)) / 4)
    assert score["n_passed"] == 2


def test_share_equal_to_the_limit_passes(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("v"))
    assert dq.check_rows(df, [dq.range_check("v", 1, 100, 0.05)]).first()["passed"]


def test_nothing_to_check_passes(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert dq.check_rows(df, [dq.range_check("v", 0, 1)]).first()["passed"]


def test_fences_of_the_baseline(spark):
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert dq.baseline_fences(df, "v", exact=True) == (-50.0, 150.0)


def test_cardinality_limits_and_unseen_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "c string")
    base = spark.createDataFrame([("a",), ("b",)], "c string")
    found = dq.cardinality_check(df, ["c"], {"c": (1, 3)}, base, 0.25).first()
    assert (found["distinct_count"], found["unseen_values"], found["checked"], found["failed"]) == (3, 1, 4, 1)
    assert found["passed"]
    assert not dq.cardinality_check(df, ["c"], {"c": (1, 2)}).first()["passed"]


def test_resample_fills_gaps(spark):
    found = ts.resample(days(spark, 0, 0, 3), "t", "daily", {"total": F.sum("v")}, fill=0.0).orderBy("period").collect()
    assert [(r["n"], r["total"]) for r in found] == [(2, 0.0), (0, 0.0), (0, 0.0), (1, 3.0)]


@pytest.mark.parametrize("frequency, n", [("hourly", 49), ("daily", 3), ("weekly", 1), ("monthly", 1)])
def test_frequencies(spark, frequency, n):
    assert ts.resample(days(spark, 0, 2), "t", frequency, {}).count() == n


def test_months_differ_in_length(spark):
    found = ts.resample(days(spark, 30, 90, 150), "t", "monthly", {}).orderBy("period").collect()
    assert [r["period"].month for r in found] == [1, 2, 3, 4, 5]


def test_unknown_frequency(spark):
    with pytest.raises(ValueError):
        ts.resample(days(spark, 0), "t", "yearly", {})


def test_empty_series(spark):
    assert ts.resample(days(spark), "t", "daily", {}).count() == 0


def test_lags_run_over_gaps(spark):
    regular = ts.resample(days(spark, 0, 1, 3), "t", "daily", {"v": F.sum("v")})
    found = ts.lag_features(regular, "period", "v", (1, 2)).orderBy("period").collect()
    assert [(r["v"], r["v_lag_1"], r["v_lag_2"]) for r in found] == [
        (0.0, None, None), (1.0, 0.0, None), (None, 1.0, 0.0), (3.0, None, 1.0),
    ]


def test_rolling_includes_the_current_period(spark):
    regular = ts.resample(days(spark, 0, 1, 2, 3), "t", "daily", {"v": F.sum("v")})
    found = ts.rolling_features(regular, "period", "v", (3,)).orderBy("period").collect()
    assert [r["v_avg_3"] for r in found] == [0.0, 0.5, 1.0, 2.0]


def test_temporal_consistency(spark):
    found = dq.temporal_consistency(days(spark, 0, 0, 1, 4), "t", "daily", max_failed=0.3).first()
    assert (found["checked"], found["failed"], found["duplicate_timestamps"], found["passed"]) == (5, 2, 1, False)


def test_seasonality(spark):
    weekly = spark.range(70).select(
        (F.lit("2024-01-01").cast("date") + F.col("id").cast("int")).cast("timestamp").alias("period"),
        (F.col("id") % 7).cast("double").alias("v"),
    )
    found = dq.seasonality_check(weekly, "period", "v", 7, 0.9).first()
    assert found["checked"] == 63 and found["autocorrelation"] == pytest.approx(1) and found["passed"]
    assert not dq.seasonality_check(weekly, "period", "v", 3, 0.9).first()["passed"]


def test_logging_frequency(spark):
    start = dt.datetime(2024, 1, 1)
    minutes = [0, 1, 1, 200, 201, 1000]
    log = spark.createDataFrame([(start + dt.timedelta(minutes=m),) for m in minutes], "t timestamp")
    found = ts.logging_frequency(log, "t", "hourly").first()
    assert (found["n_rows"], found["periods"], found["empty_periods"]) == (6, 17, 14)
    assert found["longest_gap_seconds"] == pytest.approx(799 * 60)
    assert ts.logging_frequency(log, "t", "daily").first()["longest_gap_seconds"] == pytest.approx(799 * 60)


def test_longest_silence_of_dense_and_sparse_logs(spark):
    """Against all neighbours: rows a few microseconds apart, in one second, hours apart, and repeated."""
    import random

    random.seed(8)
    base = 1_704_067_200_000_000
    micros = {
        "dense": [base + i * 7 + random.randint(0, 3) for i in range(5000)],
        "bursts": [base + s * 1_000_000 + random.randint(0, 400_000) for s in range(300) for _ in range(5)],
        "sparse": [base + random.randint(0, 10**11) for _ in range(50)],
        "same": [base] * 4,
    }
    rows = spark.createDataFrame([(k, t) for k, stamps in micros.items() for t in stamps], "s string, t long")
    rows = rows.select("s", F.timestamp_micros("t").alias("at"))
    found = {r["s"]: r for r in ts.logging_frequency(rows, "at", "hourly", ["s"]).collect()}
    for name, stamps in micros.items():
        ordered = sorted(stamps)
        longest = max(b - a for a, b in zip(ordered, ordered[1:])) / 1e6
        assert found[name]["n_rows"] == len(stamps) and abs(found[name]["longest_gap_seconds"] - longest) < 1e-9, name
    whole = ts.logging_frequency(rows, "at", "hourly").first()
    assert whole["n_rows"] == sum(map(len, micros.values()))


@pytest.mark.parametrize("rows", [[], [(None,), (None,)]])
def test_an_empty_baseline_is_an_error(spark, rows):
    """Bounds of nothing would pass every row."""
    baseline = spark.createDataFrame(rows, "value double")
    for bounds in (dq.baseline_range, dq.baseline_fences, lambda b, c: dq.baseline_fences(b, c, exact=True)):
        with pytest.raises(ValueError, match="empty baseline"):
            bounds(baseline, "value")


@pytest.mark.parametrize("frequency, step", [("hourly", "1 HOUR"), ("daily", "1 DAY"), ("weekly", "7 DAY"), ("monthly", "1 MONTH")])
def test_parts_of_a_series_give_what_the_whole_gives(spark, monkeypatch, frequency, step):
    monkeypatch.setattr(ts, "PART_PERIODS", 6)
    regular = spark.sql(
        f"SELECT s, t, CASE WHEN day(t) % 5 > 0 THEN 1.0 * (unix_seconds(CAST(t AS timestamp)) % 1009 + s) END AS v "
        f"FROM VALUES (1), (2) AS x(s) LATERAL VIEW explode(sequence(TIMESTAMP_NTZ'2023-12-30 00:00:00', TIMESTAMP_NTZ'2023-12-30 00:00:00' + 40 * INTERVAL {step})) AS t"
        if frequency != "monthly"
        else "SELECT s, t, 1.0 * month(t) * s AS v FROM VALUES (1), (2) AS x(s) LATERAL VIEW explode(sequence(TIMESTAMP_NTZ'2019-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:00:00', INTERVAL 1 MONTH)) AS t"
    )
    for features, reach in ((ts.lag_features, (1, 4, 9)), (ts.rolling_features, (2, 7))):
        ours = features(regular, "t", "v", reach, ["s"], frequency)
        whole = features(regular, "t", "v", reach, ["s"])
        assert ours.columns == whole.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, whole.collect()))


def test_one_series_is_not_one_task(spark):
    regular = spark.sql("SELECT timestampadd(HOUR, CAST(id AS int), TIMESTAMP_NTZ'2020-01-01 00:00:00') AS t, id AS v FROM range(50000)")
    for found in (ts.rolling_features(regular, "t", "v", frequency="hourly"), ts.lag_features(regular, "t", "v", frequency="hourly")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "SinglePartition" not in plan
    with pytest.raises(ValueError, match="Unknown frequency"):
        ts.lag_features(regular, "t", "v", frequency="yearly")
