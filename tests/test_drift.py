"""Drift measures against hand-computed cases and brute force."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import drift as dr
from tidegauge.spec import MonitorSpec

DAY1 = dt.datetime(2024, 1, 1, 12)
DAY2 = dt.datetime(2024, 1, 2, 12)
SPEC = MonitorSpec(timestamp_col="ts", prediction_col=None)


def log(spark, rows, kind="string"):
    return spark.createDataFrame(rows, f"ts timestamp, v {kind}")


def categories(spark, *values, at=DAY1):
    return log(spark, [(at, v) for v in values])


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_identical_distributions_do_not_drift(spark):
    rows = categories(spark, "a", "b", "b")
    found = one(dr.categorical_drift(rows, SPEC, ["v"], rows))
    assert found["total_variation"] == pytest.approx(0)
    assert found["psi"] == pytest.approx(0)
    assert found["jensen_shannon"] == pytest.approx(0, abs=1e-7)
    assert found["chi_square"] == pytest.approx(0)


def test_disjoint_distributions_drift_fully(spark):
    found = one(dr.categorical_drift(categories(spark, "a", "b"), SPEC, ["v"], categories(spark, "c")))
    assert found["total_variation"] == pytest.approx(1)
    assert found["jensen_shannon"] == pytest.approx(1)


def test_values_on_one_side_only_count(spark):
    # P = a 1/2, b 1/2; Q = b 1/4, c 3/4
    found = one(
        dr.categorical_drift(
            categories(spark, "b", "c", "c", "c"), SPEC, ["v"], categories(spark, "a", "b")
        )
    )
    assert found["total_variation"] == pytest.approx(0.75)
    floor = 1e-4
    psi = sum((q - p) * math.log(q / p) for p, q in ((0.5, floor), (0.5, 0.25), (floor, 0.75)))
    assert found["psi"] == pytest.approx(psi)
    # expected a 2, b 2: (0-2)^2/2 + (1-2)^2/2
    assert found["chi_square"] == pytest.approx(2.5)
    assert found["cramers_v"] == pytest.approx(math.sqrt(2.5 / 4))


@pytest.mark.parametrize("window, base", [([None, None], ["a"]), (["a"], []), (["a"], [None])])
def test_empty_side_gives_null(spark, window, base):
    rows, reference = categories(spark, *window), log(spark, [(DAY1, v) for v in base])
    found = one(dr.categorical_drift(rows, SPEC, ["v"], reference))
    assert found["total_variation"] is None and found["psi"] is None
    numbers = log(spark, [(DAY1, None if v is None else 1.0) for v in window], "double")
    other = log(spark, [(DAY1, None if v is None else 1.0) for v in base], "double")
    assert one(dr.exact_numeric_drift(numbers, SPEC, ["v"], other))["ks"] is None
    binned = one(dr.numeric_drift(numbers, SPEC, ["v"], other, bins=4))
    assert binned["ks"] is None and binned["psi"] is None


def test_empty_log_gives_no_rows(spark):
    assert dr.categorical_drift(log(spark, []), SPEC, ["v"], categories(spark, "a")).count() == 0


def brute_ks(a, b):
    points = np.union1d(a, b)
    return max(abs((a <= x).mean() - (b <= x).mean()) for x in points)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_ks_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = np.round(rng.normal(0, 1, 400), 1)
    days = {DAY1: np.round(rng.normal(0.3, 1, 300), 1), DAY2: rng.uniform(5, 9, 50)}
    rows = log(spark, [(d, float(x)) for d, xs in days.items() for x in xs], "double")
    reference = log(spark, [(DAY1, float(x)) for x in base], "double")
    found = dr.exact_numeric_drift(rows.repartition(7), SPEC, ["v"], reference).collect()
    got = {r["window_start"].date(): r["ks"] for r in found}
    assert got == {d.date(): pytest.approx(brute_ks(xs, base)) for d, xs in days.items()}


def test_binned_measures_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base, window = rng.normal(0, 1, 500), rng.normal(0.5, 2, 200)
    edges = [-1.0, -0.25, 0.5, 1.5]
    rows = log(spark, [(DAY1, float(x)) for x in window], "double")
    reference = log(spark, [(DAY1, float(x)) for x in base], "double")
    found = one(dr.numeric_drift(rows, SPEC, ["v"], reference, edges={"v": edges}))

    def shares(xs):
        return np.bincount(np.searchsorted(edges, xs, side="right"), minlength=5) / len(xs)

    p, q = shares(base), shares(window)
    gaps = np.abs(np.cumsum(p) - np.cumsum(q))
    assert found["ks"] == pytest.approx(gaps.max())
    assert found["wasserstein"] == pytest.approx((gaps[:3] * np.diff(edges)).sum())
    assert found["total_variation"] == pytest.approx(np.abs(p - q).sum() / 2)
    assert found["psi"] == pytest.approx(((q - p) * np.log(q / p)).sum())


def test_consecutive_compares_with_the_last_window_that_has_rows(spark):
    later = dt.datetime(2024, 1, 9)
    rows = log(spark, [(DAY1, "a"), (DAY2, "a"), (DAY2, "b"), (later, "b")])
    found = {r["window_start"].date(): r["total_variation"] for r in dr.categorical_drift(rows, SPEC, ["v"]).collect()}
    assert found == {DAY1.date(): None, DAY2.date(): pytest.approx(0.5), later.date(): pytest.approx(0.5)}


def test_seasonal_baseline_is_the_same_weekday(spark):
    monday, tuesday = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    base = log(spark, [(monday, "a"), (tuesday, "b")])
    rows = log(spark, [(monday + dt.timedelta(7), "a"), (tuesday + dt.timedelta(7), "a")])
    found = {
        r["window_start"].date().day: r["total_variation"]
        for r in dr.categorical_drift(rows, SPEC, ["v"], base, "seasonal").collect()
    }
    assert found == {8: pytest.approx(0), 9: pytest.approx(1)}


def test_unknown_type_and_missing_baseline_are_errors(spark):
    rows = categories(spark, "a")
    with pytest.raises(ValueError):
        dr.categorical_drift(rows, SPEC, ["v"], rows, "yearly")
    with pytest.raises(ValueError):
        dr.categorical_drift(rows, SPEC, ["v"], None, "baseline")


def test_drift_table_has_the_stored_shape(spark):
    rows = log(spark, [(DAY1, "a"), (DAY2, "b")]).withColumn("x", F.lit(1.0))
    found = dr.drift(rows, SPEC, ["x"], ["v"], rows, ("baseline", "consecutive"))
    assert found.columns == dr.DRIFT_COLUMNS
    assert [f.dataType for f in found.schema] == [f.dataType for f in dr.DRIFT_SCHEMA]
    assert found.count() == 8
    assert found.where("column_name = 'x' AND drift_type = 'baseline'").agg(F.max("drift_score")).first()[0] == 0


def test_hot_value_and_hot_window_do_not_change_the_result(spark):
    """A third of the rows in one window with one value: same answer as plain arithmetic."""
    hot = spark.range(60_000).select(F.lit(DAY1).alias("ts"), F.lit(7.0).alias("v"))
    rest = spark.range(120_000).select(
        F.expr("timestamp'2024-01-02 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id % 86400)").alias("ts"),
        (F.col("id") % 1000).cast("double").alias("v"),
    )
    rows = hot.unionByName(rest)
    found = {r["window_start"].day: r["ks"] for r in dr.exact_numeric_drift(rows, SPEC, ["v"], rest).collect()}
    # the baseline has 8 of 1000 values up to 7 and 7 of 1000 below it
    assert found[1] == pytest.approx(max(abs(1 - 0.008), 0.007))
    assert found[2] == pytest.approx(0)
