import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import performance as perf


def scored(spark, rows):
    return spark.createDataFrame(rows, "y int, p int, s double")


def test_metrics_by_hand(spark):
    rows = [(1, 1, 0.9)] * 3 + [(0, 1, 0.8)] + [(1, 0, 0.2)] * 2 + [(0, 0, 0.1)] * 4 + [(None, 1, 0.5)]
    found = perf.binary_metrics(scored(spark, rows), "y", "p").first()
    assert found["n"] == 10
    assert found["accuracy"] == pytest.approx(0.7)
    assert found["precision"] == pytest.approx(0.75)
    assert found["recall"] == pytest.approx(0.6)
    assert found["f1"] == pytest.approx(2 / 3)


def test_zero_denominators_give_zero(spark):
    found = perf.binary_metrics(scored(spark, [(0, 0, 0.1), (0, 0, 0.2)]), "y", "p", score="s").first()
    assert (found["precision"], found["recall"], found["f1"]) == (0.0, 0.0, 0.0)
    assert found["roc_auc"] is None


@pytest.mark.parametrize("seed", [0, 1])
def test_auc_equals_pair_counting(spark, seed):
    rng = np.random.default_rng(seed)
    y, s = rng.integers(0, 2, 300), np.round(rng.random(300), 2)
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    df = scored(spark, [(int(a), 0, float(b)) for a, b in zip(y, s)])
    for edges in (None, {"score": []}, {"score": [0.2, 0.9]}):
        got = perf.roc_auc(df.repartition(5), "y", "s", edges=edges).first()["roc_auc"]
        assert got == pytest.approx(np.mean(pairs))


def test_regression_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 1.0), (5.0, 5.0)], "y double, p double")
    found = perf.regression_metrics(df, "y", "p").first()
    assert found["mae"] == pytest.approx(2 / 3)
    assert found["rmse"] == pytest.approx((2 / 3) ** 0.5)
    assert found["mape"] == pytest.approx(0.5)
    assert found["r2"] == pytest.approx(1 - 2 / 14)


def test_constant_labels_have_no_r2(spark):
    df = spark.createDataFrame([(3.0, 2.0), (3.0, 4.0)], "y double, p double")
    assert perf.regression_metrics(df, "y", "p").first()["r2"] is None


@pytest.mark.parametrize("f1, promoted", [(0.85, True), (0.70, False), (0.75, False), (None, False)])
def test_promotion_is_strict(spark, f1, promoted):
    df = spark.createDataFrame([(f1,)], "f1 double")
    assert perf.promotion_gate(df, "f1", 0.75).first()["should_register"] is promoted


def test_improvement_percent_of_zero_baseline(spark):
    df = spark.createDataFrame([(0.5,)], "f1 double")
    assert perf.promotion_gate(df, "f1", 0.0).first()["improvement_percent"] == 0.0


def test_multiclass_counts_classes_of_both_sides(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "c")], "y string, p string")
    found = {r["class"]: r for r in perf.class_metrics(df, "y", "p").collect()}
    assert found["a"]["precision"] == 1.0 and found["a"]["recall"] == 0.5
    assert found["c"]["support"] == 0 and found["c"]["recall"] == 0.0
    averages = perf.averaged_class_metrics(df, "y", "p").first()
    assert averages["accuracy"] == pytest.approx(1 / 3)


def test_metrics_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).select(
        (F.col("id") % 2).cast("int").alias("y"),
        (F.col("id") % 3 == 0).cast("int").alias("p"),
        (F.col("id") % 17).cast("double").alias("s"),
    )
    rows = {perf.binary_metrics(df.repartition(n), "y", "p", score="s").first() for n in (1, 3, 11)}
    assert len(rows) == 1
