import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import distribution as di


def numbers(spark, groups):
    rows = [(g, None if x is None else float(x)) for g, xs in groups.items() for x in xs]
    return spark.createDataFrame(rows, "g string, v double")


@pytest.mark.parametrize("bins", [1, 2, 16])
def test_exact_quantiles_equal_numpy_for_any_binning(spark, bins):
    rng = np.random.default_rng(3)
    groups = {"a": np.round(rng.normal(0, 3, 501), 1), "b": rng.exponential(1, 40), "c": np.array([5.0])}
    df = numbers(spark, groups)
    edges = di.approx_edges(df, ["v"], bins)
    keys = ["g", "column_name"]
    counts = di.value_counts(di.numeric_long(df, ["g"], ["v"], edges), keys)
    probabilities = [0.0, 0.1, 0.5, 0.99, 1.0]
    found = di.exact_quantiles(counts, keys, probabilities).collect()
    got = {(r["g"], r["probability"]): r["quantile_value"] for r in found}
    assert got == {
        (g, p): pytest.approx(np.quantile(xs, p)) for g, xs in groups.items() for p in probabilities
    }


def test_nulls_and_nan_have_no_bin_and_no_rank(spark):
    df = numbers(spark, {"a": [1.0, None, float("nan"), 3.0], "b": [None]})
    keys = ["g", "column_name"]
    counts = di.value_counts(di.numeric_long(df, ["g"], ["v"], {"v": [2.0]}), keys)
    assert counts.where("bin IS NULL").agg(F.sum("n")).first()[0] == 3
    found = {r["g"]: r["quantile_value"] for r in di.exact_quantiles(counts, keys, [0.5]).collect()}
    assert found == {"a": 2.0, "b": None}


def test_bin_is_the_number_of_edges_at_or_below(spark):
    df = numbers(spark, {"a": [-5, 1, 1.5, 2, 9]})
    long = di.numeric_long(df, [], ["v"], {"v": [1.0, 2.0]})
    assert {r["value"]: r["bin"] for r in long.collect()} == {-5: 0, 1: 1, 1.5: 1, 2: 2, 9: 2}


def test_constant_column_has_one_edge(spark):
    df = numbers(spark, {"a": [4.0] * 10})
    assert di.approx_edges(df, ["v"], 8) == {"v": [4.0]}
    assert di.exact_edges(df, ["v"], 8) == {"v": [4.0]}


def test_edges_of_an_empty_table(spark):
    assert di.approx_edges(numbers(spark, {}), ["v"], 8) == {"v": []}


def test_histogram_has_bounds(spark):
    df = numbers(spark, {"a": [0, 1, 5]})
    found = {r["bin"]: (r["n"], r["lower"], r["upper"]) for r in di.histogram(df, [], ["v"], {"v": [1.0, 2.0]}).collect()}
    assert found == {0: (1, None, 1.0), 1: (1, 1.0, 2.0), 2: (1, 2.0, None)}


def test_running_totals(spark):
    rng = np.random.default_rng(0)
    values = rng.integers(0, 50, 400)
    df = numbers(spark, {"a": values})
    counts = di.value_counts(di.numeric_long(df, ["g"], ["v"], {"v": [10.0, 30.0]}), ["g", "column_name"])
    found = {r["value"]: r["before_n"] for r in di.running_totals(counts, ["g", "column_name"], ["n"]).collect()}
    assert found == {v: (values < v).sum() for v in set(values.tolist())}


def test_a_dominant_value_does_not_collapse_the_bins(spark):
    """99.9 % of the rows are 0: the other values still spread over the bins."""
    rows = spark.range(2_000_000).select(F.when(F.col("id") % 1000 == 0, F.col("id") * 1.0).otherwise(0.0).alias("x"))
    edges = di.approx_edges(rows, ["x"], 256)
    values = rows.distinct()
    bins = di.with_bins(values, ["x"], edges).groupBy("_bin_x").count().collect()
    assert max(r["count"] for r in bins) < 0.02 * values.count()


def test_few_values_make_few_edges(spark):
    rows = spark.range(10_000).select((F.col("id") % 5).cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    edges = di.approx_edges(rows, ["x", "none"], 64)
    assert set(edges["x"]) <= {0.0, 1.0, 2.0, 3.0, 4.0} and edges["none"] == []
