import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from tidegauge.operators import profile as pr
from tidegauge.spec import MonitorSpec

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def log(spark):
    rows = [
        (START + dt.timedelta(minutes=7 * i), "m1" if i % 2 else "m2", None if i % 10 == 0 else float(i % 23), "abc"[i % 3])
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "ts timestamp, model string, x double, c string").cache()


def spec(**changes):
    return MonitorSpec(
        **{"timestamp_col": "ts", "numeric_cols": ("x",), "categorical_cols": ("c",), "prediction_col": None, **changes}
    )


def values(df):
    keys = ("granularity", "window_start", "model_id", "slice_key", "slice_value", "column_name", "metric_name")
    return {tuple(r[k] for k in keys): r["metric_value"] for r in df.collect()}


def test_shape_is_fixed(log):
    for exact in (False, True):
        found = pr.profile(log, spec(), exact)
        assert found.columns == pr.PROFILE_COLUMNS
        assert [f.dataType for f in found.schema] == [f.dataType for f in pr.PROFILE_SCHEMA]


def test_merged_granularities_equal_separate_ones(log):
    steps = ("30 minutes", "1 hour", "1 day")
    for exact in (False, True):
        together = values(pr.profile(log, spec(granularities=steps), exact))
        apart = {}
        for step in steps:
            apart |= values(pr.profile(log, spec(granularities=(step,)), exact))
        assert together.keys() == apart.keys()
        for key, value in apart.items():
            assert together[key] == (None if value is None else pytest.approx(value)), key


def test_granularities_that_do_not_nest(log):
    steps = ("2 hours", "3 hours")
    together = values(pr.profile(log, spec(granularities=steps)))
    assert {k[0] for k in together} == set(steps)


def test_merged_deviation_survives_a_large_mean(spark):
    rows = [(START + dt.timedelta(minutes=i), 1e9 + i % 5) for i in range(240)]
    df = spark.createDataFrame(rows, "ts timestamp, x double")
    wide = spec(granularities=("1 hour", "1 day"), categorical_cols=())
    found = values(pr.profile(df, wide))
    got = [v for k, v in found.items() if k[0] == "1 day" and k[-1] == "stddev"]
    assert got == [pytest.approx(statistics.stdev(x for _, x in rows), rel=1e-6)]


def test_slices_and_models_add_up(log):
    found = values(pr.profile(log, spec(model_id_col="model", slicing_exprs=("c = 'a'",)), True))
    counts = {k: v for k, v in found.items() if k[-1] == "count" and k[-2] == "x"}
    whole = sum(v for k, v in counts.items() if k[3] is None)
    assert whole == 600
    assert sum(v for k, v in counts.items() if k[4] == "true") == 200
    assert sum(v for k, v in counts.items() if k[3] is not None) == 600


def test_sketched_profile_equals_exact_one_on_small_windows(log):
    exact, sketched = (values(pr.profile(log, spec(), e)) for e in (True, False))
    for metric in ("distinct_count", "count", "num_nulls", "avg", "stddev", "min", "max", "num_zeros"):
        for key in [k for k in exact if k[-1] == metric]:
            assert sketched[key] == pytest.approx(exact[key])


def test_column_of_nulls(spark):
    df = spark.createDataFrame([(START, None, None), (START, None, None)], "ts timestamp, x double, c string")
    for exact in (False, True):
        found = values(pr.profile(df, spec(), exact))
        by_name = {(k[-2], k[-1]): v for k, v in found.items()}
        assert by_name[("x", "num_nulls")] == 2 and by_name[("x", "percent_null")] == 100
        assert by_name[("x", "avg")] is None and by_name[("x", "median")] is None
        assert by_name[("x", "distinct_count")] == 0 and by_name[("c", "distinct_count")] == 0


def test_column_of_nan_has_no_quantiles(spark):
    df = spark.createDataFrame([(START, float("nan"))], "ts timestamp, x double")
    for exact in (False, True):
        found = {(k[-2], k[-1]): v for k, v in values(pr.numeric_profile(df, spec(), ["x"], exact)).items()}
        assert found[("x", "median")] is None and found[("x", "count")] == 1


def test_most_frequent_tie_goes_to_the_smallest(spark):
    df = spark.createDataFrame([(START, "b"), (START, "a"), (START, None), (START, None), (START, None)], "ts timestamp, c string")
    found = pr.categorical_profile(df, spec(), ["c"], exact=True).where("metric_name = 'most_frequent'").first()
    assert (found["metric_text"], found["metric_value"]) == ("a", 1.0)


def test_rows_without_time_belong_to_no_window(spark):
    df = spark.createDataFrame([(None, 1.0), (START, 2.0)], "ts timestamp, x double")
    found = values(pr.profile(df, spec(categorical_cols=())))
    assert [v for k, v in found.items() if k[-1] == "count"] == [1.0]


def test_custom_metric_with_several_granularities(log):
    wide = spec(granularities=("1 hour", "1 day"))
    found = values(pr.profile(log, wide, custom={"spread": F.max("x") - F.min("x")}))
    day = [v for k, v in found.items() if k[0] == "1 day" and k[-1] == "spread"]
    assert max(day) == 22


def test_empty_log(log):
    assert pr.profile(log.limit(0), spec()).count() == 0
    assert pr.profile(log.limit(0), spec(), True).count() == 0


def test_nothing_to_profile(log):
    with pytest.raises(ValueError):
        pr.profile(log, spec(numeric_cols=(), categorical_cols=()))


def test_result_does_not_depend_on_partitioning(log):
    a, b = (values(pr.profile(log.repartition(n), spec(), True)) for n in (1, 9))
    assert a.keys() == b.keys() and all(b[k] == (None if v is None else pytest.approx(v)) for k, v in a.items())
