"""What the plans must look like at any scale."""

import re

import pytest

from tidegauge.workloads import WORKLOADS

SF_DIR = "/root/testdata/sf0.001"


def executed(spark, name):
    df = WORKLOADS[name].run(spark, SF_DIR)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name, scans",
    [
        ("profile_lines_sketched", 1),
        ("profile_default", 1),
        ("profile_merged_granularities", 1),
        ("profile_numeric_daily", 2),
        ("drift_tv_daily", 2),
        ("drift_ks_daily", 2),
        ("drift_consecutive", 1),
        ("drift_ks_consecutive", 1),
        ("roc_auc", 1),
        ("window_classification_quality", 1),
        ("resample_daily", 1),
        ("logging_frequency", 1),
        ("dq_score", 1),
    ],
)
def test_every_table_is_read_once(spark, name, scans):
    plan = executed(spark, name)
    assert len(re.findall("FileScan parquet", plan)) == scans
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = executed(spark, "drift_tv_daily")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(ts", plan)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_sketched_profile_shuffles_once(spark):
    plan = executed(spark, "profile_lines_sketched")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
