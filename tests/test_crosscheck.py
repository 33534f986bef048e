"""Every named query against its SQL on the smallest tables."""

import pytest

from tests.crosscheck import connect, difference
from tidegauge.workloads import WORKLOADS

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(WORKLOADS))
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) is None


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["column_name", "drift_score", "drift_type", "window_end"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
