"""Run the named queries next to their SQL and compare rows, columns and values.

    python -m tests.crosscheck [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb
import pandas as pd

from tidegauge.session import build_session
from tidegauge.workloads import WORKLOADS


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in pathlib.Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if hasattr(value, "item"):
        value = value.item()
    # a nullable integer column arrives as floats on one side
    return int(value) if isinstance(value, float) and value.is_integer() else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)].astype(object)
    rows = [tuple(_plain(v) for v in row) for row in ordered.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v).__name__), str(v)) for v in r))


def difference(spark, connection, name: str, sf_dir: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    job = WORKLOADS[name]
    ours = job.run(spark, sf_dir).toPandas()
    if job.sql is None:
        return None if len(ours) else "no rows"
    theirs = connection.execute(job.sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    kinds = [(c, ours[c].dtype, theirs[c].dtype) for c in sorted(ours.columns)]
    a, b = rows_of(ours), rows_of(theirs)
    for mine, other in zip(a, b):
        if mine != other:
            return f"{mine} against {other} {kinds}"
    odd = [k for k in kinds if k[1] != k[2] and not str(k[1]).startswith("datetime")]
    if odd:
        return f"types {odd}"
    return None


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(WORKLOADS)
    spark = build_session(
        "crosscheck", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, connection, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")


if __name__ == "__main__":
    main()
