"""Writing tables, the version ledger, metric tables and retention."""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions.columns import quoted, text

# Fixed value: how a null stands in a partition's path.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

LEDGER_SCHEMA = (
    "table_name string, version long, row_count long, context string, recorded_at timestamp"
)

# What a dataset can be recorded as.
CONTEXTS = ("training", "validation", "inference")


def append_ledger(
    spark: SparkSession, ledger: str, table_name: str, row_count: int | None, context: str = "training"
) -> str:
    """Record a new version of a table and return it.

    The data is written before its ledger row, so a reader who trusts the ledger never
    sees a version without data. One writer per table is assumed.
    """
    if context not in CONTEXTS:
        raise ValueError(f"Unknown dataset context: {context}")
    recorded, version = stored_table(spark, ledger), 1
    if recorded is not None:
        newest = recorded.where(F.col("table_name") == table_name).agg(F.max("version")).first()[0]
        version = (newest or 0) + 1
    row = spark.range(1).select(
        F.lit(table_name).alias("table_name"),
        F.lit(version).cast("long").alias("version"),
        F.lit(row_count).cast("long").alias("row_count"),
        F.lit(context).alias("context"),
        F.current_timestamp().alias("recorded_at"),
    )
    _write(row, ledger, "append")
    return str(version)


def save_table(
    df: DataFrame, name: str, ledger: str, mode: str = "overwrite", context: str = "training"
) -> str:
    """Write a table and return its new version; the row count comes from the written files."""
    spark = df.sparkSession
    _write(df, name, mode)
    return append_ledger(spark, ledger, name, stored_table(spark, name).count(), context)


def _write(df: DataFrame, name: str, mode: str) -> None:
    """To a catalog table, or to a Parquet path when the name holds a slash."""
    if "/" in name:
        df.write.mode(mode).parquet(name)
    else:
        df.write.mode(mode).saveAsTable(name)


def stored_table(spark: SparkSession, name: str) -> DataFrame | None:
    """A catalog table, or a Parquet path when the name holds a slash; None where there is none yet."""
    if "/" not in name:
        return spark.table(name) if spark.catalog.tableExists(name) else None
    try:
        return spark.read.parquet(name)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def dataset_versions(sized: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Ledger rows for tables given as ``(table_name, row_count, context)``, as a table query."""
    if previous is None:
        return sized.withColumn("version", F.lit(1).cast("long"))
    newest = previous.groupBy("table_name").agg(F.max("version").alias("_newest"))
    return sized.join(newest, "table_name", "left").select(
        *sized.columns, (F.coalesce("_newest", F.lit(0)) + 1).cast("long").alias("version")
    )


def data_facts(flagged: DataFrame, is_test: str, target: str, key: str | None = None) -> DataFrame:
    """Row counts of both parts from one pass, and the number of columns they offer.

    ``feature_count`` leaves out the target only; ``model_feature_count`` leaves out
    the key too.
    """
    columns = [c for c in flagged.columns if c != is_test]
    features = [c for c in columns if c != target]
    return flagged.agg(
        F.count(F.when(~F.col(is_test), True)).alias("train_count"),
        F.count(F.when(F.col(is_test), True)).alias("test_count"),
        F.count("*").alias("total_count"),
    ).select(
        "*",
        F.lit(len(columns) - 1).cast("long").alias("feature_count"),
        F.lit(len([c for c in features if c != key])).cast("long").alias("model_feature_count"),
    )


PARTITION_COLUMNS = ["granularity", "window_date"]


def save_metrics(metrics: DataFrame, name: str) -> None:
    """Store a metric table by granularity and window day, replacing only the days it holds.

    ``name`` is a catalog table, or a Parquet path when it holds a slash. Running a
    refresh again gives the same table. The rebalance hint gives each day a few
    well-sized files and splits a day that is much larger than the rest.
    """
    spark = metrics.sparkSession
    dated = metrics.withColumn("window_date", F.to_date("window_start"))
    ordered = dated.select(*[quoted(c) for c in dated.columns if c not in PARTITION_COLUMNS], *PARTITION_COLUMNS)
    balanced = ordered.hint("rebalance", *PARTITION_COLUMNS)
    if "/" in name:
        balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *PARTITION_COLUMNS
        ).parquet(name)
    elif not spark.catalog.tableExists(name):
        balanced.write.partitionBy(*PARTITION_COLUMNS).saveAsTable(name)
    else:
        balanced.select(*map(quoted, spark.table(name).columns)).write.option(
            "partitionOverwriteMode", "dynamic"
        ).insertInto(name, overwrite=True)


def read_metrics(
    spark: SparkSession,
    name: str,
    from_time: str | None = None,
    to_time: str | None = None,
) -> DataFrame | None:
    """Windows inside a time range, or None when the table has not been made yet.

    The day partition is filtered along with the window bounds, so only the days asked
    for are read.
    """
    stored = stored_table(spark, name)
    return None if stored is None else in_time_range(stored, from_time, to_time)


def in_time_range(metrics: DataFrame, from_time: str | None = None, to_time: str | None = None) -> DataFrame:
    dated = "window_date" in metrics.columns
    if from_time is not None:
        metrics = metrics.where(F.col("window_start") >= F.lit(from_time).cast("timestamp"))
        if dated:
            metrics = metrics.where(F.col("window_date") >= F.lit(from_time[:10]).cast("date"))
    if to_time is not None:
        metrics = metrics.where(F.col("window_end") <= F.lit(to_time).cast("timestamp"))
        if dated:
            metrics = metrics.where(F.col("window_date") <= F.lit(to_time[:10]).cast("date"))
    return metrics


def within_retention(
    log: DataFrame, timestamp_col: str, retention_days: int = 90, as_of: str | dt.date | None = None
) -> DataFrame:
    """Log rows that are kept: not older than ``as_of - retention_days`` (bound included)."""
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return log.where(F.col(timestamp_col) >= F.date_sub(day, retention_days))


def drop_expired_days(
    spark: SparkSession, name: str, day_column: str, retention_days: int = 90, as_of: dt.date | None = None
) -> list[str]:
    """Retention on a log partitioned by day, at any level: drop whole expired days, rewrite nothing.

    Only the list of partitions reaches the driver. Partitions without a day stay. A table
    that is not partitioned by the day column is an error.
    """
    cutoff = ((as_of or dt.date.today()) - dt.timedelta(days=retention_days)).isoformat()
    listed = [_partition_values(row[0]) for row in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    partitioned = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if day_column not in partitioned:
        raise ValueError(f"{name} is not partitioned by {day_column}")
    expired = [values for values in listed if values[day_column] is not None and values[day_column][:10] < cutoff]
    for values in expired:
        spec = ", ".join(f"{quoted(k)} = {'NULL' if v is None else text(v)}" for k, v in values.items())
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
    return sorted({values[day_column] for values in expired})


def _partition_values(listed: str) -> dict[str, str | None]:
    """The values in a partition's path, ``a=1/b=x%3Dy``."""
    pairs = (part.split("=", 1) for part in listed.split("/"))
    return {unquote(k): None if v == NULL_PARTITION else unquote(v) for k, v in pairs}


def save_feature_importance(importance: DataFrame, path: str) -> None:
    """Feature importance as CSV, greatest first, in one file: one row per feature."""
    importance.orderBy(F.desc("importance"), "feature").coalesce(1).write.mode("overwrite").csv(
        path, header=True
    )
