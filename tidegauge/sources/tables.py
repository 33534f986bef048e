"""Reading training sources, feature tables and log tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.prepare import join_labels, select_features

# The rows served when no source is named.
SAMPLE_SCHEMA = "id long, age long, income long, target long"
SAMPLE_ROWS = [
    (1, 25, 50000, 1),
    (2, 35, 60000, 0),
    (3, 45, 70000, 1),
    (4, 22, 45000, 0),
    (5, 50, 80000, 1),
]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a Parquet path when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def sample_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SAMPLE_ROWS, SAMPLE_SCHEMA)


def read_feature_table(
    spark: SparkSession,
    feature_table: str,
    lookup_key: str,
    feature_columns: list[str] | None = None,
    label_table: str | None = None,
    label_column: str = "target",
) -> DataFrame:
    """Features by key, optionally only some columns, optionally with the label joined on."""
    features = select_features(read_table(spark, feature_table), lookup_key, feature_columns)
    if label_table is None:
        return features
    return join_labels(features, read_table(spark, label_table), lookup_key, label_column)


def check_source_choice(
    source_table: str | None, feature_table: str | None, lookup_key: str | None
) -> None:
    """One source at most, and a key for a feature table; raised before anything is scanned."""
    if source_table and feature_table:
        raise ValueError("Give a source table or a feature table, not both")
    if feature_table and not lookup_key:
        raise ValueError("A feature table needs a lookup key")


def load_training_source(
    spark: SparkSession,
    source_table: str | None = None,
    feature_table: str | None = None,
    lookup_key: str | None = None,
    feature_columns: list[str] | None = None,
    label_table: str | None = None,
    label_column: str = "target",
) -> DataFrame:
    check_source_choice(source_table, feature_table, lookup_key)
    if feature_table:
        return read_feature_table(
            spark, feature_table, lookup_key, feature_columns, label_table, label_column
        )
    return read_table(spark, source_table) if source_table else sample_rows(spark)


LOG_STATUS_SCHEMA = T.StructType(
    [
        T.StructField("table_exists", T.BooleanType(), False),
        T.StructField("has_data", T.BooleanType(), False),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("n_columns", T.IntegerType(), False),
        T.StructField("status", T.StringType(), False),
    ]
)


def log_status(log: DataFrame) -> DataFrame:
    """One row on a log that exists. An empty log is a warning, not a failure.

    The count reads no column: Parquet answers it from the file footers.
    """
    n_columns = len(log.columns)
    return log.agg(F.count("*").alias("n_rows")).select(
        F.lit(True).alias("table_exists"),
        (F.col("n_rows") > 0).alias("has_data"),
        "n_rows",
        F.lit(n_columns).alias("n_columns"),
        F.when(F.col("n_rows") > 0, "ok").otherwise("empty").alias("status"),
    )


def table_status(spark: SparkSession, name: str) -> DataFrame:
    """As ``log_status``, with a row of its own for a table that is not there."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([(False, False, 0, 0, "missing")], LOG_STATUS_SCHEMA)
    return log_status(spark.table(name))


def table_schema(df: DataFrame) -> DataFrame:
    """The schema as rows, one per column; bounded by the number of columns."""
    return df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema)],
        "position int, column_name string, data_type string, nullable boolean",
    )


def first_rows(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """A sample of ``n`` rows; ordered by key it is the same sample on every run."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
