"""The given tables in their monitoring roles, as DataFrames and as SQL for the cross-check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.spec import MonitorSpec

AS_OF = "2024-01-31"
BASELINE_END = "2024-01-08"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inference_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as an inference log of three models."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model_id"),
        F.col("event_type").alias("prediction"),
        "event_type",
        "value",
        F.col("props").alias("request"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.col("value").alias("execution_duration_ms"),
    )


LOG = """log AS (
  SELECT event_id AS request_id, ts AS timestamp, 'm' || (user_id % 3)::VARCHAR AS model_id,
         event_type AS prediction, event_type, value, props AS request,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status_code,
         value AS execution_duration_ms
  FROM events)"""


def before_baseline_end() -> Column:
    return F.col("timestamp") < F.lit(BASELINE_END).cast("timestamp_ntz")


def baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference_log(spark, sf_dir).where(before_baseline_end())


def monitored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inference_log(spark, sf_dir).where(~before_baseline_end())


BASE = f"""{LOG},
base AS (SELECT * FROM log WHERE timestamp < TIMESTAMP '{BASELINE_END}'),
live AS (SELECT * FROM log WHERE timestamp >= TIMESTAMP '{BASELINE_END}')"""


def log_spec(**changes) -> MonitorSpec:
    return MonitorSpec(**{"numeric_cols": ("value",), "categorical_cols": ("event_type",), **changes})


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label; the length says how likely good quality is."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        "*", (F.col("n_chars") >= 1000).cast("int").alias("prediction"), F.col("n_chars").alias("score")
    )


SCORED = """scored AS (
  SELECT doc_id, lang, source, n_chars, quality,
         (n_chars >= 1000)::INTEGER AS prediction, n_chars::DOUBLE AS score
  FROM documents JOIN labels USING (doc_id))"""


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with a list-price forecast of what they cost."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_linestatus"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_linestatus").alias("model_id"),
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("prediction"),
    )


PRICED = """priced AS (
  SELECT l_shipdate AS timestamp, l_linestatus AS model_id, l_extendedprice AS label,
         l_quantity * p_retailprice AS prediction
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def classified_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a log of return forecasts by two models."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_linestatus").alias("model_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") > 25).cast("int").alias("prediction"),
        F.col("l_extendedprice").alias("score"),
    )


CLASSIFIED = """classified AS (
  SELECT l_shipdate AS timestamp, l_linestatus AS model_id, (l_returnflag = 'R')::INTEGER AS label,
         (l_quantity > 25)::INTEGER AS prediction, l_extendedprice AS score
  FROM lineitem)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as training runs, one experiment per user."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.concat(F.lit("exp"), F.col("user_id").cast("string")).alias("experiment"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("status"),
        (F.col("value") > 20).alias("should_register"),
        F.col("ts").alias("start_time"),
        F.create_map(F.lit("test_f1"), F.col("value") / 500).alias("metrics"),
    )


RUNS = """runs AS (
  SELECT event_id::VARCHAR AS run_id, 'exp' || user_id::VARCHAR AS experiment,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'FINISHED' END AS status,
         value > 20 AS should_register, ts AS start_time, value / 500 AS test_f1
  FROM events)"""


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as registered versions, one model per customer; versions are numeric strings."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("main.models.c"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.col("o_orderpriority").alias("description"),
        F.col("o_orderdate").alias("created_at"),
        (F.col("o_totalprice") / 1e6).alias("test_f1"),
    )


def model_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest order of a customer is the model's champion; customers with urgent orders only."""
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    best = F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).cast("string")
    return urgent.groupBy(F.concat(F.lit("main.models.c"), F.col("o_custkey").cast("string")).alias("name")).agg(
        F.lit("champion").alias("alias"), best.alias("version")
    )


VERSIONS = """versions AS (
  SELECT 'main.models.c' || o_custkey::VARCHAR AS name, o_orderkey::VARCHAR AS version,
         o_orderpriority AS description, o_orderdate AS created_at, o_totalprice / 1e6 AS test_f1
  FROM orders),
aliases AS (
  SELECT 'main.models.c' || o_custkey::VARCHAR AS name, 'champion' AS alias,
         arg_max(o_orderkey, (o_totalprice, o_orderkey))::VARCHAR AS version
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)"""


def daily_orders(spark: SparkSession, sf_dir: str, fill: float | None = 0.0) -> DataFrame:
    """Daily order value per priority as a regular series."""
    from tidegauge.operators.timeseries import resample

    return resample(
        table(spark, sf_dir, "orders"),
        "o_orderdate",
        "daily",
        {"total": F.sum("o_totalprice")},
        ["o_orderpriority"],
        fill,
    )


SERIES = """filled AS (
  SELECT o_orderpriority, date_trunc('day', o_orderdate)::TIMESTAMP AS period,
         count(*) AS n, sum(o_totalprice) AS total
  FROM orders GROUP BY ALL),
days AS (
  SELECT o_orderpriority, unnest(generate_series(min(period), max(period), INTERVAL 1 DAY)) AS period
  FROM filled GROUP BY o_orderpriority),
series AS (
  SELECT d.o_orderpriority, d.period, coalesce(f.n, 0) AS n, coalesce(f.total, 0) AS total
  FROM days d LEFT JOIN filled f ON d.o_orderpriority = f.o_orderpriority AND d.period = f.period)"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round result columns for comparison; negative zero becomes zero."""
    return df.select(
        *[
            (F.round(F.col(c), digits) + F.lit(0.0)).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )
