"""Sources, projections, joins, set operations, splits and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import prepare
from tidegauge.operators.profile import numeric_profile
from tidegauge.operators.scoring import contract_violations
from tidegauge.operators.split import flag_test_rows, split_train_test
from tidegauge.session import scratch_dir
from tidegauge.sinks import tables as sinks
from tidegauge.sources import inference_log as logs
from tidegauge.sources import tables as sources
from tidegauge.sources.tables import first_rows, log_status
from tidegauge.workloads.bindings import AS_OF, BASE, LOG, inference_log, log_spec, rounded, table
from tidegauge.workloads.registry import workload


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")


@workload("SELECT doc_id, n_chars, lang FROM documents")
def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.select_features(table(spark, sf_dir, "documents"), "doc_id", ["n_chars", "doc_id", "lang"])


@workload("SELECT doc_id, lang, source, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def feature_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.join_labels(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id", "quality")


AUDIT_SQL = """
WITH f AS ({features}), l AS ({labels}),
per_key AS (SELECT key, count(*) AS n FROM l GROUP BY key),
j AS (SELECT f.key, per_key.n FROM f LEFT JOIN per_key ON f.key = per_key.key)
SELECT *, feature_count - joined_count AS row_difference, unmatched_rows > 0 AS warn
FROM (
  SELECT (SELECT count(*) FROM f) AS feature_count,
         (SELECT count(*) FROM l) AS label_count,
         (SELECT coalesce(sum(n), 0)::BIGINT FROM j) AS joined_count,
         (SELECT count(*) FROM j WHERE n IS NULL) AS unmatched_rows,
         (SELECT count(*) FROM per_key WHERE n > 1 AND key IS NOT NULL) AS duplicate_label_keys)"""


@workload(
    AUDIT_SQL.format(features="SELECT doc_id AS key FROM documents", labels="SELECT doc_id AS key FROM labels")
)
def join_loss_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.join_loss(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@workload(
    AUDIT_SQL.format(
        features="SELECT o_orderkey AS key FROM orders", labels="SELECT l_orderkey AS key FROM lineitem"
    )
)
def join_loss_repeated_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several label rows per key: the row difference goes negative and hides the loss."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"))
    return prepare.join_loss(orders, lines, "key")


@workload("""
SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS feature_keys,
       (SELECT count(DISTINCT c_custkey) FROM customer) AS label_keys,
       (SELECT count(DISTINCT o_custkey) FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS shared_keys,
       (SELECT count(DISTINCT o_custkey) FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) AS keys_missing_labels,
       (SELECT count(DISTINCT c_custkey) FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) AS keys_missing_features""")
def key_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return prepare.key_coverage(orders, customers, "key")


@workload("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def keys_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.missing_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@workload("SELECT DISTINCT user_id FROM events")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.distinct_keys(table(spark, sf_dir, "events"), "user_id")


@workload("""
SELECT doc_id, lang, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def rows_without_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.rows_without_label(_documents(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id")


IS_TEST = "('0x' || substr(md5('42:' || {key}), 1, 8))::BIGINT % 1000000 < 200000"


@workload(f"""
SELECT doc_id, lang, source, n_chars, CASE WHEN {IS_TEST.format(key='doc_id::VARCHAR')} THEN 'test' ELSE 'train' END AS part
FROM documents""")
def hash_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both parts of the split."""
    train, test = split_train_test(_documents(spark, sf_dir), 0.2, 42, "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@workload(f"""
SELECT count(*) FILTER (NOT is_test) AS train_count, count(*) FILTER (is_test) AS test_count,
       count(*) AS total_count, 4::BIGINT AS feature_count, 3::BIGINT AS model_feature_count
FROM (SELECT {IS_TEST.format(key='event_id::VARCHAR')} AS is_test FROM events)""")
def hash_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data facts of a split: both counts from one pass."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    return sinks.data_facts(flag_test_rows(events, "event_id", 0.2, 42), "is_test", "value", "event_id")


@workload("""
SELECT source AS table_name, count(*) AS row_count, 'training' AS context, max(doc_id) + 1 AS version
FROM documents GROUP BY source""")
def dataset_version_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows of new versions; documents stand for the earlier versions of their source."""
    documents = table(spark, sf_dir, "documents")
    sized = documents.groupBy(F.col("source").alias("table_name")).agg(
        F.count("*").alias("row_count"), F.lit("training").alias("context")
    )
    earlier = documents.select(F.col("source").alias("table_name"), F.col("doc_id").alias("version"))
    return sinks.dataset_versions(sized, earlier)


@workload("""
SELECT true AS table_exists, count(*) > 0 AS has_data, count(*) AS n_rows, 6 AS n_columns,
       CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END AS status
FROM events""")
def log_table_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_status(table(spark, sf_dir, "events"))


@workload("SELECT event_id, ts, event_type, value FROM events ORDER BY event_id LIMIT 5")
def log_table_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return first_rows(events, 5, ["event_id"])


@workload("""
SELECT event_id, value, (props->>'$.k')::BIGINT AS k, NOT json_valid(props) AS props_unparsed FROM events""")
def unpack_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value", "props")
    return logs.unpack_payload(events, "props", "k long").drop("props")


@workload(f"""
WITH {LOG}
SELECT request_id, 0.0::DOUBLE AS record, value, value * 2 AS amount, (value > 20)::VARCHAR AS prediction,
       false AS request_unparsed FROM log WHERE status_code = 200
UNION ALL
SELECT request_id, 1, value + 1, value * 3, (value > 30)::VARCHAR, false FROM log WHERE status_code = 200
UNION ALL
SELECT request_id, NULL, NULL, NULL, NULL, true FROM log WHERE status_code <> 200""")
def unpack_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of two records each, written as JSON from the log and read back; failed ones are cut off."""
    v = F.col("value")
    cells = [F.struct(v.alias("value"), (v * 2).alias("amount")), F.struct((v + 1).alias("value"), (v * 3).alias("amount"))]
    request = F.to_json(F.struct(F.array(*cells).alias("dataframe_records")))
    log = inference_log(spark, sf_dir).select(
        "request_id",
        F.when(F.col("status_code") == 200, request).otherwise(F.lit("{not json")).alias("request"),
        F.to_json(F.struct(F.array(v > 20, v > 30).alias("predictions"))).alias("response"),
    )
    found = logs.unpack_records(log, "value double, amount double", "boolean")
    return found.withColumns(
        {"record": F.col("record").cast("double"), "prediction": F.col("prediction").cast("string")}
    )


@workload("SELECT doc_id, lang, source, n_chars, toxic::DOUBLE AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("double"))
    return logs.attach_labels(_documents(spark, sf_dir), labels, "doc_id", "toxic")


@workload(f"""
SELECT event_id, ts FROM events WHERE ts >= CAST(DATE '{AS_OF}' - INTERVAL 10 DAY AS TIMESTAMP)""")
def retention_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.within_retention(table(spark, sf_dir, "events"), "ts", 10, AS_OF).select("event_id", "ts")


@workload(f"""
WITH {BASE},
days AS (
  SELECT date_trunc('day', timestamp)::TIMESTAMP AS window_start, count(*)::DOUBLE AS n, avg(value) AS a
  FROM log GROUP BY 1)
SELECT window_start, metric_name, round(metric_value, 6) AS metric_value
FROM (SELECT window_start, unnest([{{'metric_name': 'count', 'metric_value': n}},
                                   {{'metric_name': 'avg', 'metric_value': a}}], recursive := true) FROM days)""")
def refresh_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored profile after two refreshes, the second of the later days only."""
    log, spec = inference_log(spark, sf_dir), log_spec()
    path = scratch_dir(spark, "profile_metrics")
    wanted = F.col("metric_name").isin("count", "avg")
    whole = numeric_profile(log, spec, ["value"]).where(wanted)
    sinks.save_metrics(whole, path)
    later = log.where(F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    sinks.save_metrics(numeric_profile(later, spec, ["value"]).where(wanted), path)
    stored = spark.read.parquet(path).select("window_start", "metric_name", "metric_value")
    return rounded(stored, "metric_value")


@workload("""
SELECT 'value' AS column_name, 'bigint' AS expected_type, 'double' AS actual_type, 'type' AS problem,
       count(*) FILTER (value <> trunc(value)) AS n_rows FROM events
UNION ALL SELECT 'event_type', 'int', 'string', 'type', count(event_type) FILTER (TRY_CAST(event_type AS INTEGER) IS NULL) FROM events
UNION ALL SELECT 'score', 'double', NULL, 'missing', count(*) FROM events
UNION ALL SELECT 'props', NULL, 'string', 'unexpected', 0""")
def input_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of ``events`` that do not fit an expected schema, with the rows whose values do not."""
    expected = "event_id long, ts timestamp_ntz, user_id long, event_type int, value long, score double"
    return contract_violations(table(spark, sf_dir, "events"), expected)


@workload("SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def feature_table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature by key with the label joined on, read by name."""
    return sources.load_training_source(
        spark, feature_table=f"{sf_dir}/documents.parquet", lookup_key="doc_id", feature_columns=["n_chars"],
        label_table=f"{sf_dir}/labels.parquet", label_column="quality",
    )


@workload("""
SELECT 'train' AS part, 1::BIGINT AS version, count(*) AS row_count, 'training' AS context FROM labels WHERE quality = 1
UNION ALL SELECT 'train', 2, count(*), 'training' FROM labels
UNION ALL SELECT 'test', 1, count(*), 'validation' FROM labels WHERE toxic = 1""")
def saved_table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after three saves of two tables."""
    out, labels = scratch_dir(spark, "saved_tables"), table(spark, sf_dir, "labels")
    ledger = f"{out}/ledger"
    for rows, name, context in (
        (labels.where("quality = 1"), "train", "training"),
        (labels, "train", "training"),
        (labels.where("toxic = 1"), "test", "validation"),
    ):
        sinks.save_table(rows, f"{out}/{name}", ledger, context=context)
    part = F.element_at(F.split("table_name", "/"), -1)
    return sinks.stored_table(spark, ledger).select(part.alias("part"), "version", "row_count", "context")
