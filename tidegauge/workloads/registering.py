"""Runs, model versions, aliases and scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import scalars
from tidegauge.operators import registry as reg
from tidegauge.workloads.bindings import RUNS, VERSIONS, model_aliases, model_versions, rounded, runs, table
from tidegauge.workloads.registry import workload


@workload(f"""
WITH {RUNS}
SELECT run_id, experiment, status, should_register, start_time, test_f1 FROM runs
WHERE status = 'FINISHED' AND should_register ORDER BY start_time DESC, run_id LIMIT 1""")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reg.latest_run(runs(spark, sf_dir))
    return found.withColumn("test_f1", F.col("metrics")["test_f1"]).drop("metrics")


@workload(f"""
WITH {RUNS}
SELECT experiment, arg_max(run_id, (start_time, run_id)) AS run_id, max(start_time) AS start_time
FROM runs WHERE status = 'FINISHED' AND should_register GROUP BY experiment""")
def latest_run_per_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reg.latest_runs(runs(spark, sf_dir).drop("metrics"))
    return found.select("experiment", "run_id", "start_time")


@workload(f"""
WITH {RUNS} SELECT run_id, experiment FROM runs WHERE status = 'FINISHED' AND should_register""")
def qualifying_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.qualifying_runs(runs(spark, sf_dir)).select("run_id", "experiment")


@workload(f"WITH {VERSIONS} SELECT name, max(version::INTEGER)::VARCHAR AS version FROM versions GROUP BY name")
def latest_model_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions compare as numbers: "10" is later than "9"."""
    return reg.latest_versions(model_versions(spark, sf_dir))


def _customers(spark, sf_dir):
    name = F.concat(F.lit("main.models.c"), F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select(name.alias("name"))


@workload(f"""
WITH {VERSIONS}
SELECT n.name, a.version FROM (SELECT 'main.models.c' || c_custkey::VARCHAR AS name FROM customer) n
LEFT JOIN aliases a ON n.name = a.name AND a.alias = 'champion'""")
def model_by_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The champion of every model, null for a model without one."""
    versions, aliases = model_versions(spark, sf_dir), model_aliases(spark, sf_dir)
    return reg.resolve_versions(_customers(spark, sf_dir), versions, aliases, "champion")


@workload(f"""
WITH {VERSIONS},
dated AS (SELECT name, (strftime(created_at, '%Y%m%d')::BIGINT * 1000000000 + version::BIGINT)::VARCHAR AS version FROM versions),
both_forms AS (SELECT name, version FROM versions UNION ALL SELECT * FROM dated),
o AS (SELECT name, version, (row_number() OVER (PARTITION BY name ORDER BY version::BIGINT DESC))::INTEGER AS position FROM both_forms)
SELECT name, version, position FROM o WHERE position <= 5""")
def version_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five newest versions of every model, some of them numbered by date with 17 digits."""
    plain = model_versions(spark, sf_dir)
    dated = F.date_format("created_at", "yyyyMMdd").cast("long") * 1_000_000_000 + F.col("version").cast("long")
    both = plain.select("name", "version").union(plain.select("name", dated.cast("string")))
    return reg.top_versions(both, 5).select("name", "version", "position")


@workload(f"""
WITH {VERSIONS}
SELECT name, version, description FROM versions
WHERE name = (SELECT name FROM versions WHERE version = '7') AND version = '7'""")
def model_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One version looked up by model and number."""
    versions = model_versions(spark, sf_dir).select("name", "version", "description")
    wanted = versions.where("version = '7'").select("name", "version").distinct()
    return reg.model_metadata(versions, wanted)


@workload(f"""
WITH {VERSIONS}
SELECT v.name, v.version, replace(v.name, '.', '_') AS flat_name,
       'models:/' || v.name || coalesce('@' || a.alias, '/' || v.version) AS uri
FROM versions v LEFT JOIN aliases a ON v.name = a.name AND v.version = a.version""")
def model_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URI of every version: by alias where it has one, else by number."""
    versions = model_versions(spark, sf_dir).select("name", "version")
    both = versions.join(model_aliases(spark, sf_dir), ["name", "version"], "left")
    return both.select(
        "name",
        "version",
        scalars.flat_name(F.col("name")).alias("flat_name"),
        scalars.model_uri(F.col("name"), F.col("version"), F.col("alias")).alias("uri"),
    )


@workload("""
SELECT event_id, 'main.models.' || event_type AS full_name,
       printf('Model trained on %s with F1=%.4f, Accuracy=%.4f', strftime(ts, '%Y-%m-%d'), value / 500, 0.0) AS description
FROM events""")
def run_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration text of every run; accuracy was not recorded and counts as 0."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalars.full_name("main", "models", F.col("event_type")).alias("full_name"),
        scalars.model_description(
            F.col("ts"), F.col("value") / 500, F.lit(None).cast("double")
        ).alias("description"),
    )


@workload(f"""
WITH {RUNS},
pairs AS (SELECT run_id, test_f1, base FROM runs JOIN (
  SELECT experiment, arg_min(test_f1, (start_time, run_id)) AS base FROM runs GROUP BY experiment) USING (experiment))
SELECT run_id, round(test_f1 - base, 6) AS improvement,
       round(CASE WHEN base > 0 THEN (test_f1 - base) / base * 100 ELSE 0 END, 6) AS improvement_percent
FROM pairs""")
def run_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run against the first run of its experiment."""
    rows = runs(spark, sf_dir).select(
        "run_id", "experiment", "start_time", F.col("metrics")["test_f1"].alias("f1")
    )
    first = rows.groupBy("experiment").agg(F.min_by("f1", F.struct("start_time", "run_id")).alias("base"))
    found = rows.join(first, "experiment").select(
        "run_id",
        scalars.improvement(F.col("f1"), F.col("base")).alias("improvement"),
        scalars.improvement_percent(F.col("f1"), F.col("base")).alias("improvement_percent"),
    )
    return rounded(found, "improvement", "improvement_percent")


@workload("""
WITH c AS (
  SELECT o_custkey, count(*) > 0 AS a, bool_and(o_totalprice > 0) AS b,
         count(*) FILTER (o_orderstatus = 'F') > 0 AS i, count(*) FILTER (o_orderpriority = '1-URGENT') > 0 AS m
  FROM orders GROUP BY 1),
s AS (SELECT o_custkey, (a::INTEGER + b::INTEGER + i::INTEGER + m::INTEGER) AS checks_passed FROM c)
SELECT o_custkey, checks_passed, 4 AS checks_total,
       CASE WHEN checks_passed = 4 THEN 'passed' WHEN checks_passed >= 3 THEN 'passed_with_warnings' ELSE 'failed' END AS status,
       checks_passed >= 3 AS is_valid
FROM s""")
def validation_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four checks per model, each derived from the orders that stand for its versions."""
    versions = table(spark, sf_dir, "orders")
    wide = versions.groupBy("o_custkey").agg(
        (F.count("*") > 0).alias("model_loaded"),
        F.bool_and(F.col("o_totalprice") > 0).alias("signature_valid"),
        F.bool_or(F.col("o_orderstatus") == "F").alias("inference_passed"),
        F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("metadata_found"),
    )
    checks = wide.unpivot(["o_custkey"], list(reg.SCORECARD_CHECKS), "check_name", "passed")
    return reg.validation_scorecard(checks, ["o_custkey"])
