"""Classification, ranking and regression quality, gates, fitting and scoring."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.operators import performance as perf
from tidegauge.operators import scoring
from tidegauge.operators.split import split_train_test
from tidegauge.operators.windows import grouped_rows
from tidegauge.plans.monitoring import quality_per_window
from tidegauge.session import scratch_dir
from tidegauge.sinks.tables import save_feature_importance
from tidegauge.spec import MonitorSpec
from tidegauge.workloads.bindings import (
    CLASSIFIED,
    LOG,
    PRICED,
    SCORED,
    classified_lines,
    inference_log,
    labelled_documents,
    priced_lines,
    rounded,
    table,
)
from tidegauge.workloads.registry import workload

BINARY = """
       round((tp + tn) / n, 6) AS accuracy,
       round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""


def binary_cells(label: str, prediction: str) -> str:
    return f"""count(*) AS n, count(*) FILTER ({label} = 1 AND {prediction} = 1) AS tp,
         count(*) FILTER ({label} <> 1 AND {prediction} = 1) AS fp,
         count(*) FILTER ({label} = 1 AND {prediction} <> 1) AS fn,
         count(*) FILTER ({label} <> 1 AND {prediction} <> 1) AS tn"""


def auc_sql(source: str, label: str, score: str, keys: str = "") -> str:
    """Midranks over the raw rows."""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    head = f"{keys}, " if keys else ""
    return f"""
  SELECT {head}round((sum(r) FILTER (y = 1) - p * (p + 1) / 2) / (p * (n - p)), 6) AS roc_auc
  FROM (
    SELECT *, sum((y = 1)::INTEGER) OVER (w) AS p, count(*) OVER (w) AS n
    FROM (SELECT {head}{label} AS y,
                 rank() OVER ({part} ORDER BY {score}) + (count(*) OVER (PARTITION BY {head}{score}) - 1) / 2 AS r
          FROM {source}) WINDOW w AS ({part}))
  {group + ', p, n' if group else 'GROUP BY p, n'}"""


METRICS = ["accuracy", "precision", "recall", "f1"]


@workload(f"""
WITH {SCORED}, c AS (SELECT {binary_cells('quality', 'prediction')} FROM scored)
SELECT n, {BINARY}, (SELECT roc_auc FROM ({auc_sql('scored', 'quality', 'score')})) AS roc_auc FROM c""")
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perf.binary_metrics(labelled_documents(spark, sf_dir), "quality", "prediction", score="score")
    return rounded(found, *METRICS, "roc_auc")


@workload(f"WITH {SCORED} SELECT quality, prediction, count(*) AS n FROM scored GROUP BY ALL")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perf.confusion_matrix(labelled_documents(spark, sf_dir), "quality", "prediction")


@workload(f"WITH {CLASSIFIED} {auc_sql('classified', 'label', 'score', 'model_id')}")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the curve of a continuous score over the whole of the largest table, per model."""
    return rounded(perf.roc_auc(classified_lines(spark, sf_dir), "label", "score", ["model_id"]), "roc_auc")


WEEK = "time_bucket(INTERVAL '7 days', timestamp, TIMESTAMP '1970-01-01')"


@workload(f"""
WITH {CLASSIFIED},
w AS (SELECT *, {WEEK} AS window_start, {WEEK} + INTERVAL 7 DAY AS window_end FROM classified),
c AS (SELECT window_start, window_end, model_id, {binary_cells('label', 'prediction')} FROM w GROUP BY ALL),
a AS ({auc_sql('w', 'label', 'score', 'window_start, model_id')})
SELECT c.window_start, window_end, c.model_id, n, {BINARY}, a.roc_auc
FROM c LEFT JOIN a ON c.window_start = a.window_start AND c.model_id = a.model_id""")
def window_classification_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly quality of two models with ranking quality."""
    spec = MonitorSpec(granularities=("7 days",), model_id_col="model_id", label_col="label", numeric_cols=())
    values = {c: F.col(c) for c in ("label", "prediction", "score")}
    rows, keys = grouped_rows(classified_lines(spark, sf_dir), spec, values)
    found = perf.binary_metrics(rows, "label", "prediction", keys, "score")
    return rounded(found.drop("granularity"), *METRICS, "roc_auc")


THREE_CLASSES = """three AS (
  SELECT l_returnflag AS label, CASE l_linenumber % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS prediction
  FROM lineitem),
per_class AS (
  SELECT class, count(*) FILTER (label = class) AS support, count(*) FILTER (prediction = class) AS predicted,
         count(*) FILTER (label = class AND prediction = class) AS correct
  FROM three, (SELECT DISTINCT label AS class FROM three UNION SELECT DISTINCT prediction FROM three)
  GROUP BY class),
measured AS (
  SELECT class, support, CASE WHEN predicted = 0 THEN 0 ELSE correct / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE correct / support END AS recall,
         CASE WHEN support + predicted = 0 THEN 0 ELSE 2 * correct / (support + predicted) END AS f1
  FROM per_class)"""


def _three_classes(spark, sf_dir):
    third = F.col("l_linenumber") % 3
    predicted = F.when(third == 0, "A").when(third == 1, "N").otherwise("R")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("label"), predicted.alias("prediction")
    )


@workload(f"""
WITH {THREE_CLASSES}
SELECT class, support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM measured""")
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perf.class_metrics(_three_classes(spark, sf_dir), "label", "prediction")
    return rounded(found, "precision", "recall", "f1")


@workload(f"""
WITH {THREE_CLASSES}
SELECT sum(support)::BIGINT AS n, (SELECT round(avg((label = prediction)::INTEGER), 6) FROM three) AS accuracy,
       round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
       round(avg(f1), 6) AS macro_f1,
       round(sum(precision * support) / sum(support), 6) AS weighted_precision,
       round(sum(recall * support) / sum(support), 6) AS weighted_recall,
       round(sum(f1 * support) / sum(support), 6) AS weighted_f1
FROM measured""")
def averaged_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perf.averaged_class_metrics(_three_classes(spark, sf_dir), "label", "prediction")
    return rounded(found, *[c for c in found.columns if c != "n"])


REGRESSION = """count(*) AS n, round(avg(abs(label - prediction)), 6) AS mae,
  round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse,
  round(avg(CASE WHEN label <> 0 THEN abs((label - prediction) / label) END), 6) AS mape,
  round(CASE WHEN var_pop(label) <> 0 THEN 1 - avg((label - prediction) ** 2) / var_pop(label) END, 6) AS r2"""
ERRORS = ["mae", "rmse", "mape", "r2"]


@workload(f"WITH {PRICED} SELECT {REGRESSION} FROM priced")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(perf.regression_metrics(priced_lines(spark, sf_dir), "label", "prediction"), *ERRORS)


@workload(f"""
WITH {PRICED}
SELECT time_bucket(INTERVAL '30 days', timestamp, TIMESTAMP '1970-01-01') AS window_start,
       time_bucket(INTERVAL '30 days', timestamp, TIMESTAMP '1970-01-01') + INTERVAL 30 DAY AS window_end,
       model_id, {REGRESSION}
FROM priced GROUP BY ALL""")
def window_regression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = MonitorSpec(
        problem_type="regression", granularities=("30 days",), label_col="label", model_id_col="model_id"
    )
    found = quality_per_window(priced_lines(spark, sf_dir), spec)
    return rounded(found.drop("granularity", "slice_key", "slice_value"), *ERRORS)


@workload(f"""
WITH {SCORED}, c AS (SELECT source, {binary_cells('quality', 'prediction')} FROM scored GROUP BY source),
m AS (SELECT source, n, tp, {BINARY.replace('round(', '(').replace(', 6)', ')')} FROM c)
SELECT source, n, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, 0.75 AS baseline_f1, round(f1 - 0.75, 6) AS improvement,
       round((f1 - 0.75) / 0.75 * 100, 6) AS improvement_percent, f1 > 0.75 AS should_register
FROM m""")
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate per source against a baseline F1 of 0.75; an equal F1 is not enough."""
    metrics = perf.binary_metrics(labelled_documents(spark, sf_dir), "quality", "prediction", ["source"])
    return rounded(perf.promotion_gate(metrics, "f1", 0.75), *METRICS, "improvement", "improvement_percent")


@workload(f"""
WITH {SCORED},
two AS (
  SELECT lang, quality, 'long' AS model, prediction FROM scored
  UNION ALL SELECT lang, quality, 'short', (n_chars < 3000)::INTEGER FROM scored),
c AS (SELECT lang, model, {binary_cells('quality', 'prediction')} FROM two GROUP BY ALL),
m AS (SELECT lang, model, {BINARY.replace('round(', '(').replace(', 6)', ')')} FROM c),
long AS (UNPIVOT m ON accuracy, precision, recall, f1 INTO NAME metric_name VALUE v),
p AS (SELECT lang, metric_name, max(v) FILTER (model = 'long') AS champion,
             max(v) FILTER (model = 'short') AS challenger FROM long GROUP BY ALL)
SELECT lang, metric_name, round(champion, 6) AS champion, round(challenger, 6) AS challenger,
       round(challenger - champion, 6) AS difference
FROM p""")
def champion_challenger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rules for the same documents, per language."""
    both = labelled_documents(spark, sf_dir).withColumn("short", (F.col("n_chars") < 3000).cast("int"))
    found = perf.champion_challenger(
        both, "quality", {"long": "prediction", "short": "short"}, "long", "short", ["lang"]
    )
    return rounded(found, "champion", "challenger", "difference")


def _training_rows(spark, sf_dir):
    """Is an order line a large one? All lines with numeric features; the quantity tells."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("line"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        (F.col("l_quantity") > 25).cast("int").alias("target"),
    )


_FITTED: dict[tuple, PipelineModel] = {}


def forget_models() -> None:
    """Let the next query fit anew."""
    _FITTED.clear()


def _version(spark, sf_dir) -> tuple:
    """What changes when the training table is written again: the newest of its files, and their number."""
    files = table(spark, sf_dir, "lineitem").select("_metadata.file_path", "_metadata.file_modification_time").distinct()
    return tuple(files.agg(F.count("*"), F.max("file_modification_time").cast("string")).first())


def _fitted(spark, sf_dir):
    """The classifier with its default settings, fitted once per session and version of the table, and the test part."""
    train, test = split_train_test(_training_rows(spark, sf_dir), 0.2, 42, "line")
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, sf_dir))
    if key not in _FITTED:
        _FITTED[key] = scoring.fit_classifier(train, "target", exclude=("line",))
    return _FITTED[key], test


IS_TEST_LINE = """('0x' || substr(md5('42:' || concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 8))::BIGINT
  % 1000000 < 200000"""


@workload(f"""
SELECT count(*) AS n, true AS accuracy, true AS precision, true AS recall, true AS f1, true AS roc_auc, true AS gate
FROM lineitem WHERE {IS_TEST_LINE}""")
def gbt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train part, measure on the test part: a rule on one feature is learned to 0.99 or better."""
    model, test = _fitted(spark, sf_dir)
    metrics = perf.binary_metrics(scoring.score(test, model), "target", "prediction", score="probability")
    rates = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    gate = F.col("should_register") & (F.col("f1") > 0.98)
    return perf.promotion_gate(metrics, "f1", 0.98).select(
        "n", *[F.col(c).between(0.99, 1.0).alias(c) for c in rates], gate.alias("gate")
    )


FEATURES = ["l_discount", "l_extendedprice", "l_quantity", "l_tax"]


@workload(f"""
SELECT feature, true AS is_share, true AS sums_to_one, feature = 'l_quantity' AS decides
FROM (SELECT unnest({FEATURES}) AS feature FROM (SELECT 1 FROM lineitem LIMIT 1))""")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of the fitted model are shares of one, and most of it is the feature that makes the label."""
    found = scoring.feature_importance(_fitted(spark, sf_dir)[0], spark)
    total = found.agg(F.sum("importance")).scalar()
    return found.select(
        "feature",
        F.col("importance").between(0.0, 1.0).alias("is_share"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
        (F.col("importance") > 0.5).alias("decides"),
    )


@workload(f"""
SELECT feature, true AS is_share, true AS in_order, feature = 'l_quantity' AS first
FROM (SELECT unnest({FEATURES}) AS feature FROM (SELECT 1 FROM lineitem LIMIT 1))""")
def importance_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances as written to CSV and read back: shares, the greatest first."""
    path = f"{scratch_dir(spark, 'importance')}/importance"
    save_feature_importance(scoring.feature_importance(_fitted(spark, sf_dir)[0], spark), path)
    found = spark.read.csv(path, header=True, schema="feature string, importance double")
    # one small file: its rows are numbered as they stand
    numbered = found.withColumn("_at", F.monotonically_increasing_id())
    order = Window.orderBy("_at")
    return numbered.select(
        "feature",
        F.col("importance").between(0.0, 1.0).alias("is_share"),
        F.coalesce(F.col("importance") >= F.lead("importance").over(order), F.lit(True)).alias("in_order"),
        (F.row_number().over(order) == 1).alias("first"),
    )


@workload("""
SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS line, (l_quantity > 25)::INTEGER AS target,
       true AS is_right, true AS is_probability, true AS agrees FROM lineitem""")
def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line scored: the class its quantity says, a probability, and the class that the probability says."""
    model, _ = _fitted(spark, sf_dir)
    p, y = F.col("probability"), F.col("prediction")
    return scoring.score(_training_rows(spark, sf_dir), model).select(
        "line",
        "target",
        (y == F.col("target")).alias("is_right"),
        p.between(0.0, 1.0).alias("is_probability"),
        ((p > 0.5) == (y == 1.0)).alias("agrees"),
    )


class LogisticRule:
    """A fixed model for scoring with any Python object that has ``predict``."""

    def predict(self, features: pd.DataFrame) -> pd.Series:
        return 1.0 / (1.0 + np.exp(-(features["value"] - 40.0) / 10.0))


@workload(f"""
WITH {LOG}
SELECT request_id, value, round(1.0 / (1.0 + exp(-(value - 40.0) / 10.0)), 6) AS prediction FROM log""")
def pandas_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inference_log(spark, sf_dir).select("request_id", "value")
    return rounded(scoring.score_with(log, LogisticRule, ["value"]), "prediction")


class GuardedRule:
    """A fixed model that has no answer below 10."""

    def predict(self, features: pd.DataFrame) -> pd.Series:
        return features["value"].where(features["value"] >= 10)


@workload(f"""
WITH {LOG}, a AS (SELECT count(*) AS n, count(*) FILTER (value < 10 OR value IS NULL) AS m FROM log)
SELECT 'logistic' AS model, n AS n_rows, 0::BIGINT AS n_missing, true AS passed FROM a
UNION ALL SELECT 'guarded', n, m, m = 0 FROM a""")
def scoring_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that scores every row, and one that does not."""
    log = inference_log(spark, sf_dir).select("request_id", "value")
    checks = [
        scoring.scoring_check(scoring.score_with(log, rule, ["value"])).select(F.lit(name).alias("model"), "*")
        for name, rule in (("logistic", LogisticRule), ("guarded", GuardedRule))
    ]
    return checks[0].unionByName(checks[1])
