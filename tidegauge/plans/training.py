"""From source tables to a validated candidate: prepare, train, register decision, validate."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.performance import binary_metrics, promotion_gate
from tidegauge.operators.registry import SCORECARD_CHECKS, validation_scorecard
from tidegauge.operators.scoring import (
    DEFAULT_SEED,
    feature_importance,
    fit_classifier,
    input_contract,
    score,
    scoring_check,
)
from tidegauge.operators.split import DEFAULT_TEST_SIZE, split_train_test
from tidegauge.sinks.tables import data_facts, save_table
from tidegauge.sources.tables import first_rows, load_training_source


def prepare_training_data(
    spark: SparkSession,
    train_table: str,
    test_table: str,
    ledger: str,
    key: str | None = None,
    target: str = "target",
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    **source,
) -> DataFrame:
    """Read the source, split it, write both parts with their versions; returns the data facts.

    The facts are counted from the written tables, so the source is not read again.
    """
    df = load_training_source(spark, label_column=target, lookup_key=key, **source)
    train, test = split_train_test(df, test_size, seed, key)
    save_table(train, train_table, ledger, context="training")
    save_table(test, test_table, ledger, context="validation")
    written = (
        spark.table(train_table)
        .withColumn("is_test", F.lit(False))
        .unionByName(spark.table(test_table).withColumn("is_test", F.lit(True)))
    )
    return data_facts(written, "is_test", target, key)


def train_candidate(
    train: DataFrame,
    test: DataFrame,
    target: str = "target",
    baseline_f1: float = 0.0,
    params: dict | None = None,
    seed: int = DEFAULT_SEED,
    exclude: tuple[str, ...] = (),
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on train, measure on test, decide on promotion.

    Returns the model, its metrics with the decision (one row) and its feature importance.
    """
    model = fit_classifier(train, target, params, seed, exclude)
    scored = score(test, model)
    metrics = binary_metrics(scored, target, "prediction", score="probability")
    return model, promotion_gate(metrics, "f1", baseline_f1), feature_importance(model, train.sparkSession)


def validate_candidate(
    model: PipelineModel | None,
    test: DataFrame,
    expected: T.StructType | str,
    metadata: DataFrame,
    sample_size: int = 5,
) -> DataFrame:
    """The four checks of a scorecard on a sample of the test table: one row with the verdict."""
    spark = test.sparkSession
    sample = first_rows(test, sample_size)
    problems = input_contract(test, expected).where("problem <> 'unexpected'")
    results = {
        "model_loaded": spark.range(1).select(F.lit(model is not None).alias("passed")),
        "signature_valid": problems.agg((F.count("*") == 0).alias("passed")),
        "inference_passed": (
            scoring_check(score(sample, model)).select("passed")
            if model is not None
            else spark.range(1).select(F.lit(False).alias("passed"))
        ),
        "metadata_found": metadata.agg((F.count("*") > 0).alias("passed")),
    }
    checks = None
    for name in SCORECARD_CHECKS:
        row = results[name].select(F.lit("candidate").alias("candidate"), F.lit(name).alias("check_name"), "passed")
        checks = row if checks is None else checks.unionByName(row)
    return validation_scorecard(checks, ["candidate"])
