"""Fitting a boosted-tree classifier and scoring tables with models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import count_where, quoted
from tidegauge.operators.distribution import even_cuts
from tidegauge.operators.prepare import feature_columns

# Default settings of the classifier.
DEFAULT_PARAMS = {"max_depth": 5, "n_estimators": 100, "learning_rate": 0.1}
DEFAULT_SEED = 42
# Bins of a numeric feature, the classifier's own default.
FEATURE_BINS = 32


def fit_classifier(
    train: DataFrame,
    target: str = "target",
    params: dict | None = None,
    seed: int = DEFAULT_SEED,
    exclude: tuple[str, ...] = (),
) -> PipelineModel:
    """Fit a binary classifier on all columns but the target and the excluded ones.

    A tree sees the bin of a number and nothing else, so the bins are cut first and rows
    alike in all of them are counted: the trees are built from one weighted row for each, and a
    table of any length is read twice, however many trees there are.
    """
    settings = {**DEFAULT_PARAMS, **(params or {})}
    features = feature_columns(train, target, exclude)
    numeric = [c for c in features if isinstance(train.schema[c].dataType, T.NumericType)]
    taken, names = {c.lower() for c in train.columns}, {}
    for c in numeric:
        names[c] = f"{c}_bin"
        while names[c].lower() in taken:
            names[c] += "_"
        taken.add(names[c].lower())
    cuts = even_cuts(train, numeric, FEATURE_BINS)
    binning = [
        Bucketizer(
            splitsArray=[[-float("inf"), *(cuts[c] or [0.0]), float("inf")] for c in numeric],
            inputCols=numeric,
            outputCols=list(names.values()),
            handleInvalid="keep",
        )
    ] if numeric else []
    inputs = [names.get(c, c) for c in features]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    weight = "n_rows"
    while weight.lower() in taken:
        weight += "_"
    classifier = GBTClassifier(
        labelCol=target,
        featuresCol="features",
        weightCol=weight,
        maxBins=FEATURE_BINS,
        maxDepth=settings["max_depth"],
        maxIter=settings["n_estimators"],
        stepSize=settings["learning_rate"],
        seed=seed,
    )
    binned = Pipeline(stages=binning).fit(train).transform(train)
    # a missing number stays missing, which the classifier refuses
    known = {names[c]: F.when(~F.isnan(F.col(quoted(c)).cast("double")), F.col(quoted(names[c]))) for c in numeric}
    alike = binned.withColumns(known).groupBy(*[F.col(quoted(c)) for c in (*inputs, target)]).agg(F.count("*").cast("double").alias(weight))
    fitted = Pipeline(stages=[assembler, classifier]).fit(alike)
    return PipelineModel([*binning, *fitted.stages])


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """The table with the predicted class and the probability of the positive class."""
    positive = vector_to_array("probability")[1].alias("probability")
    return model.transform(df).select(*[F.col(quoted(c)) for c in df.columns], positive, "prediction")


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """One row per feature, greatest importance first."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    binned = {b: c for s in model.stages if isinstance(s, Bucketizer) for b, c in zip(s.getOutputCols(), s.getInputCols())}
    names = [binned.get(c, c) for c in assembler.getInputCols()]
    rows = [(n, float(v)) for n, v in zip(names, model.stages[-1].featureImportances.toArray())]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")


def score_with(
    df: DataFrame,
    load: Callable[[], object],
    features: list[str],
    prediction_type: T.DataType | None = None,
) -> DataFrame:
    """Score with any Python object that has ``predict``; it is loaded once per task.

    Only the feature columns travel to Python, in Arrow batches; the rest of a row stays
    where it is.
    """

    @F.pandas_udf(prediction_type or T.DoubleType())
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield pd.Series(model.predict(batch[features])).reset_index(drop=True)

    return df.withColumn("prediction", predict(F.struct(*[F.col(quoted(c)).alias(c) for c in features])))


def scoring_check(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Did every row get a prediction? An empty sample does not pass."""
    missing = count_where(F.col(prediction).isNull())
    return scored.agg(F.count("*").alias("n_rows"), missing.alias("n_missing")).select(
        "*", ((F.col("n_missing") == 0) & (F.col("n_rows") > 0)).alias("passed")
    )


def input_contract(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """Columns that are missing, extra or of another type than a model expects; no row if all fit."""
    wanted = expected if isinstance(expected, T.StructType) else T.StructType.fromDDL(expected)
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in wanted}
    rows = [
        (name, want.get(name), have.get(name), problem)
        for name in [*want, *[n for n in have if n not in want]]
        if (
            problem := "missing" if name not in have
            else "unexpected" if name not in want
            else "type" if want[name] != have[name]
            else None
        )
    ]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, expected_type string, actual_type string, problem string"
    )


def contract_violations(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """The problems of ``input_contract`` with the rows they concern, from one pass over the table.

    A missing column concerns every row. A column of another type concerns the rows whose
    value changes, or is lost, when it is read as the expected type; an unexpected column
    concerns none.
    """
    problems = input_contract(df, expected).collect()  # one row per column at most

    def concerned(row) -> Column:
        if row["problem"] == "missing":
            return F.count("*")
        if row["problem"] == "unexpected":
            return F.lit(0).cast("long")
        value = F.col(quoted(row["column_name"]))
        back = value.try_cast(row["expected_type"]).try_cast(row["actual_type"])
        return count_where(~value.eqNullSafe(back))

    counted = [
        F.struct(
            *[F.lit(row[c]).cast("string").alias(c) for c in ("column_name", "expected_type", "actual_type", "problem")],
            concerned(row).alias("n_rows"),
        )
        for row in problems
    ]
    if not counted:
        return input_contract(df, expected).withColumn("n_rows", F.lit(0).cast("long"))
    return df.agg(F.array(*counted).alias("_problems")).select(F.inline("_problems"))
