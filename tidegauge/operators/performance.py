"""Model quality: classification, ranking and regression metrics, gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import join_groups, ratio
from tidegauge.functions.scalars import improvement, improvement_percent
from tidegauge.operators.distribution import Edges, fixed_bin, numeric_long, running_totals, value_counts


def confusion_matrix(df: DataFrame, label: str, prediction: str, keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), label, prediction).agg(F.count("*").alias("n"))


def _binary_from_cells(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Accuracy and, for the positive class, precision, recall and F1 (0 for a zero denominator)."""
    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp, when_zero=0.0),
        "recall": ratio(tp, tp + fn, when_zero=0.0),
        "f1": ratio(2 * tp, 2 * tp + fp + fn, when_zero=0.0),
    }


def quality_counts(
    df: DataFrame, label: str, prediction: str, keys: list[str] | None = None, score: str | None = None, edges: Edges | None = None
) -> DataFrame:
    """Rows with a label per group, label, prediction and score: what all measures of a classifier are made of.

    ``_label``, ``_prediction``, with a score also ``bin`` and ``value``, and ``n``. Measures taken from one such
    table share its scan and its shuffle.
    """
    rows = df.where(F.col(label).isNotNull()).select(*(keys or []), F.col(label).alias("_label"), F.col(prediction).alias("_prediction"), *([score] if score else []))
    by = [*(keys or []), "_label", "_prediction"]
    if score is None:
        return rows.groupBy(*by).agg(F.count("*").alias("n"))
    number = F.col(score).cast("double")
    value = F.when(~F.isnan(number), number)
    if edges is None:
        binned = rows.select(*by, fixed_bin(value).alias("bin"), value.alias("value"))
    else:
        binned = numeric_long(rows, by, [score], edges).drop("column_name")
    return value_counts(binned, by)


def _summed(condition: Column) -> Column:
    """Rows of a count table that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def binary_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 label from a count table."""
    y, p = F.col("_label") == 1, F.coalesce(F.col("_prediction") == 1, F.lit(False))
    wide = counts.groupBy(*keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        _summed(y & p).alias("_tp"),
        _summed(~y & p).alias("_fp"),
        _summed(y & ~p).alias("_fn"),
        _summed(~y & ~p).alias("_tn"),
    )
    cells = _binary_from_cells(*[F.col(c) for c in ("_tp", "_fp", "_fn", "_tn")])
    return wide.select(*keys, "n", *[c.alias(m) for m, c in cells.items()])


def auc_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Area under the ROC curve per group from a count table with scores, ties counted half; null with one class only.

    The rank of a score is the negatives in the lower bins plus those below it in its own bin.
    """
    # a row without a score weighs nothing; dropping it here would ask for another shuffle
    weight = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    per_value = counts.groupBy(*keys, "bin", "value").agg(
        F.sum(weight).alias("_all"), F.sum(F.when(F.col("_label") == 1, weight).otherwise(0)).alias("_pos")
    )
    ranked = running_totals(per_value.withColumn("_neg", F.col("_all") - F.col("_pos")), keys, ["_neg"])
    below = F.col("before__neg") + F.col("_neg") / 2
    return (
        ranked.groupBy(*keys)
        .agg(
            F.sum(F.col("_pos").cast("double") * below).alias("_wins"),
            F.sum("_pos").alias("_p"),
            F.sum("_neg").alias("_n"),
        )
        .select(*keys, ratio(F.col("_wins"), F.col("_p").cast("double") * F.col("_n")).alias("roc_auc"))
    )


def binary_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    keys: list[str] | None = None,
    score: str | None = None,
    edges: Edges | None = None,
) -> DataFrame:
    """Classification metrics of a 0/1 label, per group; rows without a label take no part.

    One count table. With a ``score`` column the ROC-AUC is taken from the same one.
    """
    keys = keys or []
    counts = quality_counts(df, label, prediction, keys, score, edges)
    metrics = binary_of_counts(counts, keys)
    if score is None:
        return metrics
    auc = auc_of_counts(counts, keys)
    # without keys both are one row
    return join_groups(metrics, auc, keys, "left") if keys else metrics.withColumn("roc_auc", auc.scalar())


def roc_auc(
    df: DataFrame, label: str, score: str, keys: list[str] | None = None, edges: Edges | None = None
) -> DataFrame:
    """Area under the ROC curve per group, ties counted half; null with one class only.

    Positives and negatives are counted per distinct score first.
    """
    positive = df.withColumn("_positive", (F.col(label) == 1).cast("int"))
    return auc_of_counts(quality_counts(positive, "_positive", "_positive", keys, score, edges), keys or [])


def class_metrics(df: DataFrame, label: str, prediction: str, keys: list[str] | None = None) -> DataFrame:
    """Support, precision, recall and F1 of every class, per group."""
    return class_metrics_of_counts(quality_counts(df, label, prediction, keys), keys or [])


def class_metrics_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    n, hit = F.col("n"), F.col("_label").eqNullSafe(F.col("_prediction"))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("_label").cast("string").alias("class"),
            n.alias("support"),
            zero.alias("predicted"),
            F.when(hit, n).otherwise(zero).alias("correct"),
        ),
        F.struct(
            F.col("_prediction").cast("string").alias("class"),
            zero.alias("support"),
            n.alias("predicted"),
            zero.alias("correct"),
        ),
    )
    wide = (
        counts.select(*keys, F.inline(sides))
        .where(F.col("class").isNotNull())
        .groupBy(*keys, "class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "correct")])
    )
    c, s, p = F.col("correct"), F.col("support"), F.col("predicted")
    return wide.select(
        *keys,
        "class",
        "support",
        ratio(c, p, when_zero=0.0).alias("precision"),
        ratio(c, s, when_zero=0.0).alias("recall"),
        ratio(2 * c, s + p, when_zero=0.0).alias("f1"),
    )


def averaged_class_metrics(
    df: DataFrame, label: str, prediction: str, keys: list[str] | None = None
) -> DataFrame:
    """Accuracy with macro (plain) and weighted (by support) means of the class metrics."""
    return averages_of_counts(quality_counts(df, label, prediction, keys), keys or [])


def averages_of_counts(counts: DataFrame, keys: list[str]) -> DataFrame:
    s = F.col("support")
    names = ("precision", "recall", "f1")
    return (
        class_metrics_of_counts(counts, keys)
        .groupBy(*keys)
        .agg(
            F.sum("support").alias("n"),
            # recall x support is the number of correct rows of a class
            ratio(F.sum(F.col("recall") * s), F.sum("support")).alias("accuracy"),
            *[F.avg(m).alias(f"macro_{m}") for m in names],
            *[ratio(F.sum(F.col(m) * s), F.sum("support")).alias(f"weighted_{m}") for m in names],
        )
    )


def regression_metrics(df: DataFrame, label: str, prediction: str, keys: list[str] | None = None) -> DataFrame:
    """MAE, RMSE, MAPE (zero labels skipped) and R2 (null for a constant label), per group."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    rows = df.where(y.isNotNull() & p.isNotNull())
    error = y - p
    return (
        rows.groupBy(*(keys or []))
        .agg(
            F.count("*").alias("n"),
            F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("_mse"),
            F.avg(F.when(y != 0, F.abs(error / y))).alias("mape"),
            F.var_pop(y).alias("_variance"),
        )
        .select(
            *(keys or []),
            "n",
            "mae",
            F.sqrt("_mse").alias("rmse"),
            "mape",
            (1 - ratio(F.col("_mse"), F.col("_variance"))).alias("r2"),
        )
    )


def forecast_error_by_horizon(
    df: DataFrame, made_on: str, target_date: str, actual: str, forecast: str, keys: list[str] | None = None
) -> DataFrame:
    """Forecast error by the number of days between making a forecast and its target day."""
    dated = df.withColumn("horizon", F.datediff(target_date, made_on))
    return regression_metrics(dated, actual, forecast, [*(keys or []), "horizon"])


def promotion_gate(candidates: DataFrame, f1: str = "f1", baseline: Column | float = 0.0) -> DataFrame:
    """A candidate is promoted when its F1 is strictly above the baseline's."""
    base = baseline if isinstance(baseline, Column) else F.lit(float(baseline))
    return candidates.select(
        "*",
        base.alias("baseline_f1"),
        improvement(F.col(f1), base).alias("improvement"),
        improvement_percent(F.col(f1), base).alias("improvement_percent"),
        F.coalesce(F.col(f1) > base, F.lit(False)).alias("should_register"),
    )


def champion_challenger(
    df: DataFrame,
    label: str,
    predictions: dict[str, str],
    champion: str,
    challenger: str,
    keys: list[str] | None = None,
) -> DataFrame:
    """Two models on the same rows, metric by metric, from one pass over the data."""
    keys = keys or []
    cells = [
        F.struct(F.lit(model).alias("model_id"), F.col(c).alias("_prediction"))
        for model, c in predictions.items()
    ]
    scored = df.select(*keys, label, F.inline(F.array(*cells)))
    metrics = binary_metrics(scored, label, "_prediction", [*keys, "model_id"])
    names = ["accuracy", "precision", "recall", "f1"]
    long = metrics.select(
        *keys,
        "model_id",
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric_name"), F.col(m).alias("_value")) for m in names])
        ),
    )
    side_by_side = long.groupBy(*keys, "metric_name").pivot("model_id", [champion, challenger]).agg(
        F.max("_value")
    )
    return side_by_side.select(
        *keys,
        "metric_name",
        F.col(champion).alias("champion"),
        F.col(challenger).alias("challenger"),
        (F.col(challenger) - F.col(champion)).alias("difference"),
    )
