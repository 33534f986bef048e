"""Features, labels and what their join loses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where


def select_features(features: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """Key first, then the requested columns; the key is not repeated."""
    if not columns:
        return features
    return features.select(key, *[c for c in columns if c != key])


def select_label(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.select(key, label)


def join_labels(features: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Inner join on one key, which appears once.

    No broadcast hint: both sides grow with the data. Adaptive execution broadcasts a
    side it has measured to be small and splits the partition of a key that holds far
    more rows than the others.
    """
    return features.join(select_label(labels, key, label), on=key, how="inner")


def key_audit(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows per key on both sides, one row per key.

    Both sides are reduced to one row per key before they meet, so a key with a third of
    all rows costs one row in the join.
    """
    f = features.groupBy(key).agg(F.count("*").alias("feature_rows"))
    l = labels.groupBy(key).agg(F.count("*").alias("label_rows"))
    return f.join(l, on=key, how="full").fillna(0, ["feature_rows", "label_rows"])


def join_loss(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """What an inner join on ``key`` would keep and lose, without running it.

    ``row_difference`` (features minus joined rows) can hide a loss behind repeated
    label keys; ``unmatched_rows`` cannot. A null key never matches.
    """
    n_f, n_l = F.col("feature_rows"), F.col("label_rows")
    matched = F.col(key).isNotNull() & (n_l > 0)
    totals = key_audit(features, labels, key).agg(
        F.coalesce(F.sum(n_f), F.lit(0)).alias("feature_count"),
        F.coalesce(F.sum(n_l), F.lit(0)).alias("label_count"),
        F.coalesce(F.sum(F.when(matched, n_f * n_l)), F.lit(0)).alias("joined_count"),
        F.coalesce(F.sum(F.when(~matched, n_f)), F.lit(0)).alias("unmatched_rows"),
        count_where(F.col(key).isNotNull() & (n_l > 1)).alias("duplicate_label_keys"),
    )
    lost = F.col("feature_count") - F.col("joined_count")
    return totals.select(
        "*", lost.alias("row_difference"), (F.col("unmatched_rows") > 0).alias("warn")
    )


def key_coverage(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Distinct keys on each side and how many are on one side only."""
    n_f, n_l = F.col("feature_rows") > 0, F.col("label_rows") > 0
    return key_audit(features, labels, key).where(F.col(key).isNotNull()).agg(
        count_where(n_f).alias("feature_keys"),
        count_where(n_l).alias("label_keys"),
        count_where(n_f & n_l).alias("shared_keys"),
        count_where(n_f & ~n_l).alias("keys_missing_labels"),
        count_where(~n_f & n_l).alias("keys_missing_features"),
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks; null counts as a key."""
    return left.select(key).subtract(right.select(key))


def rows_without_label(features: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Whole feature rows whose key has no label; rows with a null key are among them."""
    return features.join(distinct_keys(labels, key), on=key, how="left_anti")


def feature_columns(df: DataFrame, target: str, exclude: tuple[str, ...] = ()) -> list[str]:
    """All columns but the target and the excluded ones, in order."""
    if target not in df.columns:
        raise ValueError(f"Target column '{target}' not found")
    return [c for c in df.columns if c != target and c not in exclude]
