"""Seeded train and test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The resolution of the split and its defaults.
BUCKETS = 1_000_000
DEFAULT_TEST_SIZE = 0.2
DEFAULT_SEED = 42


def check_test_size(test_size: float) -> None:
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must be between 0 and 1, got {test_size}")


def is_test_row(key: Column, test_size: float, seed: int) -> Column:
    """A hash of seed and key decides; the same row falls on the same side however it is partitioned."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % BUCKETS
    return bucket < round(test_size * BUCKETS)


def flag_test_rows(
    df: DataFrame, key: str, test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED
) -> DataFrame:
    """The table with an ``is_test`` column: both parts in one pass, without a shuffle."""
    check_test_size(test_size)
    return df.withColumn("is_test", F.coalesce(is_test_row(F.col(key), test_size, seed), F.lit(False)))


def split_train_test(
    df: DataFrame, test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts with all columns kept.

    Without a key the split falls back to ``randomSplit``, which depends on how the
    rows are partitioned.
    """
    check_test_size(test_size)
    if key is None:
        train, test = df.randomSplit([1.0 - test_size, test_size], seed=seed)
        return train, test
    flagged = flag_test_rows(df, key, test_size, seed)
    return (
        flagged.where(~F.col("is_test")).drop("is_test"),
        flagged.where(F.col("is_test")).drop("is_test"),
    )
