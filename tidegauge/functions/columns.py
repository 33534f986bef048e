"""Column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, when_zero: float | None = None) -> Column:
    """``numerator / denominator`` with a stated result (null by default) for a zero denominator."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(when_zero).cast("double"))


def count_where(condition: Column) -> Column:
    """How many rows meet a condition; 0, not null, for an empty group."""
    return F.count(F.when(condition, True))


def quoted(name: str) -> str:
    """A column name for use inside a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal for use inside a SQL expression."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on group keys in which null is a group of its own.

    A null model or slice means "no model given" or "the whole table" and must meet its
    equal on the other side. Keys that cannot be null use plain equality, so their
    existing partitioning is reused.
    """
    renamed = right.select(
        *[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns]
    )

    def same(key: str) -> Column:
        ours, theirs = left[key], renamed[f"_right_{key}"]
        if left.schema[key].nullable or renamed.schema[f"_right_{key}"].nullable:
            return ours.eqNullSafe(theirs)
        return ours == theirs

    joined = left.join(renamed, reduce(lambda a, b: a & b, [same(k) for k in keys]), how)
    return joined.drop(*[f"_right_{k}" for k in keys])
