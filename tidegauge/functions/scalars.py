"""Scalar expressions: names, URIs, recency, texts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F



def as_date(as_of: str | dt.date | Column | None) -> Column:
    """The day a report is made for; the current day when none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)[:10]).cast("date")


def is_recent(column: str, days: int, as_of: str | dt.date | Column | None = None) -> Column:
    """``column >= as_of - days``, bound included; the column stays bare so it can be pushed down."""
    return F.col(column) >= F.date_sub(as_date(as_of), days)


def full_name(catalog: Column | str, schema: Column | str, name: Column | str) -> Column:
    parts = [F.lit(p) if isinstance(p, str) else p for p in (catalog, schema, name)]
    return F.concat_ws(".", *parts)


def flat_name(name: Column) -> Column:
    """``a.b.c`` to ``a_b_c``."""
    return F.replace(name, F.lit("."), F.lit("_"))


def model_uri(name: Column, version: Column | None = None, alias: Column | None = None) -> Column:
    """URI by alias or by version; the alias wins when both are there."""
    if version is None and alias is None:
        raise ValueError("Either version or alias must be provided")
    by_version = F.concat(F.lit("models:/"), name, F.lit("/"), version) if version is not None else None
    if alias is None:
        return by_version
    by_alias = F.concat(F.lit("models:/"), name, F.lit("@"), alias)
    return by_alias if by_version is None else F.when(alias.isNotNull(), by_alias).otherwise(by_version)


def version_number(version: Column) -> Column:
    """Versions are numeric strings of up to 38 digits and compare as numbers: "10" comes after "9"."""
    return version.try_cast("decimal(38,0)")


def improvement(value: Column, baseline: Column) -> Column:
    return value - baseline


def improvement_percent(value: Column, baseline: Column) -> Column:
    return F.when(baseline > 0, (value - baseline) / baseline * 100).otherwise(F.lit(0.0))


def violation_line(column: Column, score: Column, drift_type: Column) -> Column:
    # fixed value: the format of a line
    return F.format_string("  - %s: %.4f (%s)", column, score, drift_type)


def alert_subject(environment: str | Column, n_columns: Column) -> Column:
    env = F.lit(environment) if isinstance(environment, str) else environment
    # fixed value: the format of a subject
    return F.format_string("[%s] Prediction Drift Alert - %d columns", F.upper(env), n_columns)


def model_description(trained_on: Column, f1: Column, accuracy: Column) -> Column:
    """Registration text; missing metrics count as 0."""
    zero = F.lit(0.0)
    return F.format_string(
        "Model trained on %s with F1=%.4f, Accuracy=%.4f",
        F.date_format(trained_on, "yyyy-MM-dd"),
        F.coalesce(f1, zero),
        F.coalesce(accuracy, zero),
    )


__all__ = [
    "alert_subject", "as_date", "flat_name", "full_name", "improvement", "improvement_percent",
    "is_recent", "model_description", "model_uri", "version_number", "violation_line",
]
