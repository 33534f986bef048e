"""Data quality rules, each reported as the share of what it checked that passed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import count_where, ratio
from tidegauge.operators.distribution import (
    approx_edges,
    exact_quantiles,
    numeric_long,
    value_counts,
)
from tidegauge.operators.timeseries import autocorrelation, resample

# The rule names settings files use.
RULES = (
    "null_check", "type_check", "range_check", "cardinality_check", "outlier_check",
    "temporal_consistency", "seasonality_check",
)


@dataclass(frozen=True)
class RowRule:
    """A rule that looks at one row at a time; ``max_failed`` is the share that may fail."""

    rule: str
    column: str
    failed: Column
    checked: Column | None = None
    max_failed: float = 0.0


def null_check(column: str, max_nulls: float = 0.0) -> RowRule:
    return RowRule("null_check", column, F.col(column).isNull(), None, max_nulls)


def type_check(column: str, data_type: str, max_failed: float = 0.0) -> RowRule:
    """Values that are there but cannot be read as the type."""
    present = F.col(column).isNotNull()
    return RowRule("type_check", column, present & F.col(column).try_cast(data_type).isNull(), present, max_failed)


def range_check(column: str, low: float, high: float, max_failed: float = 0.0) -> RowRule:
    present = F.col(column).isNotNull()
    return RowRule("range_check", column, ~F.col(column).between(low, high), present, max_failed)


def baseline_range(baseline: DataFrame, column: str) -> tuple[float, float]:
    """Smallest and greatest baseline value, as bounds for ``range_check``; an error if there is none."""
    row = baseline.agg(F.min(column), F.max(column)).first()
    return _bounds(row, column)


def baseline_fences(
    baseline: DataFrame, column: str, k: float = 1.5, exact: bool = False
) -> tuple[float, float]:
    """Quartiles of the baseline widened by ``k`` interquartile ranges: two numbers on the driver.

    An error if the baseline has no value.
    """
    if exact:
        long = numeric_long(baseline, [], [column], approx_edges(baseline, [column]))
        rows = exact_quantiles(value_counts(long, ["column_name"]), ["column_name"], [0.25, 0.75]).collect()
        found = sorted((r["quantile_value"] for r in rows), key=lambda q: (q is None, q)) or (None, None)
    else:
        number = F.col(column).cast("double")
        known = F.when(~F.isnan(number), number)
        found = baseline.agg(F.percentile_approx(known, [0.25, 0.75], 10_000)).first()[0] or (None, None)
    q1, q3 = _bounds(found, column)
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def _bounds(found, column: str) -> tuple[float, float]:
    low, high = found
    if low is None or high is None:
        raise ValueError(f"empty baseline: no value of {column}")
    return low, high


def outlier_check(column: str, fences: tuple[float, float], max_failed: float = 0.05) -> RowRule:
    present = F.col(column).isNotNull()
    return RowRule("outlier_check", column, ~F.col(column).between(*fences), present, max_failed)


def check_rows(df: DataFrame, rules: list[RowRule], keys: list[str] | None = None) -> DataFrame:
    """All row rules in one pass: checked and failed rows, pass share and verdict per rule.

    A rule that had nothing to check passes.
    """
    keys = keys or []
    aggregates = []
    for i, r in enumerate(rules):
        checked = F.lit(True) if r.checked is None else r.checked
        aggregates += [
            count_where(checked).alias(f"_checked{i}"),
            count_where(checked & r.failed).alias(f"_failed{i}"),
        ]
    rows = [
        F.struct(
            F.lit(r.rule).alias("rule"),
            F.lit(r.column).alias("column_name"),
            F.col(f"_checked{i}").alias("checked"),
            F.col(f"_failed{i}").alias("failed"),
            F.lit(float(r.max_failed)).alias("max_failed"),
        )
        for i, r in enumerate(rules)
    ]
    return _with_verdict(df.groupBy(*keys).agg(*aggregates).select(*keys, F.inline(F.array(*rows))))


def _with_verdict(checks: DataFrame) -> DataFrame:
    share = ratio(F.col("failed"), F.col("checked"), when_zero=0.0)
    return checks.select(
        "*", (1 - share).alias("pass_share"), (share <= F.col("max_failed")).alias("passed")
    )


def cardinality_check(
    df: DataFrame,
    columns: list[str],
    limits: dict[str, tuple[int, int]] | None = None,
    baseline: DataFrame | None = None,
    max_failed: float = 0.0,
) -> DataFrame:
    """Distinct values of each column and the rows whose value the baseline has never had.

    Works on counts per distinct value. ``limits`` bound the number of distinct values;
    a column outside them fails whatever its rows are.
    """
    def counted(table: DataFrame) -> DataFrame:
        cells = [
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
        ]
        long = table.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
        return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))

    counts = counted(df)
    if baseline is None:
        marked = counts.withColumn("_known", F.lit(True))
    else:
        known = counted(baseline).select("column_name", "value", F.lit(True).alias("_known"))
        marked = counts.join(known, ["column_name", "value"], "left")
    unseen = F.col("_known").isNull()
    found = marked.groupBy("column_name").agg(
        F.count("*").alias("distinct_count"),
        count_where(unseen).alias("unseen_values"),
        F.sum("n").alias("checked"),
        F.coalesce(F.sum(F.when(unseen, F.col("n"))), F.lit(0)).alias("failed"),
    )
    inside = F.lit(True)
    for column, (low, high) in (limits or {}).items():
        inside = F.when(F.col("column_name") == column, F.col("distinct_count").between(low, high)).otherwise(inside)
    share = ratio(F.col("failed"), F.col("checked"), when_zero=0.0)
    return found.select(
        F.lit("cardinality_check").alias("rule"),
        "column_name",
        "distinct_count",
        "unseen_values",
        "checked",
        "failed",
        F.lit(float(max_failed)).alias("max_failed"),
        F.when(inside, 1 - share).otherwise(F.lit(0.0)).alias("pass_share"),
        (inside & (share <= max_failed)).alias("passed"),
    )


def unseen_values(df: DataFrame, baseline: DataFrame, column: str) -> DataFrame:
    """Distinct values the baseline does not have, with their rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.join(baseline.select(column).distinct(), column, "left_anti")


def temporal_consistency(
    df: DataFrame,
    timestamp_col: str,
    frequency: str,
    series: list[str] | None = None,
    max_failed: float = 0.0,
) -> DataFrame:
    """Missing periods and repeated timestamps of each series, from one count per timestamp."""
    series = series or []
    stamps = (
        df.where(F.col(timestamp_col).isNotNull())
        .groupBy(*series, timestamp_col)
        .agg(F.count("*").alias("_n"))
    )
    regular = resample(stamps, timestamp_col, frequency, {"_repeats": F.sum(F.col("_n") - 1)}, series)
    found = regular.groupBy(*series).agg(
        F.count("*").alias("checked"),
        count_where(F.col("n") == 0).alias("failed"),
        F.sum("_repeats").alias("duplicate_timestamps"),
    )
    return _with_verdict(
        found.select(
            *series,
            F.lit("temporal_consistency").alias("rule"),
            F.lit(timestamp_col).alias("column_name"),
            "checked",
            "failed",
            "duplicate_timestamps",
            F.lit(float(max_failed)).alias("max_failed"),
        )
    )


def seasonality_check(
    series_table: DataFrame,
    time_col: str,
    value_col: str,
    lag: int = 7,
    minimum: float = 0.0,
    series: list[str] | None = None,
) -> DataFrame:
    """Autocorrelation at a season's length, per series, against a least value.

    Takes a resampled series: one row per period.
    """
    found = autocorrelation(series_table, time_col, value_col, lag, series)
    enough = F.col("autocorrelation") >= minimum
    return found.select(
        *(series or []),
        F.lit("seasonality_check").alias("rule"),
        F.lit(value_col).alias("column_name"),
        F.col("pairs").alias("checked"),
        "autocorrelation",
        F.when(enough, 1.0).otherwise(0.0).alias("pass_share"),
        F.coalesce(enough, F.lit(False)).alias("passed"),
    )


# What every rule reports, whatever else it has to say.
VERDICT = ["rule", "column_name", "checked", "pass_share", "passed"]


def combined_checks(checks: list[DataFrame], keys: list[str] | None = None) -> DataFrame:
    """The verdicts of any rules as one table, for a score over all of them."""
    shown = [c.select(*(keys or []), *VERDICT) for c in checks]
    return reduce(lambda a, b: a.unionByName(b), shown)


def checks_named(names: tuple[str, ...], available: dict[str, DataFrame]) -> DataFrame:
    """The checks that a template's rules ask for; a name that is no rule is an error."""
    unknown = [n for n in names if n not in RULES]
    if unknown:
        raise ValueError(f"Unknown data quality rules: {', '.join(unknown)}")
    return combined_checks([available[n] for n in names])


def quality_score(checks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Mean pass share over the rules, between 0 and 1."""
    return checks.groupBy(*(keys or [])).agg(
        F.count("*").alias("n_rules"),
        count_where(F.col("passed")).alias("n_passed"),
        F.avg("pass_share").alias("data_quality_score"),
    )
