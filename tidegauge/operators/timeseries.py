"""Regular series: resampling, gaps, lags, rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# The frequency names, as date_trunc unit and calendar step.
FREQUENCIES = {
    "hourly": ("hour", "INTERVAL 1 HOUR"),
    "daily": ("day", "INTERVAL 1 DAY"),
    "weekly": ("week", "INTERVAL 7 DAYS"),
    "monthly": ("month", "INTERVAL 1 MONTH"),
}
# Seconds of a period at most.
LONGEST_PERIOD = {"hourly": 3600, "daily": 86400, "weekly": 604800, "monthly": 31 * 86400}
#: Periods in a part of a long series.
PART_PERIODS = 10_000
DEFAULT_LAGS = (1, 7, 14, 28)
DEFAULT_ROLLING = (7, 14, 28)


def period_of(column: str, frequency: str) -> Column:
    """Start of the period a time falls into."""
    if frequency not in FREQUENCIES:
        raise ValueError(f"Unknown frequency: {frequency}")
    return F.date_trunc(FREQUENCIES[frequency][0], F.col(column).cast("timestamp")).cast("timestamp_ntz")


def _ordered(time_col: str, series: list[str] | None):
    return Window.partitionBy(*(series or [])).orderBy(time_col)


def with_gaps(periods: DataFrame, frequency: str, series: list[str]) -> DataFrame:
    """Add the periods between one row of a series and its next; ``in_gap`` marks them.

    Takes one row per series and period, which is what the running order is kept over.
    """
    step = FREQUENCIES[frequency][1]
    following = F.lead("period").over(_ordered("period", series))
    others = [c for c in periods.columns if c != "period"]
    return (
        periods.withColumn("_next", following)
        .withColumn("_last", F.expr(f"coalesce(_next - {step}, period)"))
        .select(
            *others,
            F.col("period").alias("_own"),
            F.explode(F.expr(f"sequence(period, _last, {step})")).alias("period"),
        )
        .select(*others, "period", (F.col("period") > F.col("_own")).alias("in_gap"))
    )


def resample(
    df: DataFrame,
    timestamp_col: str,
    frequency: str,
    aggregates: dict[str, Column],
    series: list[str] | None = None,
    fill: float | None = None,
) -> DataFrame:
    """Aggregate to regular periods, with rows for the periods that have no data.

    ``n`` counts the rows of a period; in a gap it is 0 and the aggregates are ``fill``.
    A series runs from its first to its last period.
    """
    series = series or []
    filled = (
        df.where(F.col(timestamp_col).isNotNull())
        .groupBy(*series, period_of(timestamp_col, frequency).alias("period"))
        .agg(F.count("*").alias("n"), *[a.alias(n) for n, a in aggregates.items()])
    )
    return with_gaps(filled, frequency, series).select(
        *series,
        "period",
        F.when(F.col("in_gap"), 0).otherwise(F.col("n")).alias("n"),
        *[F.when(F.col("in_gap"), F.lit(fill)).otherwise(F.col(a)).alias(a) for a in aggregates],
    )


def missing_periods(
    df: DataFrame, timestamp_col: str, frequency: str, series: list[str] | None = None
) -> DataFrame:
    return resample(df, timestamp_col, frequency, {}, series).where(F.col("n") == 0).drop("n")


def _in_parts(regular: DataFrame, time_col: str, frequency: str, reach: int) -> DataFrame:
    """A regular series cut by time into parts, each with the ``reach`` periods before it.

    ``_part`` says which part a row is computed in; in the part a row belongs to ``_own`` is true.
    """
    if frequency not in LONGEST_PERIOD:
        raise ValueError(f"Unknown frequency: {frequency}")
    step = LONGEST_PERIOD[frequency]
    width = max(PART_PERIODS, reach) * step
    at = F.unix_seconds(F.col(time_col).cast("timestamp"))
    part = F.floor(at / width)
    own = F.struct(part.alias("_part"), F.lit(True).alias("_own"))
    next_ = F.struct((part + 1).alias("_part"), F.lit(False).alias("_own"))
    return regular.select("*", F.inline(F.when(at >= (part + 1) * width - reach * step, F.array(own, next_)).otherwise(F.array(own))))


def _over_series(
    regular: DataFrame, time_col: str, series: list[str] | None, frequency: str | None, reach: int, features
) -> DataFrame:
    """``regular`` with the columns that ``features`` makes of a window specification, in parts where the frequency is given."""
    if frequency is None:
        return regular.select("*", *features(_ordered(time_col, series)))
    parts = _in_parts(regular, time_col, frequency, reach)
    found = parts.select("*", *features(_ordered(time_col, [*(series or []), "_part"])))
    return found.where("_own").drop("_part", "_own")


def lag_features(
    regular: DataFrame,
    time_col: str,
    value_col: str,
    lags: tuple[int, ...] = DEFAULT_LAGS,
    series: list[str] | None = None,
    frequency: str | None = None,
) -> DataFrame:
    """Earlier values of a regular series as columns ``<value>_lag_<k>``.

    With the ``frequency`` of the series its parts are computed side by side, each with an overlap
    of the longest lag, so that one long series is not one task.
    """
    return _over_series(
        regular, time_col, series, frequency, max(lags, default=0),
        lambda order: [F.lag(value_col, k).over(order).alias(f"{value_col}_lag_{k}") for k in lags],
    )


def rolling_features(
    regular: DataFrame,
    time_col: str,
    value_col: str,
    windows: tuple[int, ...] = DEFAULT_ROLLING,
    series: list[str] | None = None,
    frequency: str | None = None,
) -> DataFrame:
    """Mean, extremes and deviation over the last ``k`` periods, the current one included.

    With the ``frequency`` of the series its parts are computed side by side, see :func:`lag_features`.
    """

    def features(order) -> list[Column]:
        columns = []
        for k in windows:
            last = order.rowsBetween(-(k - 1), Window.currentRow)
            columns += [
                F.avg(value_col).over(last).alias(f"{value_col}_avg_{k}"),
                F.min(value_col).over(last).alias(f"{value_col}_min_{k}"),
                F.max(value_col).over(last).alias(f"{value_col}_max_{k}"),
                F.stddev(value_col).over(last).alias(f"{value_col}_stddev_{k}"),
            ]
        return columns

    return _over_series(regular, time_col, series, frequency, max(windows, default=1) - 1, features)


def autocorrelation(
    regular: DataFrame, time_col: str, value_col: str, lag: int = 7, series: list[str] | None = None
) -> DataFrame:
    lagged = lag_features(regular, time_col, value_col, (lag,), series)
    earlier = F.col(f"{value_col}_lag_{lag}")
    both = F.col(value_col).isNotNull() & earlier.isNotNull()
    return lagged.groupBy(*(series or [])).agg(
        F.count(F.when(both, True)).alias("pairs"), F.corr(value_col, earlier).alias("autocorrelation")
    )


def logging_frequency(
    df: DataFrame, timestamp_col: str, frequency: str, series: list[str] | None = None
) -> DataFrame:
    """Rows per period, empty periods, and the longest silence in seconds.

    One scan. Equal times are added up before the shuffle, so a second has a million rows at
    most however dense the log is. Each stretch keeps its first and last time and its longest
    silence; stretches are joined at their borders, seconds to minutes, minutes to periods.
    """
    series = series or []
    times = (
        df.where(F.col(timestamp_col).isNotNull())
        .groupBy(
            *series,
            period_of(timestamp_col, frequency).alias("period"),
            F.unix_micros(F.col(timestamp_col).cast("timestamp")).alias("_first"),
        )
        .agg(F.count("*").alias("n_rows"))
        .select("*", F.col("_first").alias("_last"), F.lit(0).cast("long").alias("_gap"))
        .withColumn("_second", F.floor(F.col("_first") / 1_000_000))
        .withColumn("_minute", F.floor(F.col("_second") / 60))
    )
    periods = times
    for keys in (["period", "_minute", "_second"], ["period", "_minute"], ["period"]):
        periods = _joined(periods, [*series, *keys])
    skipped = F.expr(f"size(sequence(_earlier, period, {FREQUENCIES[frequency][1]})) - 2")
    spans = _with_silence_before(periods, series).withColumn(
        "_earlier", F.lag("period").over(_ordered("period", series))
    )
    return (
        spans.groupBy(*series)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.count("*").alias("_filled"),
            F.coalesce(F.sum(skipped), F.lit(0)).alias("empty_periods"),
            (F.max("_gap") / 1e6).alias("longest_gap_seconds"),
        )
        .select(
            *series,
            "n_rows",
            (F.col("_filled") + F.col("empty_periods")).alias("periods"),
            "empty_periods",
            (F.col("n_rows") / (F.col("_filled") + F.col("empty_periods"))).alias("rows_per_period"),
            "longest_gap_seconds",
        )
    )


def _joined(stretches: DataFrame, keys: list[str]) -> DataFrame:
    """The stretches of a group as one: its rows, first and last time, and longest silence."""
    return (
        _with_silence_before(stretches, keys)
        .groupBy(*keys)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
            F.max("_gap").alias("_gap"),
        )
    )


def _with_silence_before(stretches: DataFrame, keys: list[str]) -> DataFrame:
    before = F.lag("_last").over(_ordered("_first", keys))
    return stretches.withColumn("_gap", F.greatest("_gap", F.col("_first") - before))
