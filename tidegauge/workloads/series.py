"""Regular series: resampling, features, gaps, forecast error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import timeseries as ts
from tidegauge.operators.performance import forecast_error_by_horizon as error_by_horizon
from tidegauge.workloads.bindings import SERIES, daily_orders, rounded, table
from tidegauge.workloads.registry import workload

PRIORITY = ["o_orderpriority"]
# Means can end in a 5 behind the last digit kept; both sides are moved off that tie.
NUDGE = 1e-9


@workload(f"WITH {SERIES} SELECT o_orderpriority, period, n, round(total, 4) AS total FROM series")
def resample_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily_orders(spark, sf_dir), "total", digits=4)


def resampled_sql(unit: str, step: str) -> str:
    return f"""
WITH f AS (SELECT date_trunc('{unit}', ts)::TIMESTAMP AS period, count(*) AS n, avg(value) AS value FROM events GROUP BY 1),
d AS (SELECT unnest(generate_series((SELECT min(period) FROM f), (SELECT max(period) FROM f), INTERVAL {step})) AS period)
SELECT d.period, coalesce(n, 0) AS n, round(value, 6) AS value FROM d LEFT JOIN f ON d.period = f.period"""


def _resampled_events(spark, sf_dir, frequency):
    events = table(spark, sf_dir, "events")
    return rounded(ts.resample(events, "ts", frequency, {"value": F.avg("value")}), "value")


@workload(resampled_sql("hour", "1 HOUR"))
def resample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resampled_events(spark, sf_dir, "hourly")


@workload(resampled_sql("week", "7 DAY"))
def resample_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resampled_events(spark, sf_dir, "weekly")


@workload("""
WITH f AS (SELECT l_returnflag, date_trunc('month', l_shipdate)::TIMESTAMP AS period, count(*) AS n,
                  sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL),
d AS (SELECT l_returnflag, unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS period FROM f GROUP BY 1)
SELECT d.l_returnflag, d.period, coalesce(n, 0) AS n, quantity
FROM d LEFT JOIN f ON d.l_returnflag = f.l_returnflag AND d.period = f.period""")
def resample_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return ts.resample(lines, "l_shipdate", "monthly", {"quantity": F.sum("l_quantity")}, ["l_returnflag"])


@workload(f"""
WITH {SERIES}
SELECT o_orderpriority, period, n, round(total, 4) AS total,
       {', '.join(f'round(lag(total, {k}) OVER w, 4) AS total_lag_{k}' for k in ts.DEFAULT_LAGS)}
FROM series WINDOW w AS (PARTITION BY o_orderpriority ORDER BY period)""")
def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ts.lag_features(daily_orders(spark, sf_dir), "period", "total", series=PRIORITY)
    return rounded(found, "total", *[f"total_lag_{k}" for k in ts.DEFAULT_LAGS], digits=4)


def _rolling_sql(k: int) -> str:
    frame = f"OVER (PARTITION BY o_orderpriority ORDER BY period ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    names = {"avg": "avg", "min": "min", "max": "max", "stddev": "stddev_samp"}
    return ", ".join(
        f"round({f}(total) {frame}, {2 if m == 'stddev' else 4}) AS total_{m}_{k}" for m, f in names.items()
    )


@workload(f"""
WITH {SERIES}
SELECT o_orderpriority, period, n, round(total, 4) AS total, {', '.join(_rolling_sql(k) for k in ts.DEFAULT_ROLLING)}
FROM series""")
def rolling_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ts.rolling_features(daily_orders(spark, sf_dir), "period", "total", series=PRIORITY)
    plain = [f"total_{m}_{k}" for k in ts.DEFAULT_ROLLING for m in ("avg", "min", "max")]
    found = rounded(found, "total", *plain, digits=4)
    return rounded(found, *[f"total_stddev_{k}" for k in ts.DEFAULT_ROLLING], digits=2)


ONE_SERIES = (24, 168)


@workload(f"""
WITH f AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS period, count(*) AS n, sum(value) AS total FROM events GROUP BY 1),
d AS (SELECT unnest(generate_series((SELECT min(period) FROM f), (SELECT max(period) FROM f), INTERVAL 1 HOUR)) AS period),
series AS (SELECT d.period, coalesce(n, 0) AS n, coalesce(total, 0) AS total FROM d LEFT JOIN f ON d.period = f.period)
SELECT period, n, round(total, 4) AS total, round(lag(total, 24) OVER (ORDER BY period), 4) AS total_lag_24,
       {', '.join(f'round({f}(total) OVER (ORDER BY period ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW) + {NUDGE}, 4) AS total_{f}_{k}' for k in ONE_SERIES for f in ('avg', 'min', 'max'))}
FROM series""")
def rolling_features_one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of all events as one series, its features computed in parts of time that overlap."""
    hourly = ts.resample(table(spark, sf_dir, "events"), "ts", "hourly", {"total": F.sum("value")}, fill=0.0)
    lagged = ts.lag_features(hourly, "period", "total", (24,), frequency="hourly")
    found = ts.rolling_features(lagged, "period", "total", ONE_SERIES, frequency="hourly")
    found = found.drop(*[f"total_stddev_{k}" for k in ONE_SERIES])
    found = found.withColumns({c: F.col(c) + NUDGE for c in found.columns if c.startswith("total_") and "lag" not in c})
    return rounded(found, *[c for c in found.columns if c.startswith("total")], digits=4)


@workload("""
WITH f AS (SELECT DISTINCT l_suppkey, date_trunc('day', l_shipdate)::TIMESTAMP AS period FROM lineitem),
d AS (SELECT l_suppkey, unnest(generate_series(min(period), max(period), INTERVAL 1 DAY)) AS period FROM f GROUP BY 1)
SELECT l_suppkey, period FROM d EXCEPT SELECT l_suppkey, period FROM f""")
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which a supplier shipped nothing, between its first line and its last."""
    return ts.missing_periods(table(spark, sf_dir, "lineitem"), "l_shipdate", "daily", ["l_suppkey"])


@workload("""
WITH p AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS period, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT event_type, sum(n)::BIGINT AS n_rows, date_diff('hour', min(period), max(period)) + 1 AS periods,
             count(*) AS filled FROM p GROUP BY 1),
g AS (SELECT event_type, max(gap) / 1e6 AS longest_gap_seconds FROM (
        SELECT event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts) AS gap FROM events)
      GROUP BY 1)
SELECT event_type, n_rows, periods, periods - filled AS empty_periods, round(n_rows / periods, 6) AS rows_per_period,
       round(longest_gap_seconds, 6) AS longest_gap_seconds
FROM s JOIN g USING (event_type)""")
def logging_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ts.logging_frequency(table(spark, sf_dir, "events"), "ts", "hourly", ["event_type"])
    return rounded(found, "rows_per_period", "longest_gap_seconds")


@workload(f"""
WITH {SERIES},
f AS ({' UNION ALL '.join(f"SELECT o_orderpriority, {h} AS horizon, total AS y, lag(total, {h}) OVER (PARTITION BY o_orderpriority ORDER BY period) AS p FROM series" for h in range(1, 8))})
SELECT horizon, count(*) AS n, round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) ** 2)), 3) AS rmse,
       round(avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END), 3) AS mape,
       round(1 - avg((y - p) ** 2) / var_pop(y), 3) AS r2
FROM f WHERE p IS NOT NULL GROUP BY horizon""")
def forecast_error_by_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error of "as it was h days earlier" as a forecast for one to seven days."""
    horizons = tuple(range(1, 8))
    lagged = ts.lag_features(daily_orders(spark, sf_dir), "period", "total", horizons, PRIORITY)
    forecasts = lagged.select(
        "total",
        "period",
        F.inline(
            F.array(
                *[
                    F.struct(
                        (F.col("period") - F.expr(f"INTERVAL {h} DAYS")).alias("made_on"),
                        F.col(f"total_lag_{h}").alias("forecast"),
                    )
                    for h in horizons
                ]
            )
        ),
    )
    found = error_by_horizon(forecasts, "made_on", "period", "total", "forecast")
    return rounded(found, "mae", "rmse", "mape", "r2", digits=3)
