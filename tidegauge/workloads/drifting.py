"""Drift of columns and predictions, drift reports and alerts."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import alerts
from tidegauge.operators import drift as dr
from tidegauge.operators.distribution import exact_edges
from tidegauge.operators.performance import regression_metrics
from tidegauge.operators.profile import summary
from tidegauge.operators.quality import check_rows, outlier_check, quality_score, range_check
from tidegauge.operators.windows import grouped_rows
from tidegauge.spec import AlertRule, MonitorSpec
from tidegauge.workloads.bindings import (
    AS_OF,
    BASE,
    LOG,
    PRICED,
    SERIES,
    baseline,
    daily_orders,
    inference_log,
    log_spec,
    monitored,
    priced_lines,
    rounded,
    table,
)
from tidegauge.workloads.registry import workload

DAY = "time_bucket(INTERVAL '1 day', timestamp)"

# w(window_start, v) against b(v): every window with every cell of either side
PAIRED = """
wc AS (SELECT window_start, v, count(*) AS n FROM w WHERE v IS NOT NULL GROUP BY ALL),
bc AS (SELECT v, count(*) AS n FROM b WHERE v IS NOT NULL GROUP BY ALL),
cells AS (
  SELECT window_start, v FROM (SELECT DISTINCT window_start FROM wc) CROSS JOIN (SELECT v FROM bc)
  UNION SELECT window_start, v FROM wc),
paired AS (
  SELECT c.window_start, c.v, coalesce(wc.n, 0) AS o, coalesce(bc.n, 0) / (SELECT sum(n) FROM bc) AS p,
         coalesce(wc.n, 0) / sum(wc.n) OVER (PARTITION BY c.window_start) AS q,
         sum(wc.n) OVER (PARTITION BY c.window_start) AS total, (SELECT count(*) FROM bc) AS k
  FROM cells c LEFT JOIN wc ON c.window_start = wc.window_start AND c.v = wc.v LEFT JOIN bc ON c.v = bc.v)"""

TV = "sum(abs(p - q)) / 2"
PSI = "sum((greatest(q, 1e-4) - greatest(p, 1e-4)) * ln(greatest(q, 1e-4) / greatest(p, 1e-4)))"
JS = """sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
          + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0))"""
CHI2 = "sum(CASE WHEN p > 0 THEN (o - p * total) ** 2 / (p * total) END)"
CRAMER = f"sqrt({CHI2} / (max(total) * (max(k) - 1)))"

EVENT_TYPES = f"""{BASE},
w AS (SELECT {DAY} AS window_start, event_type AS v FROM live),
b AS (SELECT event_type AS v FROM base), {PAIRED}"""


def _daily_categories(spark, sf_dir, **options) -> DataFrame:
    return dr.categorical_drift(
        monitored(spark, sf_dir), log_spec(), ["event_type"], baseline(spark, sf_dir), **options
    )


def _scores(measured: DataFrame, score: str) -> DataFrame:
    """Drift table rows as stored, with the rounded score."""
    columns = ["column_name", "drift_type", "drift_score", "window_start", "window_end"]
    return rounded(dr.drift_table(measured, score).select(*columns), "drift_score")


def score_sql(name: str, measure: str, drift_type: str = "baseline", source: str = "paired") -> str:
    return f"""SELECT '{name}' AS column_name, '{drift_type}' AS drift_type, round({measure}, 6) AS drift_score,
       window_start, window_start + INTERVAL 1 DAY AS window_end
FROM {source} GROUP BY window_start"""


@workload(f"WITH {EVENT_TYPES} {score_sql('event_type', TV)}")
def drift_tv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(_daily_categories(spark, sf_dir), "total_variation")


@workload(f"""
WITH {EVENT_TYPES}
SELECT window_start, round({JS}, 6) AS jensen_shannon FROM paired GROUP BY window_start""")
def drift_js(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_daily_categories(spark, sf_dir).select("window_start", "jensen_shannon"), "jensen_shannon")


@workload(f"""
WITH {EVENT_TYPES}
SELECT window_start, round({CHI2}, 6) AS chi_square, round({CRAMER}, 6) AS cramers_v
FROM paired GROUP BY window_start""")
def drift_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _daily_categories(spark, sf_dir).select("window_start", "chi_square", "cramers_v")
    return rounded(found, "chi_square", "cramers_v")


@workload(f"""
WITH {EVENT_TYPES}
SELECT window_start, round({PSI}, 6) AS psi FROM paired GROUP BY window_start""")
def drift_psi_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_daily_categories(spark, sf_dir).select("window_start", "psi"), "psi")


KS = f"""
grid AS (
  SELECT window_start, value FROM (SELECT DISTINCT {DAY} AS window_start FROM live)
  CROSS JOIN (SELECT DISTINCT value FROM log)),
wn AS (SELECT {DAY} AS window_start, value, count(*) AS n FROM live GROUP BY ALL),
bn AS (SELECT value, count(*) AS n FROM base GROUP BY ALL),
cdf AS (
  SELECT g.window_start,
         sum(coalesce(wn.n, 0)) OVER (PARTITION BY g.window_start ORDER BY g.value) / sum(wn.n) OVER (PARTITION BY g.window_start) AS q,
         sum(coalesce(bn.n, 0)) OVER (PARTITION BY g.window_start ORDER BY g.value) / sum(bn.n) OVER (PARTITION BY g.window_start) AS p
  FROM grid g LEFT JOIN wn ON g.window_start = wn.window_start AND g.value = wn.value
  LEFT JOIN bn ON g.value = bn.value)"""


@workload(f"WITH {BASE}, {KS} {score_sql('value', 'max(abs(p - q))', source='cdf')}")
def drift_ks_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kolmogorov-Smirnov over every distinct value."""
    found = dr.exact_numeric_drift(
        monitored(spark, sf_dir), log_spec(), ["value"], baseline(spark, sf_dir)
    )
    return _scores(found, "ks")


DECILES = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
VALUE_BINS = f"""{BASE},
e AS (SELECT list_sort(list_distinct(quantile_cont(value, {DECILES}))) AS edges FROM base),
w AS (SELECT {DAY} AS window_start, len(list_filter((SELECT edges FROM e), lambda x: value >= x)) AS v FROM live),
b AS (SELECT len(list_filter((SELECT edges FROM e), lambda x: value >= x)) AS v FROM base), {PAIRED}"""


def _daily_deciles(spark, sf_dir, *measures):
    base = baseline(spark, sf_dir)
    edges = exact_edges(base, ["value"], 10)
    return dr.numeric_drift(monitored(spark, sf_dir), log_spec(), ["value"], base, edges=edges, measures=measures)


@workload(f"""
WITH {VALUE_BINS}
SELECT window_start, round({PSI}, 6) AS psi, round({TV}, 6) AS total_variation
FROM paired GROUP BY window_start""")
def drift_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population stability over the decile bins of the baseline."""
    found = _daily_deciles(spark, sf_dir, "psi", "total_variation")
    found = found.select("window_start", "psi", "total_variation")
    return rounded(found, "psi", "total_variation")


@workload(f"""
WITH {VALUE_BINS},
steps AS (
  SELECT window_start, v, sum(p) OVER (PARTITION BY window_start ORDER BY v) AS fp,
         sum(q) OVER (PARTITION BY window_start ORDER BY v) AS fq FROM paired)
SELECT window_start, round(max(abs(fp - fq)), 6) AS ks,
       round(sum(abs(fp - fq) * coalesce((SELECT edges FROM e)[v + 2] - (SELECT edges FROM e)[v + 1], 0)), 6) AS wasserstein
FROM steps GROUP BY window_start""")
def drift_wasserstein(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the binned distribution functions."""
    found = _daily_deciles(spark, sf_dir, "ks", "wasserstein")
    found = found.select("window_start", "ks", "wasserstein")
    return rounded(found, "ks", "wasserstein")


LINE_EDGES = {
    "l_quantity": [float(x) for x in range(2, 50)],
    "l_extendedprice": [1000.0 * x for x in range(1, 100)],
    "l_discount": [0.005 + 0.01 * x for x in range(10)],
    "l_tax": [0.005 + 0.01 * x for x in range(8)],
}
LINE_EDGE_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, unnest([{', '.join(map(repr, e))}]) AS edge" for c, e in LINE_EDGES.items()
)


LINES = f"""lines AS (
  SELECT l_returnflag AS model_id, time_bucket(INTERVAL '30 days', l_shipdate, TIMESTAMP '1970-01-01') AS window_start,
         l_shipdate < TIMESTAMP '1996-01-01' AS old, {', '.join(f'{c}::DOUBLE AS {c}' for c in LINE_EDGES)} FROM lineitem),
cells AS (UNPIVOT lines ON {', '.join(LINE_EDGES)} INTO NAME column_name VALUE v)"""
LINE_MEASURES = [*dr.ORDER_MEASURES, *dr.SHARE_MEASURES]


def _lines_and_baseline(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "timestamp")
    cut = F.lit("1996-01-01").cast("timestamp_ntz")
    spec = MonitorSpec(granularities=("30 days",), model_id_col="l_returnflag", numeric_cols=tuple(LINE_EDGES), categorical_cols=())
    return lines.where(F.col("timestamp") >= cut), lines.where(F.col("timestamp") < cut), spec


@workload(f"""
WITH edges AS ({LINE_EDGE_ROWS}),
el AS (SELECT column_name, list(edge ORDER BY edge) AS e FROM edges GROUP BY column_name),
{LINES},
binned AS (SELECT column_name, model_id, window_start, old, len(list_filter(e, lambda x: v >= x)) AS b
           FROM cells JOIN el USING (column_name)),
o AS (SELECT column_name, b, count(*) AS n FROM binned WHERE old GROUP BY ALL),
w AS (SELECT column_name, model_id, window_start, b, count(*) AS n FROM binned WHERE NOT old GROUP BY ALL),
os AS (SELECT column_name, sum(n)::BIGINT AS reference_count, count(*) AS n_cells FROM o GROUP BY ALL),
ws AS (SELECT column_name, model_id, window_start, sum(n)::BIGINT AS window_count FROM w GROUP BY ALL),
grid AS (SELECT ws.*, e, unnest(range(len(e) + 1)) AS b FROM ws JOIN el USING (column_name)),
paired AS (
  SELECT g.column_name, g.model_id, g.window_start, g.b, window_count, reference_count, n_cells, coalesce(w.n, 0) AS n,
         coalesce(o.n, 0) / reference_count AS p, coalesce(w.n, 0) / window_count AS q, coalesce(e[g.b + 2] - e[g.b + 1], 0) AS width
  FROM grid g JOIN os ON os.column_name = g.column_name LEFT JOIN o ON o.column_name = g.column_name AND o.b = g.b
  LEFT JOIN w ON w.column_name = g.column_name AND w.model_id = g.model_id AND w.window_start = g.window_start AND w.b = g.b),
steps AS (
  SELECT *, abs(sum(p) OVER r - sum(q) OVER r) AS gap, (p + q) / 2 AS m, greatest(p, 1e-4) AS fp, greatest(q, 1e-4) AS fq,
         CASE WHEN p > 0 THEN (n - p * window_count) ** 2 / (p * window_count) ELSE 0 END AS chi
  FROM paired WINDOW r AS (PARTITION BY column_name, model_id, window_start ORDER BY b))
SELECT column_name, model_id, window_start, window_count, reference_count, round(max(gap), 6) AS ks,
       round(sum(gap * width), 4) AS wasserstein, round(sum(abs(p - q)) / 2, 6) AS total_variation,
       round(sum((fq - fp) * ln(fq / fp)), 6) AS psi,
       round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / m) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / m) ELSE 0 END) / 2, 0)), 6) AS jensen_shannon,
       round(sum(chi), 4) AS chi_square, round(sqrt(sum(chi) / (window_count * (max(n_cells) - 1))), 6) AS cramers_v
FROM steps GROUP BY column_name, model_id, window_start, window_count, reference_count""")
def drift_lines_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures of four columns of the largest table, per month-long window and return flag, on given bins."""
    later, earlier, spec = _lines_and_baseline(spark, sf_dir)
    found = dr.numeric_drift(later, spec, list(LINE_EDGES), earlier, edges=LINE_EDGES)
    shown = found.select("column_name", "model_id", "window_start", "window_count", "reference_count", *LINE_MEASURES)
    coarse = ("wasserstein", "chi_square")
    return rounded(rounded(shown, *[m for m in LINE_MEASURES if m not in coarse]), *coarse, digits=4)


@workload(f"""
WITH {LINES}
SELECT column_name, model_id, window_start, count(*) AS window_count, true AS ks_is_close,
       true AS total_variation_covers_ks, true AS measures_in_range
FROM cells WHERE NOT old GROUP BY ALL""")
def drift_lines_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All measures on the bins a refresh cuts by default, held against the exact distance.

    The two distribution functions are read at the quantiles of the baseline, so the binned
    distance is no greater than the exact one, and less by what a bin holds at most: a 256th of the baseline
    (and the sketch's error), or as much as the most frequent value.
    """
    later, earlier, spec = _lines_and_baseline(spark, sf_dir)
    keys = ["column_name", "model_id", "window_start"]
    binned = dr.numeric_drift(later, spec, list(LINE_EDGES), earlier)
    exact = dr.exact_numeric_drift(later, spec, list(LINE_EDGES), earlier).select(*keys, F.col("ks").alias("exact_ks"))
    ks, tv = F.col("ks"), F.col("total_variation")
    within = [tv.between(0, 1), F.col("jensen_shannon").between(0, 1), *[F.col(m) >= 0 for m in ("psi", "wasserstein", "chi_square", "cramers_v")]]
    return binned.join(exact, keys).select(
        *keys,
        "window_count",
        (F.col("exact_ks") - ks).between(-1e-9, 0.02).alias("ks_is_close"),
        (tv >= ks - 1e-9).alias("total_variation_covers_ks"),
        reduce(and_, within).alias("measures_in_range"),
    )


CONSECUTIVE = f"""{LOG},
days AS (SELECT window_start, row_number() OVER (ORDER BY window_start) AS i
         FROM (SELECT DISTINCT {DAY} AS window_start FROM log)),
c AS (SELECT {DAY} AS window_start, event_type AS v, count(*) AS n FROM log GROUP BY ALL),
s AS (SELECT c.window_start, i, v, n / sum(n) OVER (PARTITION BY c.window_start) AS share
      FROM c JOIN days ON c.window_start = days.window_start),
vals AS (SELECT DISTINCT v FROM c),
paired AS (
  SELECT d.window_start, coalesce(cur.share, 0) AS q, coalesce(prev.share, 0) AS p, d.i
  FROM days d CROSS JOIN vals
  LEFT JOIN s cur ON cur.i = d.i AND cur.v = vals.v
  LEFT JOIN s prev ON prev.i = d.i - 1 AND prev.v = vals.v)"""


@workload(f"""
WITH {CONSECUTIVE}
SELECT 'event_type' AS column_name, 'consecutive' AS drift_type,
       CASE WHEN max(i) > 1 THEN round({TV}, 6) END AS drift_score,
       window_start, window_start + INTERVAL 1 DAY AS window_end
FROM paired GROUP BY window_start""")
def drift_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day against the one before; the first day has nothing to be compared with."""
    found = dr.categorical_drift(inference_log(spark, sf_dir), log_spec(), ["event_type"])
    return _scores(found, "total_variation")


@workload(f"""
WITH {LOG},
wn AS (SELECT {DAY} AS window_start, value, count(*) AS n FROM log GROUP BY ALL),
days AS (SELECT window_start, lag(window_start) OVER (ORDER BY window_start) AS prev
         FROM (SELECT DISTINCT window_start FROM wn)),
grid AS (
  SELECT DISTINCT d.window_start, d.prev, x.value
  FROM days d JOIN wn x ON x.window_start = d.window_start OR x.window_start = d.prev),
cdf AS (
  SELECT g.window_start, g.prev,
         sum(coalesce(c.n, 0)) OVER (PARTITION BY g.window_start ORDER BY g.value) / sum(c.n) OVER (PARTITION BY g.window_start) AS q,
         sum(coalesce(b.n, 0)) OVER (PARTITION BY g.window_start ORDER BY g.value) / sum(b.n) OVER (PARTITION BY g.window_start) AS p
  FROM grid g LEFT JOIN wn c ON c.window_start = g.window_start AND c.value = g.value
  LEFT JOIN wn b ON b.window_start = g.prev AND b.value = g.value)
SELECT 'value' AS column_name, 'consecutive' AS drift_type,
       CASE WHEN max(prev) IS NOT NULL THEN round(max(abs(p - q)), 6) END AS drift_score,
       window_start, window_start + INTERVAL 1 DAY AS window_end
FROM cdf GROUP BY window_start""")
def drift_ks_consecutive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(dr.exact_numeric_drift(inference_log(spark, sf_dir), log_spec(), ["value"]), "ks")


@workload(f"""
WITH {BASE},
wc AS (SELECT {DAY} AS window_start, event_type AS v, count(*) AS n FROM live GROUP BY ALL),
bc AS (SELECT dayofweek(timestamp) AS d, event_type AS v, count(*) AS n FROM base GROUP BY ALL),
cells AS (
  SELECT window_start, v FROM (SELECT DISTINCT window_start FROM wc) x JOIN bc ON dayofweek(x.window_start) = bc.d
  UNION SELECT window_start, v FROM wc),
paired AS (
  SELECT c.window_start, coalesce(bc.n, 0) / sum(bc.n) OVER (PARTITION BY c.window_start) AS p,
         coalesce(wc.n, 0) / sum(wc.n) OVER (PARTITION BY c.window_start) AS q
  FROM cells c LEFT JOIN wc ON c.window_start = wc.window_start AND c.v = wc.v
  LEFT JOIN bc ON dayofweek(c.window_start) = bc.d AND c.v = bc.v)
{score_sql('event_type', TV, 'seasonal')}""")
def drift_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day against the same weekday of the baseline."""
    return _scores(_daily_categories(spark, sf_dir, drift_type="seasonal"), "total_variation")


@workload(f"""
WITH {BASE},
wc AS (SELECT {DAY} AS window_start, model_id, prediction AS v, count(*) AS n FROM live GROUP BY ALL),
bc AS (SELECT prediction AS v, count(*) AS n FROM base GROUP BY ALL),
cells AS (
  SELECT window_start, model_id, v FROM (SELECT DISTINCT window_start, model_id FROM wc) CROSS JOIN (SELECT v FROM bc)
  UNION SELECT window_start, model_id, v FROM wc),
paired AS (
  SELECT c.window_start, c.model_id, coalesce(bc.n, 0) / (SELECT sum(n) FROM bc) AS p,
         coalesce(wc.n, 0) / sum(wc.n) OVER (PARTITION BY c.window_start, c.model_id) AS q,
         sum(wc.n) OVER (PARTITION BY c.window_start, c.model_id) AS total
  FROM cells c LEFT JOIN wc ON c.window_start = wc.window_start AND c.model_id = wc.model_id AND c.v = wc.v
  LEFT JOIN bc ON c.v = bc.v)
SELECT model_id, window_start, max(total)::BIGINT AS window_count,
       (SELECT sum(n) FROM bc)::BIGINT AS reference_count, round({TV}, 6) AS total_variation, round({PSI}, 6) AS psi
FROM paired GROUP BY model_id, window_start""")
def drift_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction drift per model, with the sizes behind each score."""
    spec = log_spec(model_id_col="model_id")
    found = dr.categorical_drift(monitored(spark, sf_dir), spec, ["prediction"], baseline(spark, sf_dir))
    columns = ["model_id", "window_start", "window_count", "reference_count", "total_variation", "psi"]
    return rounded(found.select(*columns), "total_variation", "psi")


@workload(f"""
WITH {BASE},
s AS (SELECT *, NULL::VARCHAR AS slice_value FROM live UNION ALL SELECT *, (value > 50)::VARCHAR FROM live),
t AS (SELECT *, NULL::VARCHAR AS slice_value FROM base UNION ALL SELECT *, (value > 50)::VARCHAR FROM base),
wc AS (SELECT {DAY} AS window_start, slice_value, event_type AS v, count(*) AS n FROM s GROUP BY ALL),
bc AS (SELECT slice_value, event_type AS v, count(*) AS n FROM t GROUP BY ALL),
cells AS (
  SELECT x.window_start, x.slice_value, bc.v FROM (SELECT DISTINCT window_start, slice_value FROM wc) x
  JOIN bc ON x.slice_value IS NOT DISTINCT FROM bc.slice_value
  UNION SELECT window_start, slice_value, v FROM wc),
paired AS (
  SELECT c.window_start, c.slice_value,
         coalesce(bc.n, 0) / sum(bc.n) OVER (PARTITION BY c.window_start, c.slice_value) AS p,
         coalesce(wc.n, 0) / sum(wc.n) OVER (PARTITION BY c.window_start, c.slice_value) AS q
  FROM cells c
  LEFT JOIN wc ON c.window_start = wc.window_start AND c.slice_value IS NOT DISTINCT FROM wc.slice_value AND c.v = wc.v
  LEFT JOIN bc ON c.slice_value IS NOT DISTINCT FROM bc.slice_value AND c.v = bc.v)
SELECT CASE WHEN slice_value IS NOT NULL THEN 'value > 50' END AS slice_key, slice_value, window_start,
       round({TV}, 6) AS total_variation
FROM paired GROUP BY slice_value, window_start""")
def drift_by_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each slice against the same slice of the baseline."""
    spec = log_spec(slicing_exprs=("value > 50",))
    found = dr.categorical_drift(monitored(spark, sf_dir), spec, ["event_type"], baseline(spark, sf_dir))
    return rounded(
        found.select("slice_key", "slice_value", "window_start", "total_variation"), "total_variation"
    )


def _spoiled(log):
    """A tenth of the values is missing, another tenth is not a number."""
    last = F.col("request_id") % 10
    text = F.when(last == 3, F.lit(None)).when(last == 7, "n/a").otherwise(F.col("value").cast("string"))
    return log.select("timestamp", text.alias("text"))


@workload(f"""
WITH {LOG},
t AS (SELECT timestamp, CASE request_id % 10 WHEN 3 THEN NULL WHEN 7 THEN 'n/a' ELSE value::VARCHAR END AS text FROM log),
f AS (SELECT timestamp, (text IS NULL)::INTEGER AS a,
             (text IS NOT NULL AND TRY_CAST(text AS DOUBLE) IS NULL)::INTEGER AS m FROM t),
win AS (SELECT {DAY} AS window_start, avg(a) AS a, avg(m) AS m FROM f WHERE timestamp >= TIMESTAMP '2024-01-08' GROUP BY 1),
ref AS (SELECT avg(a) AS a, avg(m) AS m FROM f WHERE timestamp < TIMESTAMP '2024-01-08')
SELECT 'text' AS column_name, 'null' AS check_name, window_start, round(win.a, 6) AS window_share,
       round(ref.a, 6) AS baseline_share, round(win.a - ref.a, 6) AS share_change FROM win, ref
UNION ALL
SELECT 'text', 'mistyped', window_start, round(win.m, 6), round(ref.m, 6), round(win.m - ref.m, 6) FROM win, ref""")
def drift_null_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and type-mismatch shares against the baseline."""
    found = dr.null_rate_change(
        _spoiled(monitored(spark, sf_dir)),
        log_spec(),
        ["text"],
        _spoiled(baseline(spark, sf_dir)),
        {"text": "double"},
    )
    return rounded(found.drop("granularity", "window_end"), "window_share", "baseline_share", "share_change")


# -- reports and alerts on the daily drift of event types ---------------------------------------

SCORES = f"""{EVENT_TYPES},
d AS (SELECT 'event_type' AS column_name, 'baseline' AS drift_type, {TV} AS drift_score, window_start,
             window_start + INTERVAL 1 DAY AS window_end FROM paired GROUP BY window_start)"""


def _drift_table(spark, sf_dir) -> DataFrame:
    return dr.drift_table(_daily_categories(spark, sf_dir), "total_variation")


@workload(f"""
WITH {SCORES}
SELECT column_name, drift_type, round(drift_score, 6) AS drift_score, window_start, window_end
FROM d WHERE window_end >= DATE '{AS_OF}' - INTERVAL 30 DAY ORDER BY window_start LIMIT 20""")
def drift_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = alerts.recent_windows(_drift_table(spark, sf_dir), 30, AS_OF)
    columns = ["column_name", "drift_type", "drift_score", "window_start", "window_end"]
    return rounded(summary(recent, columns, 20, ["window_start"]), "drift_score")


@workload(f"""
WITH {SCORES}
SELECT drift_type, column_name, count(*) AS n_records, count(*) FILTER (drift_score > 0.05) AS n_high,
       round(max(drift_score), 6) AS max_score, max(window_end) AS last_window_end
FROM d WHERE window_end >= DATE '{AS_OF}' - INTERVAL 7 DAY GROUP BY ALL""")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _drift_table(spark, sf_dir).withColumn("metric_name", F.lit("drift_score"))
    further = scores.withColumns({"metric_name": F.lit("chi_square"), "drift_score": F.lit(9.0)})
    return rounded(alerts.drift_report(scores.unionByName(further), 7, AS_OF, 0.05), "max_score")


@workload(f"""
WITH {SCORES}
SELECT column_name, round(drift_score, 6) AS drift_score, window_end FROM d
WHERE drift_score > 0.05 AND window_end >= DATE '{AS_OF}' - INTERVAL 30 DAY
ORDER BY d.drift_score DESC, column_name, window_end LIMIT 10""")
def high_drift_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten greatest drift scores of the last 30 days."""
    recent = alerts.recent_windows(_drift_table(spark, sf_dir), 30, AS_OF)
    return rounded(alerts.top_drift(recent, 10, 0.05), "drift_score")


@workload(f"""
WITH {SCORES}
SELECT column_name, round(drift_score, 6) AS drift_score, drift_type, window_end FROM d
WHERE drift_score > 0.05 AND window_end >= DATE '{AS_OF}' - INTERVAL 1 DAY""")
def drift_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.drift_violations(_drift_table(spark, sf_dir), 0.05, 1, AS_OF)
    return rounded(found, "drift_score")


# The rules the alert queries run, one of them on a metric nobody computes.
RULES = [
    AlertRule("prediction_drift", 0.05, "critical", recipients=("a@example.com", "b@example.com")),
    AlertRule("prediction_drift", 0.07, "warning"),
    AlertRule("data_quality_score", 0.99, "critical"),
    AlertRule("model_cost", 1.0, "warning"),
]
RULES_SQL = """rules(metric, threshold, severity) AS (VALUES ('prediction_drift', 0.05::DOUBLE, 'critical'),
  ('prediction_drift', 0.07, 'warning'), ('data_quality_score', 0.99, 'critical'), ('model_cost', 1.0, 'warning')),
fired AS (SELECT r.*, d.* FROM rules r JOIN d ON r.metric = 'prediction_drift' AND d.drift_score > r.threshold
          WHERE window_end >= DATE '2024-01-31' - INTERVAL 14 DAY)"""


def _violations(spark, sf_dir) -> DataFrame:
    metrics = alerts.drift_metrics(_drift_table(spark, sf_dir))
    return alerts.evaluate_rules(metrics, alerts.rules_table(spark, RULES), 14, AS_OF)


@workload(f"""
WITH {SCORES}, {RULES_SQL}
SELECT metric, severity, threshold, column_name, drift_type, round(drift_score, 6) AS value, window_end, '1 day' AS granularity FROM fired""")
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules against all drift scores in one join."""
    found = _violations(spark, sf_dir)
    return rounded(found.select("metric", "severity", "threshold", "column_name", "drift_type", "value", "window_end", "granularity"), "value")


@workload(f"WITH {SCORES}, {RULES_SQL} SELECT metric, severity, count(*) AS n_violations FROM fired GROUP BY ALL")
def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_summary(_violations(spark, sf_dir))


@workload(f"""
WITH {SCORES}, {RULES_SQL},
texts AS (
  SELECT metric, severity, threshold, count(*) AS n_violations, count(DISTINCT column_name) AS n_columns,
         string_agg(line, chr(10) ORDER BY line) AS violation_lines
  FROM (SELECT *, printf('  - %s: %.4f (%s)', column_name, drift_score, drift_type) AS line FROM fired) GROUP BY ALL)
SELECT metric, severity, 0 AS part, n_violations,
       '[PROD] Prediction Drift Alert - ' || n_columns || ' columns' AS subject, violation_lines,
       concat_ws(chr(10), 'prod, main.models', 'Threshold ' || threshold, violation_lines) AS body
FROM texts""")
def alert_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_messages(_violations(spark, sf_dir), "prod", "main", "models")


@workload(f"""
WITH {SCORES}, {RULES_SQL}
SELECT metric, severity, 'Unknown alert metric: ' || metric AS warning FROM rules
WHERE metric NOT IN (SELECT 'prediction_drift' FROM d)""")
def unknown_metric_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on metrics that the computed metric table does not hold."""
    metrics = alerts.drift_metrics(_drift_table(spark, sf_dir))
    return alerts.unknown_metrics(alerts.rules_table(spark, RULES), metrics)


# Thresholds of the settings templates; an error rise of a fifth, a day of silence.
TEMPLATE_RULES = [
    AlertRule("mae_increase", 0.2, "critical"),
    AlertRule("forecast_accuracy_drop", 0.2, "critical"),
    AlertRule("data_freshness", 24.0, "warning"),
]


@workload("""
SELECT event_type AS model_id, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9, 6) AS value,
       'warning' AS severity
FROM events GROUP BY event_type
HAVING (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 3.6e9 > 24
UNION ALL
SELECT 'silent ' || event_type, round((epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(ts))) / 3.6e9, 6), 'warning'
FROM events GROUP BY event_type
HAVING (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(ts))) / 3.6e9 > 24""")
def freshness_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types that have been silent for longer than a day, looked at on two days."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "model_id")
    fresh = alerts.freshness_hours(events, "ts", "2024-01-31 00:00:00", ["model_id"])
    later = alerts.freshness_hours(events, "ts", "2024-03-01 00:00:00", ["model_id"])
    silent = later.withColumn("model_id", F.concat(F.lit("silent "), "model_id"))
    metrics = alerts.metric_rows(fresh.unionByName(silent), "data_freshness", "hours_old", None)
    found = alerts.evaluate_rules(metrics, alerts.rules_table(spark, TEMPLATE_RULES), 1, AS_OF)
    return rounded(found.select("model_id", "value", "severity"), "value")


@workload(f"""
WITH {PRICED},
m AS (
  SELECT date_trunc('day', timestamp)::TIMESTAMP AS window_start, model_id, avg(abs(label - prediction)) AS mae
  FROM priced GROUP BY ALL),
c AS (SELECT *, lag(mae) OVER (PARTITION BY model_id ORDER BY window_start) AS reference FROM m)
SELECT 'mae_increase' AS metric, 'critical' AS severity, model_id, window_start + INTERVAL 1 DAY AS window_end,
       round((mae - reference) / reference, 6) AS value
FROM c WHERE (mae - reference) / nullif(reference, 0) > 0.2""")
def mae_increase_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose error rose by more than a fifth over the day before that has rows, per model."""
    spec = MonitorSpec(problem_type="regression", model_id_col="model_id", numeric_cols=())
    values = {"label": F.col("label"), "prediction": F.col("prediction")}
    rows, keys = grouped_rows(priced_lines(spark, sf_dir), spec, values)
    errors = alerts.relative_change(regression_metrics(rows, "label", "prediction", keys), "mae", keys=["model_id"])
    metrics = alerts.metric_rows(errors, "mae_increase", "relative_change")
    found = alerts.evaluate_rules(metrics, alerts.rules_table(spark, TEMPLATE_RULES), None)
    return rounded(found.select("metric", "severity", "model_id", "window_end", "value"), "value")


@workload(f"""
WITH {SERIES},
f AS (SELECT *, lag(total, 7) OVER (PARTITION BY o_orderpriority ORDER BY period) AS forecast FROM series),
m AS (
  SELECT o_orderpriority, time_bucket(INTERVAL '90 days', period, TIMESTAMP '1970-01-01') AS window_start,
         1 - avg(CASE WHEN total <> 0 THEN abs((total - forecast) / total) END) AS accuracy
  FROM f WHERE forecast IS NOT NULL GROUP BY ALL),
c AS (SELECT *, lag(accuracy) OVER (PARTITION BY o_orderpriority ORDER BY window_start) AS reference FROM m)
SELECT 'forecast_accuracy_drop' AS metric, 'critical' AS severity, o_orderpriority AS model_id,
       window_start + INTERVAL 90 DAY AS window_end,
       round((reference - accuracy) / nullif(abs(reference), 0), 6) AS value
FROM c WHERE (reference - accuracy) / nullif(abs(reference), 0) > 0.2""")
def accuracy_drop_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows whose forecast accuracy (1 - MAPE of last week's value) fell by more than a fifth."""
    from tidegauge.operators.timeseries import lag_features

    series = lag_features(daily_orders(spark, sf_dir), "period", "total", (7,), ["o_orderpriority"])
    window = F.window("period", "90 days")
    windowed = series.withColumns({"window_start": window.start, "window_end": window.end})
    errors = regression_metrics(windowed, "total", "total_lag_7", ["o_orderpriority", "window_start", "window_end"])
    accuracy = errors.select(
        F.col("o_orderpriority").alias("model_id"), "window_start", "window_end", (1 - F.col("mape")).alias("accuracy")
    )
    changes = alerts.relative_change(accuracy, "accuracy", keys=["model_id"])
    dropped = changes.withColumn("drop", -F.col("relative_change"))
    metrics = alerts.metric_rows(dropped, "forecast_accuracy_drop", "drop")
    found = alerts.evaluate_rules(metrics, alerts.rules_table(spark, TEMPLATE_RULES), None)
    return rounded(found.select("metric", "severity", "model_id", "window_end", "value"), "value")


@workload("""
WITH checks AS (
  SELECT time_bucket(INTERVAL '1 day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS n,
         count(*) FILTER (NOT value BETWEEN 1 AND 200) AS a, count(*) FILTER (NOT value BETWEEN 0 AND 100) AS b
  FROM events GROUP BY 1)
SELECT window_end, round(((1 - a / n) + (1 - b / n)) / 2, 6) AS data_quality_score, 'critical' AS severity
FROM checks WHERE ((1 - a / n) + (1 - b / n)) / 2 < 0.97""")
def quality_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose data quality score lies below the floor."""
    rows, keys = grouped_rows(inference_log(spark, sf_dir), log_spec(), {"value": F.col("value")})
    checks = check_rows(rows, [range_check("value", 1, 200), outlier_check("value", (0, 100))], keys)
    scores = quality_score(checks, keys)
    metrics = alerts.metric_rows(scores, "data_quality_score", "data_quality_score")
    rules = alerts.rules_table(spark, [AlertRule("data_quality_score", 0.97, "critical")])
    found = alerts.evaluate_rules(metrics, rules, None)
    return rounded(
        found.select("window_end", F.col("value").alias("data_quality_score"), "severity"),
        "data_quality_score",
    )
