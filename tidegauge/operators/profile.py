"""Column profiles per window, model and slice, in long form."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import join_groups, quoted, ratio, text
from tidegauge.operators.distribution import (
    approx_edges,
    category_long,
    exact_quantiles,
    numeric_long,
    ranks_of_sketch,
    value_counts,
)
from tidegauge.operators.windows import (
    group_keys,
    grouped_rows,
    nested_granularities,
    with_unused_keys,
    with_windows,
)
from tidegauge.spec import MonitorSpec, column_roles

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("metric_text", T.StringType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("slice_key", T.StringType()),
        T.StructField("slice_value", T.StringType()),
    ]
)
PROFILE_COLUMNS = PROFILE_SCHEMA.names

# Entries of a rank sketch: ranks are off by about 0.3 % at most, and not at all up to this many rows.
SKETCH_SIZE = 1024

# Values that the sketch of the most frequent one tracks, and how many it is asked for.
TOP_TRACKED, TOP_ASKED = 256, 64

QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def profiled_columns(df: DataFrame, spec: MonitorSpec) -> tuple[list[str], list[str]]:
    """The columns a monitor profiles: as given, else by type without keys, times and payloads."""
    numeric, categorical = column_roles(df.schema, spec.unprofiled)
    return (
        list(numeric if spec.numeric_cols is None else spec.numeric_cols),
        list(categorical if spec.categorical_cols is None else spec.categorical_cols),
    )


def long_metrics(
    wide: DataFrame,
    keys: list[str],
    metrics: dict[tuple[str, str], str],
    texts: dict[tuple[str, str], str] | None = None,
) -> DataFrame:
    """Turn one wide row per group into one row per column and metric, without a shuffle.

    Metrics, and the texts some of them have, are SQL expressions over the wide row, put
    together as one expression.
    """
    texts = texts or {}
    rows = ", ".join(
        f"struct({text(column)} AS column_name, {text(metric)} AS metric_name, "
        f"CAST({value} AS double) AS metric_value, "
        f"CAST({texts.get((column, metric), 'NULL')} AS string) AS metric_text)"
        for (column, metric), value in metrics.items()
    )
    return wide.select(*keys, F.expr(f"inline(array({rows}))"))


def _shaped(metrics: DataFrame) -> DataFrame:
    return with_unused_keys(metrics).select(*PROFILE_COLUMNS)


def part(column: str, state: str) -> str:
    """SQL name of one state of a column in a wide row."""
    return quoted(f"{column}.{state}")


def _numeric_states(column: str, sketches: bool) -> dict[str, tuple[str, str]]:
    """States of a numeric column: how to take them from rows, and how to merge them.

    The moments of merged windows are folded together part by part: squared deviations are
    those of the parts plus those of their means, which avoids the difference of two large
    sums. A window has few parts, and a list of three numbers each.
    """
    v = quoted(column)
    n, mean, m2 = (part(column, state) for state in ("n", "mean", "m2"))
    moments = (
        f"aggregate(collect_list(CASE WHEN {n} > 0 THEN struct({n} AS n, {mean} AS mean, {m2} AS m2) END), "
        "struct(0L AS n, 0D AS mean, 0D AS m2), (a, x) -> struct(a.n + x.n AS n, "
        "a.mean + (x.mean - a.mean) * x.n / (a.n + x.n) AS mean, "
        "a.m2 + x.m2 + power(x.mean - a.mean, 2) * a.n * x.n / (a.n + x.n) AS m2))"
    )
    states = {
        "n": (f"count({v})", f"sum({n})"),
        "mean": (f"avg({v})", f"CASE WHEN sum({n}) > 0 THEN {moments}.mean END"),
        "m2": (f"var_pop({v}) * count({v})", f"CASE WHEN sum({n}) > 0 THEN {moments}.m2 END"),
        "min": (f"min({v})", f"min({part(column, 'min')})"),
        "max": (f"max({v})", f"max({part(column, 'max')})"),
        "num_zeros": (f"count_if({v} = 0)", f"sum({part(column, 'num_zeros')})"),
        "nan": (f"count_if({part(column, 'is_nan')})", f"sum({part(column, 'nan')})"),
    }
    if sketches:
        distinct, ranks = part(column, "distinct"), part(column, "ranks")
        hashed = f"CASE WHEN {v} IS NOT NULL THEN xxhash64({v}) END"
        states["distinct"] = (f"hll_sketch_agg({hashed})", f"hll_union_agg({distinct})")
        states["ranks"] = (
            f"kll_sketch_agg_double({v}, {SKETCH_SIZE})",
            f"kll_merge_agg_double({ranks}, {SKETCH_SIZE})",
        )
    return {f"{column}.{state}": sql for state, sql in states.items()}


def _text_states(column: str) -> dict[str, tuple[str, str]]:
    """As ``_numeric_states`` for a categorical column, whose values are in ``<column>.text``."""
    v = part(column, "text")
    states = {
        "n": (f"count({v})", "sum"),
        "distinct": (f"hll_sketch_agg({v})", "hll_union_agg"),
        "length": (f"sum(length({v}))", "sum"),
        "min_length": (f"min(length({v}))", "min"),
        "max_length": (f"max(length({v}))", "max"),
    }
    merged = {
        f"{column}.text.{state}": (first, f"{again}({part(column, f'text.{state}')})")
        for state, (first, again) in states.items()
    }
    top = part(column, "text.top")
    merged[f"{column}.text.top"] = (
        f"approx_top_k_accumulate({v}, {TOP_TRACKED}) FILTER (WHERE {v} IS NOT NULL)",
        f"approx_top_k_combine({top}, {TOP_TRACKED})",
    )
    return merged


def _states(numeric: list[str], categorical: list[str], sketches: bool) -> dict[str, tuple[str, str]]:
    states = {"_rows": ("count(*)", "sum(_rows)")}
    for c in numeric:
        states |= _numeric_states(c, sketches)
    for c in categorical:
        states |= _text_states(c)
    return states


def row_states(
    df: DataFrame,
    spec: MonitorSpec,
    numeric: list[str],
    categorical: list[str],
    sketches: bool = True,
    custom: dict[str, Column] | None = None,
) -> tuple[DataFrame, list[str]]:
    """One wide row per window, model and slice with the states of all columns.

    One aggregate over the table for all columns. The states have a fixed size, so map
    tasks shrink their rows to one per group they meet before anything is shuffled.
    """
    custom = custom or {}
    values = {}
    for c in numeric:
        number = F.col(c).cast("double")
        # NaN is no number here, as in every other operator; how many there are is counted
        values |= {c: F.when(~F.isnan(number), number), f"{c}.is_nan": F.isnan(number)}
    values |= {f"{c}.text": F.col(c).cast("string") for c in categorical}
    values |= {c: F.col(c) for c in df.columns if custom and c not in values}
    rows, keys = grouped_rows(df, spec, values)
    own = [a.alias(f"custom.{name}") for name, a in custom.items()]
    return rows.groupBy(*keys).agg(*state_aggregates(numeric, categorical, sketches), *own), keys


def state_aggregates(numeric: list[str], categorical: list[str], sketches: bool = True) -> list[Column]:
    """The states of all columns as aggregates over rows that hold ``<column>`` and ``<column>.is_nan``, or ``<column>.text``."""
    return [F.expr(f"{first} AS {quoted(name)}") for name, (first, _) in _states(numeric, categorical, sketches).items()]


def merged_states(
    states: DataFrame, spec: MonitorSpec, numeric: list[str], categorical: list[str], sketches: bool = True
) -> tuple[DataFrame, list[str]]:
    """The states of all granularities of ``spec`` from those of windows they are made of."""
    keys = group_keys(spec)
    at = states.drop("granularity", "window_end").withColumnRenamed("window_start", "_at")
    merged = [f"{again} AS {quoted(name)}" for name, (_, again) in _states(numeric, categorical, sketches).items()]
    return with_windows(at, "_at", spec.granularities).groupBy(*keys).agg(*[F.expr(a) for a in merged]), keys


def window_states(
    df: DataFrame,
    spec: MonitorSpec,
    numeric: list[str],
    categorical: list[str],
    sketches: bool,
    custom: dict[str, Column],
) -> tuple[DataFrame, list[str]]:
    """The states of all granularities; rows are aggregated for the finest, the others merged from it."""
    # a user's own aggregate is only known to work on rows
    finest = None if custom or len(spec.granularities) == 1 else nested_granularities(spec.granularities)
    if finest is None:
        return row_states(df, spec, numeric, categorical, sketches, custom)
    states, _ = row_states(df, replace(spec, granularities=(finest,)), numeric, categorical, sketches)
    return merged_states(states, spec, numeric, categorical, sketches)


Metrics = dict[tuple[str, str], str]


def _numeric_metrics(columns: list[str], sketches: bool) -> Metrics:
    metrics = {}
    for c in columns:
        n = part(c, "n")
        metrics[(c, "count")] = "_rows"
        nulls = f"(_rows - {n} - {part(c, 'nan')})"
        metrics[(c, "num_nulls")] = nulls
        metrics[(c, "percent_null")] = f"100 * {nulls} / _rows"
        metrics[(c, "num_nan")] = part(c, "nan")
        metrics[(c, "avg")] = part(c, "mean")
        metrics[(c, "stddev")] = f"CASE WHEN {n} > 1 THEN sqrt({part(c, 'm2')} / ({n} - 1)) END"
        metrics |= {(c, m): part(c, m) for m in ("min", "max", "num_zeros")}
        if sketches:
            metrics[(c, "distinct_count")] = f"hll_sketch_estimate({part(c, 'distinct')})"
            metrics |= {(c, m): f"get({part(c, 'quantiles')}, {i})" for i, m in enumerate(QUANTILES)}
    return metrics


def _text_metrics(columns: list[str]) -> Metrics:
    metrics = {}
    for c in columns:
        n = part(c, "text.n")
        metrics[(c, "count")] = "_rows"
        metrics[(c, "num_nulls")] = f"_rows - {n}"
        metrics[(c, "percent_null")] = f"100 * (_rows - {n}) / _rows"
        metrics[(c, "distinct_count")] = f"hll_sketch_estimate({part(c, 'text.distinct')})"
        metrics[(c, "most_frequent")] = f"get({part(c, 'text.most')}, 0).count"
        metrics[(c, "avg_length")] = f"try_divide({part(c, 'text.length')}, {n})"
        metrics |= {(c, m): part(c, f"text.{m}") for m in ("min_length", "max_length")}
    return metrics


def _top_texts(columns: list[str]) -> Metrics:
    """The smallest of the most frequent values."""
    return {
        (c, "most_frequent"): f"array_min(transform(filter({most}, x -> x.count = get({most}, 0).count), x -> x.item))"
        for c in columns
        for most in [part(c, "text.most")]
    }


def _profile_of_states(
    df: DataFrame,
    spec: MonitorSpec,
    numeric: list[str],
    categorical: list[str],
    sketches: bool = True,
    custom: dict[str, Column] | None = None,
) -> DataFrame:
    custom = custom or {}
    states, keys = window_states(df, spec, numeric, categorical, sketches, custom)
    return _metrics_of_states(states, keys, numeric, categorical, sketches, custom)


def profile_of_merged_states(states: DataFrame, spec: MonitorSpec, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The profile at all granularities of ``spec`` from sketched states of finer windows."""
    merged, keys = merged_states(states, spec, numeric, categorical)
    return _metrics_of_states(merged, keys, numeric, categorical, True, {})


def _metrics_of_states(
    states: DataFrame, keys: list[str], numeric: list[str], categorical: list[str], sketches: bool, custom: dict[str, Column]
) -> DataFrame:
    if sketches and numeric:
        states = states.withColumns({f"{c}.quantiles": sketched_quantiles(c, QUANTILES.values()) for c in numeric})
    if categorical:
        states = states.withColumns(
            {f"{c}.text.most": F.expr(f"approx_top_k_estimate({part(c, 'text.top')}, {TOP_ASKED})") for c in categorical}
        )
    metrics = _numeric_metrics(numeric, sketches) | _text_metrics(categorical)
    metrics |= {(":table", name): quoted(f"custom.{name}") for name in custom}
    return _shaped(long_metrics(states, keys, metrics, _top_texts(categorical)))


def numeric_profile(
    df: DataFrame,
    spec: MonitorSpec,
    columns: list[str],
    exact: bool = False,
    custom: dict[str, Column] | None = None,
) -> DataFrame:
    """Count, nulls, moments, extremes, zeros, quantiles and distinct values per window.

    By default quantiles and distinct counts are sketches; ``exact=True`` takes them from
    value counts instead. ``custom`` adds aggregate expressions of the user's own, by
    metric name, over the table's columns.
    """
    found = _profile_of_states(df, spec, columns, [], not exact, custom)
    return found.unionByName(_exact_numeric(df, spec, columns)) if exact and columns else found


def sketched_quantiles(column: str, probabilities) -> Column:
    """Quantiles of a column's rank sketch; an empty sketch has none."""
    ranks = ", ".join(f"{p!r}D" for p in probabilities)
    return F.expr(ranks_of_sketch(part(column, "ranks"), ranks))


def _exact_numeric(df: DataFrame, spec: MonitorSpec, columns: list[str]) -> DataFrame:
    edges = approx_edges(df, columns)
    rows, keys = grouped_rows(df, spec, {c: F.col(c).cast("double") for c in columns})
    keys = [*keys, "column_name"]
    counts = value_counts(numeric_long(rows, keys[:-1], columns, edges), keys)
    # asking for n keeps this branch on the counts the quantiles are taken from
    distinct = counts.groupBy(*keys).agg(
        F.count(F.when(F.col("n") > 0, F.col("value"))).cast("double").alias("metric_value")
    )
    names = F.create_map(*[F.lit(x) for m, p in QUANTILES.items() for x in (p, m)])
    quantiles = exact_quantiles(counts, keys, list(QUANTILES.values())).select(
        *keys,
        names[F.col("probability")].alias("metric_name"),
        F.col("quantile_value").alias("metric_value"),
    )
    both = quantiles.unionByName(distinct.withColumn("metric_name", F.lit("distinct_count")))
    return _shaped(both.withColumn("metric_text", F.lit(None).cast("string")))


def categorical_profile(
    df: DataFrame, spec: MonitorSpec, columns: list[str], exact: bool = False
) -> DataFrame:
    """Count, nulls, distinct values, most frequent value and text lengths per window.

    Exact figures come from counts per distinct value, so the shuffle carries one row
    per group and value. The default keeps to one aggregate with sketches of fixed size:
    distinct counts are estimates, and so is the most frequent value of a column with more
    than some 200 different ones in a window.
    """
    if not exact:
        return _profile_of_states(df, spec, [], columns)
    rows, keys = grouped_rows(df, spec, {c: F.col(c).cast("string") for c in columns})
    keys = [*keys, "column_name"]
    counts = value_counts(category_long(rows, keys[:-1], columns), keys)
    value, n = F.col("value"), F.col("n")
    length = F.length("value")
    known = F.coalesce(F.sum(F.when(value.isNotNull(), n)), F.lit(0))
    wide = counts.groupBy(*keys).agg(
        F.sum("n").alias("count"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("num_nulls"),
        F.count("value").alias("distinct_count"),
        # the smallest of the most frequent values
        F.min(F.when(value.isNotNull(), F.struct(-n, value))).alias("_top"),
        ratio(F.sum(length * n).cast("double"), known).alias("avg_length"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
    )
    top = F.col("_top")
    named = wide.select(
        "*", (-top["col1"]).alias("most_frequent"), top["value"].alias("_top_text")
    ).withColumn("percent_null", 100 * F.col("num_nulls") / F.col("count"))
    names = [
        "count", "num_nulls", "percent_null", "distinct_count", "most_frequent",
        "avg_length", "min_length", "max_length",
    ]
    cells = [
        F.struct(
            F.lit(m).alias("metric_name"),
            F.col(m).cast("double").alias("metric_value"),
            (F.col("_top_text") if m == "most_frequent" else F.lit(None).cast("string")).alias("metric_text"),
        )
        for m in names
    ]
    return _shaped(named.select(*keys, F.inline(F.array(*cells))))


def profile(
    df: DataFrame, spec: MonitorSpec, exact: bool = False, custom: dict[str, Column] | None = None
) -> DataFrame:
    """The profile table of a monitor: all columns, granularities and slices, by default in one pass."""
    numeric, categorical = profiled_columns(df, spec)
    if not numeric and not categorical and not custom:
        raise ValueError("no column to profile")
    if not exact:
        return _profile_of_states(df, spec, numeric, categorical, True, custom)
    parts = []
    if numeric or custom:
        parts.append(numeric_profile(df, spec, numeric, True, custom))
    if categorical:
        parts.append(categorical_profile(df, spec, categorical, True))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def summary(metrics: DataFrame, columns: list[str], n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows of a metric table, some columns only."""
    shown = metrics.select(*columns)
    return shown.orderBy(*(order_by or columns)).limit(n)


def prediction_share(df: DataFrame, spec: MonitorSpec) -> DataFrame:
    """How often each prediction is made per window, as count and share."""
    rows, keys = grouped_rows(df, spec, {"prediction": F.col(spec.prediction_col).cast("string")})
    counts = rows.groupBy(*keys, "prediction").agg(F.count("*").alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    return join_groups(counts, totals, keys, "inner").select(
        *keys, "prediction", "n", (F.col("n") / F.col("_total")).alias("share")
    )
