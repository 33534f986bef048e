"""Distribution drift of columns against a baseline, the previous window or the same weekday.

A window is compared with its reference distribution cell by cell (a cell is a category
or a bin). Both sides are reduced to counts first. The measures are sums over the union
of the cells of both sides, but only the cells of the window are ever joined: the part
of a sum that a reference cell adds when the window lacks it is known from the
reference alone, so it is added up once per reference and corrected for the cells the
window does have. No window is multiplied by the reference's cells.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import join_groups, ratio
from tidegauge.operators.distribution import (
    DEFAULT_BINS,
    Edges,
    approx_edges,
    bin_counts,
    category_long,
    joint_edges,
    numeric_long,
    per_column,
    value_counts,
)
from tidegauge.operators.windows import SLICE_KEYS, WINDOW_KEYS, granularity_seconds, grouped_rows, with_unused_keys
from tidegauge.spec import MonitorSpec

DRIFT_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("drift_type", T.StringType()),
        T.StructField("drift_score", T.DoubleType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("granularity", T.StringType()),
        T.StructField("model_id", T.StringType()),
        T.StructField("slice_key", T.StringType()),
        T.StructField("slice_value", T.StringType()),
        T.StructField("metric_name", T.StringType()),
        T.StructField("window_count", T.LongType()),
        T.StructField("reference_count", T.LongType()),
    ]
)
DRIFT_COLUMNS = DRIFT_SCHEMA.names

# What a window can be compared with, and the lowest share inside a PSI.
DRIFT_TYPES = ("baseline", "consecutive", "seasonal")
PSI_FLOOR = 1e-4
ORDER_MEASURES = ("ks", "wasserstein")
SHARE_MEASURES = ("total_variation", "psi", "jensen_shannon", "chi_square", "cramers_v")


def _psi_term(p: Column, q: Column) -> Column:
    p, q = F.greatest(p, F.lit(PSI_FLOOR)), F.greatest(q, F.lit(PSI_FLOOR))
    return (q - p) * F.ln(q / p)


def _js_term(p: Column, q: Column) -> Column:
    """One cell's part of the base-2 Jensen-Shannon divergence."""
    mid = (p + q) / 2

    def half(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / mid) / 2).otherwise(0.0)

    return half(p) + half(q)


def share_measures(
    window_counts: DataFrame,
    reference_counts: DataFrame,
    keys: list[str],
    match: list[str],
    cell: str,
) -> DataFrame:
    """Total variation, PSI, Jensen-Shannon distance, chi-square and Cramer's V per group.

    ``window_counts`` holds ``keys, cell, n``; ``reference_counts`` holds ``match, cell, n``
    where ``match`` is a subset of ``keys``. An empty window or reference gives nulls.
    """
    # null cells are passed over inside the sums: a filter here would reach below the
    # counting, and the tables would be counted once with and once without it
    present = F.col(cell).isNotNull()
    p, q, zero = F.col("_p"), F.col("_q"), F.lit(0.0)
    sizes = reference_counts.groupBy(*match).agg(F.sum(F.when(present, F.col("n"))).alias("_size"))
    shares = join_groups(reference_counts, sizes, match, "inner").select(
        *match, cell, "_size", F.when(present, F.col("n") / F.col("_size")).alias("_p")
    )
    # with what a reference adds up to when the window has none of its cells
    references = shares.groupBy(*match).agg(
        F.max(F.when(p.isNotNull(), F.col("_size"))).alias("reference_count"),
        F.sum(F.when(present, _psi_term(p, zero))).alias("_psi_alone"),
        F.sum(F.when(present, _js_term(p, zero))).alias("_js_alone"),
        F.count(cell).alias("_cells"),
    )

    windows = window_counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("_total")
    )
    cells = join_groups(window_counts, windows, keys, "inner").withColumn("_q", ratio(F.col("n"), F.col("_total")))
    paired = join_groups(cells, shares.drop("_size"), [*match, cell], "left").withColumn(
        "_p", F.coalesce("_p", zero)
    )
    expected = p * F.col("_total")
    sums = paired.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("window_count"),
        F.sum(F.when(present, F.abs(p - q) - p)).alias("_tv"),
        F.sum(
            F.when(present, _psi_term(p, q) - F.when(p > 0, _psi_term(p, zero)).otherwise(zero))
        ).alias("_psi"),
        F.sum(F.when(present, _js_term(p, q) - _js_term(p, zero))).alias("_js"),
        F.sum(
            F.when(present & (p > 0), (F.col("n") - expected) ** 2 / expected - expected).otherwise(zero)
        ).alias("_chi2"),
    )
    sized = join_groups(sums, references, match, "left")
    window_count, reference_count = F.col("window_count"), F.col("reference_count")
    # rounding can leave equal distributions a tiny negative sum
    chi2 = F.greatest(F.col("_chi2") + window_count, zero)
    measures = {
        "total_variation": F.greatest(F.col("_tv") + 1, zero) / 2,
        "psi": F.col("_psi") + F.col("_psi_alone"),
        "jensen_shannon": F.sqrt(F.greatest(F.col("_js") + F.col("_js_alone"), zero)),
        "chi_square": chi2,
        "cramers_v": F.sqrt(ratio(chi2, window_count * (F.col("_cells") - 1))),
    }
    return sized.select(
        *keys,
        "window_count",
        F.coalesce(reference_count, F.lit(0)).alias("reference_count"),
        *[
            F.when((window_count > 0) & (reference_count > 0), measure).alias(name)
            for name, measure in measures.items()
        ],
    )


def _placeholder(field: T.StructField) -> Column:
    """Any value of a key's type (text or time), null only where the key itself can be."""
    if field.nullable:
        return F.lit(None).cast(field.dataType)
    if isinstance(field.dataType, T.StringType):
        return F.lit("")
    return F.lit(dt.datetime(1970, 1, 1)).cast(field.dataType)


def exact_ks(
    window_counts: DataFrame, reference_counts: DataFrame, keys: list[str], match: list[str]
) -> DataFrame:
    """Kolmogorov-Smirnov statistic per group over every distinct value.

    The greatest distance between the two distribution functions lies at, or just
    before, a value of the window: between two of them the window's function stands
    still and the reference's only rises. So the reference is looked up at the window's
    values, inside their bin, and never multiplied by the windows.
    """
    # a null value weighs nothing and sorts before all others
    weight = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    zero, other = F.lit(0).cast("long"), [k for k in keys if k not in match]
    # never null, see running_totals
    bin_of_value = F.coalesce("bin", F.lit(-1)).alias("_bin")
    both = window_counts.select(
        *match, *other, bin_of_value, "value", weight.alias("_w"), zero.alias("_r"), F.lit(True).alias("_asked")
    ).unionByName(
        reference_counts.select(
            *match,
            *[_placeholder(window_counts.schema[k]).alias(k) for k in other],
            bin_of_value,
            "value",
            zero.alias("_w"),
            weight.alias("_r"),
            F.lit(False).alias("_asked"),
        )
    )
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    inside = Window.partitionBy(*match, "_bin").orderBy("value").rangeBetween(*up_to_here)
    across = Window.partitionBy(*match).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    below = (
        both.groupBy(*match, "_bin")
        # the second sum is there so that this branch needs the same counts as the other
        # one and they share a shuffle
        .agg(F.sum("_r").alias("_in_bin"), F.sum(F.col("_r") + F.col("_w")).alias("_rows"))
        .where(F.col("_rows").isNotNull())
        .select(
            *match,
            "_bin",
            F.coalesce(F.sum("_in_bin").over(across), zero).alias("_below"),
            F.sum("_in_bin").over(Window.partitionBy(*match)).alias("reference_count"),
        )
    )
    looked_up = both.select(
        "*",
        F.sum("_r").over(inside).alias("_up_to"),
        F.sum("_r").over(Window.partitionBy(*match, "_bin", "value")).alias("_at"),
    ).where("_asked")
    at_values = join_groups(looked_up, below, [*match, "_bin"], "inner")

    w_inside = Window.partitionBy(*keys, "_bin").orderBy("value").rangeBetween(*up_to_here)
    w_across = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    w_below = (
        window_counts.groupBy(*keys, bin_of_value)
        .agg(F.sum(weight).alias("_in_bin"))
        .select(
            *keys,
            "_bin",
            F.coalesce(F.sum("_in_bin").over(w_across), zero).alias("_w_below"),
            F.sum("_in_bin").over(Window.partitionBy(*keys)).alias("window_count"),
        )
    )
    ranked = join_groups(
        at_values.withColumn("_w_up_to", F.sum("_w").over(w_inside)), w_below, [*keys, "_bin"], "inner"
    )
    steps = ranked.select(
        *keys,
        "window_count",
        "reference_count",
        (F.col("_below") + F.col("_up_to")).alias("_r_at"),
        (F.col("_below") + F.col("_up_to") - F.col("_at")).alias("_r_before"),
        (F.col("_w_below") + F.col("_w_up_to")).alias("_w_at"),
        (F.col("_w_below") + F.col("_w_up_to") - F.col("_w")).alias("_w_before"),
    )
    r, w = F.col("reference_count"), F.col("window_count")
    distance = F.greatest(
        F.abs(ratio(F.col("_r_at"), r) - ratio(F.col("_w_at"), w)),
        F.abs(ratio(F.col("_r_before"), r) - ratio(F.col("_w_before"), w)),
    )
    return steps.groupBy(*keys).agg(
        F.max("window_count").alias("window_count"),
        F.coalesce(F.max("reference_count"), zero).alias("reference_count"),
        F.max(distance).alias("ks"),
    )


def binned_order_measures(
    window_bins: DataFrame, reference_bins: DataFrame, keys: list[str], match: list[str], edges: Edges
) -> DataFrame:
    """KS and Wasserstein-1 on shared bins: both distribution functions are read at the edges.

    Every group is one row with its bins as a list, and the running sums are folds over two
    such lists, so the work behind the counts grows with the groups only. Wasserstein-1 is the sum of distance times bin width between the first and last edge.
    """
    present = F.col("bin").isNotNull()
    # the width above each edge but the last, which has no upper neighbour
    widths = per_column(
        {c: [*[high - low for low, high in zip(e, e[1:])], *([0.0] if e else []), 0.0] for c, e in edges.items()}
    )

    def one_row(counts: DataFrame, by: list[str], size: str, bins: str) -> DataFrame:
        """Per group its rows and the counts of all bins as one list."""
        grid = F.sequence(F.lit(0), F.size(widths) - 1)
        return (
            counts.groupBy(*by)
            .agg(
                F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias(size),
                # one entry per bin of a fixed grid
                F.map_from_entries(F.collect_list(F.when(present, F.struct("bin", "n")))).alias("_by_bin"),
            )
            .select(*by, size, F.transform(grid, lambda i: F.coalesce(F.col("_by_bin")[i], F.lit(0))).alias(bins))
        )

    both = join_groups(
        one_row(window_bins, keys, "window_count", "_w"),
        one_row(reference_bins, match, "_size", "_r"),
        match,
        "left",
    )
    w_size, r_size, zero = F.col("window_count"), F.col("_size"), F.lit(0.0)

    def step(done: Column, cell: Column) -> Column:
        """The running sums of both sides at the upper edge of a bin, and what they make of the distance."""
        w, r = done["w"] + cell["counts"]["_w"], done["r"] + cell["counts"]["_r"]
        gap = F.coalesce(F.abs(ratio(w, w_size) - ratio(r, r_size)), zero)
        return F.struct(
            w.alias("w"),
            r.alias("r"),
            F.greatest(done["ks"], gap).alias("ks"),
            (done["area"] + gap * cell["width"]).alias("area"),
        )

    none = F.lit(0).cast("long")
    start = F.struct(none.alias("w"), none.alias("r"), zero.alias("ks"), zero.alias("area"))
    cells = F.zip_with(
        F.arrays_zip("_w", "_r"), widths, lambda counts, width: F.struct(counts.alias("counts"), width.alias("width"))
    )
    measured = both.withColumn("_found", F.aggregate(cells, start, step))
    known = (w_size > 0) & (r_size > 0)
    return measured.select(
        *keys,
        "window_count",
        F.coalesce(r_size, F.lit(0)).alias("reference_count"),
        F.when(known, F.col("_found.ks")).alias("ks"),
        F.when(known, F.col("_found.area")).alias("wasserstein"),
    )


def _previous_windows(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Each group's counts, moved to the next window that has rows, as its reference."""
    series = [k for k in keys if k not in ("window_start", "window_end")]
    order = Window.partitionBy(*series).orderBy("window_start")
    # one row per group and window
    following = (
        counts.groupBy(*keys)
        .agg(F.sum("n").alias("_n"))
        .where(F.col("_n") > 0)
        .select(*keys, F.lead("window_start").over(order).alias("_next"))
        .where(F.col("_next").isNotNull())
        .drop("window_end")
    )
    moved = join_groups(counts.drop("window_end"), following, [*series, "window_start"], "inner")
    return moved.drop("window_start").withColumnRenamed("_next", "window_start")


def reference_for(
    drift_type: str, window_counts: DataFrame, baseline_counts: DataFrame | None, keys: list[str]
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Window counts, reference counts and the keys on which they meet, for one drift type."""
    if drift_type not in DRIFT_TYPES:
        raise ValueError(f"Unknown drift type: {drift_type}")
    if drift_type == "consecutive":
        return (
            window_counts,
            _previous_windows(window_counts, keys),
            [k for k in keys if k != "window_end"],
        )
    if baseline_counts is None:
        raise ValueError(f"{drift_type} drift needs a baseline")
    match = [k for k in keys if k not in WINDOW_KEYS and k in baseline_counts.columns]
    if drift_type == "seasonal":
        window_counts = window_counts.withColumn("_weekday", F.dayofweek("window_start"))
        match = [*match, "_weekday"]
    return window_counts, baseline_counts, match


def default_drift_type(baseline: DataFrame | None) -> str:
    return "consecutive" if baseline is None else "baseline"


def _long(
    df: DataFrame,
    spec: MonitorSpec,
    numeric: list[str],
    categorical: list[str],
    windowed: bool,
    weekday: bool,
) -> tuple[DataFrame, list[str]]:
    values = {c: F.col(c) for c in (*numeric, *categorical)}
    if weekday and any(granularity_seconds(g) > 86400 for g in spec.granularities):
        raise ValueError("seasonal drift compares weekdays: windows may be a day long at most")
    if weekday:
        values["_weekday"] = F.dayofweek(spec.timestamp_col)
    return grouped_rows(df, spec, values, windowed)


def categorical_drift(
    df: DataFrame,
    spec: MonitorSpec,
    columns: list[str],
    baseline: DataFrame | None = None,
    drift_type: str | None = None,
) -> DataFrame:
    """Drift measures of categorical columns, one row per window and column."""
    drift_type = drift_type or default_drift_type(baseline)
    rows, keys = _long(df, spec, [], columns, True, False)
    keys = [*keys, "column_name"]
    counts = value_counts(category_long(rows, keys[:-1], columns), keys)
    base_counts = None
    if drift_type != "consecutive" and baseline is not None:
        seasonal = drift_type == "seasonal"
        base_rows, base_keys = _long(baseline, spec, [], columns, False, seasonal)
        base_keys = [*base_keys, *(["_weekday"] if seasonal else [])]
        base_counts = value_counts(category_long(base_rows, base_keys, columns), [*base_keys, "column_name"])
    counts, reference, match = reference_for(drift_type, counts, base_counts, keys)
    by = [*keys, *(["_weekday"] if drift_type == "seasonal" else [])]
    return (
        share_measures(counts, reference, by, match, "value")
        .withColumn("drift_type", F.lit(drift_type))
        .drop("_weekday")
    )


def numeric_drift(
    df: DataFrame,
    spec: MonitorSpec,
    columns: list[str],
    baseline: DataFrame | None = None,
    drift_type: str | None = None,
    edges: Edges | None = None,
    bins: int = DEFAULT_BINS,
    measures: tuple[str, ...] = ORDER_MEASURES + SHARE_MEASURES,
) -> DataFrame:
    """Drift measures of numeric columns on shared bins, one row per window and column.

    The bins are quantiles of the baseline (of the log itself without one). Both tables
    are read once and reduced to counts per bin before anything is shuffled.
    """
    drift_type = drift_type or default_drift_type(baseline)
    if edges is None:
        edges = approx_edges(df if baseline is None else baseline, columns, bins)
    counts, reference, keys, match = _numeric_counts(df, spec, columns, baseline, drift_type, edges, bin_counts)
    sizes = ["window_count", "reference_count"]
    ordered = [m for m in ORDER_MEASURES if m in measures]
    shared = [m for m in SHARE_MEASURES if m in measures]
    found = None
    if ordered:
        every_edge = {c: edges.get(c, []) for c in columns}
        order = binned_order_measures(counts, reference, keys, match, every_edge)
        found = order.select(*keys, *sizes, *ordered)
    if shared:
        shares = share_measures(counts, reference, keys, match, "bin").select(*keys, *sizes, *shared)
        found = shares if found is None else join_groups(found, shares.drop(*sizes), keys, "inner")
    if found is None:
        raise ValueError(f"Unknown measures: {measures}")
    return found.withColumn("drift_type", F.lit(drift_type)).drop("_weekday")


def exact_numeric_drift(
    df: DataFrame,
    spec: MonitorSpec,
    columns: list[str],
    baseline: DataFrame | None = None,
    drift_type: str | None = None,
) -> DataFrame:
    """Kolmogorov-Smirnov drift over every distinct value instead of bins."""
    drift_type = drift_type or default_drift_type(baseline)
    edges = approx_edges(df, columns)
    if baseline is not None:
        edges = joint_edges(edges, approx_edges(baseline, columns))
    counts, reference, keys, match = _numeric_counts(
        df, spec, columns, baseline, drift_type, edges, value_counts
    )
    return (
        exact_ks(counts, reference, keys, match)
        .withColumn("drift_type", F.lit(drift_type))
        .drop("_weekday")
    )


def _numeric_counts(df, spec, columns, baseline, drift_type, edges, count):
    rows, keys = _long(df, spec, columns, [], True, False)
    keys = [*keys, "column_name"]
    counts = count(numeric_long(rows, keys[:-1], columns, edges), keys)
    base_counts = None
    if drift_type != "consecutive" and baseline is not None:
        seasonal = drift_type == "seasonal"
        base_rows, base_keys = _long(baseline, spec, columns, [], False, seasonal)
        base_keys = [*base_keys, *(["_weekday"] if seasonal else [])]
        base_counts = count(numeric_long(base_rows, base_keys, columns, edges), [*base_keys, "column_name"])
    counts, reference, match = reference_for(drift_type, counts, base_counts, keys)
    return counts, reference, [*keys, *(["_weekday"] if drift_type == "seasonal" else [])], match


def drift_table(measures: DataFrame, score: str, extra: list[str] | None = None) -> DataFrame:
    """The stored drift table: the score of each window, and further measures as rows of their own.

    Rows of further measures carry their name in ``metric_name`` and are kept apart from
    the score by it, so thresholds apply to the score rows.
    """
    shaped = with_unused_keys(measures)
    names = [score, *(extra or [])]
    rows = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit("drift_score" if n == score else n).alias("metric_name"),
                    F.col(n).alias("drift_score"),
                )
                for n in names
            ]
        )
    )
    other = [c for c in DRIFT_COLUMNS if c not in ("metric_name", "drift_score")]
    return shaped.select(*other, rows).select(*DRIFT_COLUMNS)


def drift(
    df: DataFrame,
    spec: MonitorSpec,
    numeric: list[str],
    categorical: list[str],
    baseline: DataFrame | None = None,
    drift_types: tuple[str, ...] | None = None,
    exact: bool = False,
    bins: int = DEFAULT_BINS,
    edges: Edges | None = None,
) -> DataFrame:
    """The drift table of a monitor: KS for numeric and total variation for categorical columns.

    Bin edges are estimated from the baseline on each call; give ``edges`` to keep scores
    comparable to the digit from one call to the next. The prediction column, if named among the columns, is treated like any other.
    """
    parts = []
    for drift_type in drift_types or (default_drift_type(baseline),):
        if categorical:
            measured = categorical_drift(df, spec, categorical, baseline, drift_type)
            parts.append(drift_table(measured, "total_variation"))
        if numeric and exact:
            parts.append(drift_table(exact_numeric_drift(df, spec, numeric, baseline, drift_type), "ks"))
        elif numeric:
            measured = numeric_drift(
                df, spec, numeric, baseline, drift_type, edges, bins, measures=("ks",)
            )
            parts.append(drift_table(measured, "ks"))
    if not parts:
        raise ValueError("no column to compare")
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def null_rate_change(
    df: DataFrame, spec: MonitorSpec, columns: list[str], baseline: DataFrame, types: dict[str, str] | None = None
) -> DataFrame:
    """Change of null share, and of mistyped share where a type is given, against the baseline."""
    types = types or {}
    flags = {f"{c}.null": F.col(c).isNull() for c in columns}
    flags |= {f"{c}.mistyped": F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()}
    shares = [F.avg(F.col(f"`{n}`").cast("int")).alias(n) for n in flags]
    rows, keys = grouped_rows(df, spec, flags)
    base_rows, base_keys = grouped_rows(baseline, spec, flags, windowed=False)
    windows = rows.groupBy(*keys).agg(*shares)
    reference = base_rows.groupBy(*base_keys).agg(*shares)

    def long(wide: DataFrame, by: list[str], name: str) -> DataFrame:
        cells = [
            F.struct(
                F.lit(n.rsplit(".", 1)[0]).alias("column_name"),
                F.lit(n.rsplit(".", 1)[1]).alias("check_name"),
                F.col(f"`{n}`").alias(name),
            )
            for n in flags
        ]
        return wide.select(*by, F.inline(F.array(*cells)))

    match = [*(SLICE_KEYS if spec.slicing_exprs else []), "column_name", "check_name"]
    return join_groups(
        long(windows, keys, "window_share"), long(reference, base_keys, "baseline_share"), match, "left"
    ).withColumn("share_change", F.col("window_share") - F.col("baseline_share"))
