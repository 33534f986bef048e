"""Distributions as counts: bins, value counts, running totals, exact quantiles.

Everything that needs an order (quantiles, empirical distribution functions, ranks)
works on counts per distinct value, cut into bins. A running total is then the sum over
the lower bins plus a running sum inside one bin, so the rows of one window, however
many, are spread over as many tasks as there are bins, and a value that fills a third
of the table is one row.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import join_groups, quoted

DEFAULT_BINS = 256
# Entries of the sketch that edges are taken from.
EDGE_SKETCH_SIZE = 4096
# Partial sketches are merged in this many groups before the last merge.
MERGE_GROUPS = 256

Edges = dict[str, list[float]]


def ranks_of_sketch(sketch: str, ranks: str) -> str:
    """SQL for the values at some ranks; an empty sketch has none."""
    return (
        f"CASE WHEN kll_sketch_get_n_double({sketch}) > 0 "
        f"THEN kll_sketch_get_quantile_double({sketch}, array({ranks})) END"
    )


def rank_bins(df: DataFrame) -> int:
    """Bins for work that needs exact ranks: about one per shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(256, min(EDGE_SKETCH_SIZE, partitions))


def approx_edges(df: DataFrame, columns: list[str], bins: int | None = None) -> Edges:
    """Inner bin edges at equal steps of the distribution, one small job for all columns.

    ``columns x bins`` numbers reach the driver. Where they fall decides how even the
    work is; results that need exact ranks do not depend on them. Values that fill whole
    steps leave few edges; where a column has many other values, these are cut once more
    without the frequent ones, so that a dominant value does not put all others into one bin.
    """
    if not columns:
        return {}
    bins = rank_bins(df) if bins is None else bins
    edges: dict[str, set[float]] = {c: set() for c in columns}
    aside: dict[str, set[float]] = {c: set() for c in columns}
    crowded = list(columns)
    while crowded:
        again = []
        for c, (cuts, distinct) in _steps(df, crowded, bins, aside).items():
            frequent = {x for x, n in Counter(cuts).items() if n > 1} - aside[c]
            edges[c] |= set(cuts)
            aside[c] |= frequent
            if frequent and len(set(cuts)) < bins // 2 and distinct > 4 * bins:
                again.append(c)
        crowded = again
    return {c: _distinct_edges(list(edges[c])) for c in columns}


def even_cuts(df: DataFrame, columns: list[str], bins: int) -> Edges:
    """Numbers between neighbouring values that cut each column into ``bins`` parts of like size at most.

    A column of so few values is cut between all of them. The distribution is read from a
    sketch at :data:`EDGE_SKETCH_SIZE` steps, least and greatest value included, so no cut meets a value.
    """
    if not columns:
        return {}
    found = _steps(df, columns, EDGE_SKETCH_SIZE, {c: set() for c in columns}, ends=True)
    return {c: _cuts_between(values, bins) for c, (values, _) in found.items()}


def _cuts_between(values: list[float], bins: int) -> list[float]:
    """The middles between different neighbours that are nearest to equal steps."""
    counts = sorted(Counter(values).items())
    cuts, step, reached, target = [], len(values) / bins, 0, len(values) / bins
    for (low, n), (high, more) in zip(counts, counts[1:]):
        reached += n
        if len(counts) <= bins or abs(reached - target) < abs(reached + more - target):
            cuts.append(low / 2 + high / 2)
            target += step
    return _distinct_edges([x for x in cuts if abs(x) < float("inf")])


def _steps(
    df: DataFrame, columns: list[str], bins: int, aside: dict[str, set[float]], ends: bool = False
) -> dict[str, tuple[list[float], float]]:
    """Per column the values at equal steps and how many different ones there are, without those set aside.

    With ``ends`` the least and the greatest value too.

    The sketches of the map tasks are merged in groups first, so the last task never meets
    one per map task.
    """
    steps = ", ".join(f"{i / bins!r}D" for i in range(0 if ends else 1, bins + ends))
    size = EDGE_SKETCH_SIZE

    def value(c: str) -> str:
        number = f"CAST({quoted(c)} AS double)"
        left_out = " OR ".join([f"isnan({number})", *[f"{number} = {x!r}D" for x in sorted(aside[c])]])
        return f"CASE WHEN NOT ({left_out}) THEN {number} END"

    rows = df.selectExpr(
        f"pmod(spark_partition_id(), {MERGE_GROUPS}) AS _group",
        *[f"{value(c)} AS _c{i}" for i, c in enumerate(columns)],
    )
    hashed = "CASE WHEN _c{0} IS NOT NULL THEN xxhash64(_c{0}) END"
    grouped = rows.groupBy("_group").agg(
        *[F.expr(f"kll_sketch_agg_double(_c{i}, {size}) AS _s{i}") for i in range(len(columns))],
        *[F.expr(f"hll_sketch_agg({hashed.format(i)}) AS _d{i}") for i in range(len(columns))],
    )
    merged = grouped.agg(
        *[F.expr(f"kll_merge_agg_double(_s{i}, {size}) AS _s{i}") for i in range(len(columns))],
        *[F.expr(f"hll_sketch_estimate(hll_union_agg(_d{i})) AS _d{i}") for i in range(len(columns))],
    )
    row = merged.selectExpr(*[ranks_of_sketch(f"_s{i}", steps) for i in range(len(columns))], *[f"_d{i}" for i in range(len(columns))]).first()
    cuts = [[x for x in found or [] if x is not None and x == x] for found in row[: len(columns)]]
    return {c: (cut, distinct or 0) for c, cut, distinct in zip(columns, cuts, row[len(columns) :])}


# Bins between a number and its double.
BINS_PER_DOUBLING = 4096


def fixed_bin(value: Column) -> Column:
    """A bin that grows with the value and depends on nothing else: no edges, and no scan to find them.

    Every doubling is cut into :data:`BINS_PER_DOUBLING`; what is nearer to 0 than 1e-290 shares a bin, and
    NaN and null have none. Where rounding puts a number just below a power of two above it, the
    negative remainder leads back to the last bin of the doubling below.
    """
    x = value.cast("double")
    size = F.least(F.abs(x), F.lit(1e300))
    power = F.floor(F.log2(size))
    inside = F.floor((size * F.pow(F.lit(2.0), -power) - 1) * BINS_PER_DOUBLING)
    at = (power + 1000) * BINS_PER_DOUBLING + inside
    return F.when(x.isNull() | F.isnan(x), None).when(size < 1e-290, 0).when(x < 0, -at).otherwise(at).cast("int")


def exact_edges(df: DataFrame, columns: list[str], bins: int) -> Edges:
    """As ``approx_edges``, at the exact interpolated quantiles."""
    if not columns:
        return {}
    steps = [i / bins for i in range(1, bins)]
    long = numeric_long(df, [], columns, approx_edges(df, columns))
    found = exact_quantiles(value_counts(long, ["column_name"]), ["column_name"], steps).collect()
    return {
        c: _distinct_edges([r["quantile_value"] for r in found if r["column_name"] == c]) for c in columns
    }


def joint_edges(*edges: Edges) -> Edges:
    """Edges that cut all the given distributions evenly."""
    columns = {c for e in edges for c in e}
    return {c: _distinct_edges([x for e in edges for x in e.get(c, [])]) for c in columns}


def _distinct_edges(values: list[float]) -> list[float]:
    # a NaN edge would sort above every number and take no part in the binning
    return sorted({float(v) for v in values if v is not None and v == v})


def with_bins(df: DataFrame, columns: list[str], edges: Edges) -> DataFrame:
    """Add ``_bin_<column>``: how many edges are at or below the value."""
    cut = [c for c in columns if edges.get(c)]
    binned = df
    if cut:
        binned = Bucketizer(
            splitsArray=[[-float("inf"), *edges[c], float("inf")] for c in cut],
            inputCols=cut,
            outputCols=[f"_bin_{c}" for c in cut],
            handleInvalid="keep",
        ).transform(df)
    for c in columns:
        if c not in cut:
            binned = binned.withColumn(f"_bin_{c}", F.lit(0.0))
    return binned


def numeric_long(df: DataFrame, keys: list[str], columns: list[str], edges: Edges) -> DataFrame:
    """One row per numeric value: keys, column_name, bin, value. Null and NaN have no bin."""
    as_double = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    cells = []
    for c in columns:
        value = F.when(~F.isnan(c), F.col(c))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.when(value.isNotNull(), F.col(f"_bin_{c}").cast("int")).alias("bin"),
                value.alias("value"),
            )
        )
    return with_bins(as_double, columns, edges).select(*keys, F.inline(F.array(*cells)))


def category_long(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per categorical value: keys, column_name, value as text."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return df.select(*keys, F.inline(F.array(*cells)))


def value_counts(long: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per distinct value (and its bin, for numeric columns); a null value keeps its count."""
    cell = [c for c in ("bin", "value") if c in long.columns]
    return long.groupBy(*keys, *cell).agg(F.count("*").alias("n"))


def bin_counts(long: DataFrame, keys: list[str]) -> DataFrame:
    return long.groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def running_totals(
    counts: DataFrame, keys: list[str], weights: list[str], value: str = "value"
) -> DataFrame:
    """Add ``before_<w>`` and ``total_<w>``: a weight over all smaller values, and over the group.

    ``counts`` has one row per group and value, with the bin of the value. The total
    comes with the sums over bins, so the values of a group never have to meet.
    """
    # a bin that is never null keeps the join below a plain equi-join, which can use the
    # partitioning of the window inside the bins
    binned = counts.withColumn("_bin", F.coalesce("bin", F.lit(-1)))
    inside = (
        Window.partitionBy(*keys, "_bin").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per group and bin: the number of bins is a parameter, not a data size
    across = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    below = (
        binned.groupBy(*keys, "_bin")
        .agg(*[F.sum(w).alias(f"_bin_{w}") for w in weights])
        .select(
            *keys,
            "_bin",
            *[F.coalesce(F.sum(f"_bin_{w}").over(across), F.lit(0)).alias(f"_below_{w}") for w in weights],
            *[F.sum(f"_bin_{w}").over(Window.partitionBy(*keys)).alias(f"total_{w}") for w in weights],
        )
    )
    ranked = binned.select(
        "*", *[F.coalesce(F.sum(w).over(inside), F.lit(0)).alias(f"_inside_{w}") for w in weights]
    )
    return join_groups(ranked, below, [*keys, "_bin"], "inner").select(
        *counts.columns,
        *[(F.col(f"_below_{w}") + F.col(f"_inside_{w}")).alias(f"before_{w}") for w in weights],
        *[f"total_{w}" for w in weights],
    )


def exact_quantiles(counts: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """Interpolated quantiles per group from value counts: ``probability, quantile_value``.

    A quantile lies between the values at two ranks; each is the value whose counts
    cover that rank. No task holds the values of a whole group.
    """
    # a null value weighs nothing; dropping it here would make these counts a different
    # shuffle from the ones a caller uses elsewhere, and the table would be read twice
    weighed = counts.withColumn("n", F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    sized = running_totals(weighed, keys, ["n"])
    first, last = F.col("before_n"), F.col("before_n") + F.col("n") - 1
    picks = []
    for i, p in enumerate(probabilities):
        position = (F.col("total_n") - 1) * F.lit(float(p))
        low, high = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when((first <= low) & (low <= last), F.col("value"))).alias(f"_low{i}"),
            F.max(F.when((first <= high) & (high <= last), F.col("value"))).alias(f"_high{i}"),
            F.max(position - low).alias(f"_part{i}"),
        ]
    found = sized.groupBy(*keys).agg(*picks)
    rows = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            (F.col(f"_low{i}") + (F.col(f"_high{i}") - F.col(f"_low{i}")) * F.col(f"_part{i}")).alias(
                "quantile_value"
            ),
        )
        for i, p in enumerate(probabilities)
    ]
    return found.select(*keys, F.inline(F.array(*rows)))


def per_column(numbers: dict[str, list[float]]) -> Column:
    """A list of numbers for each ``column_name``, as one constant."""
    return F.from_json(F.lit(json.dumps(numbers)), "map<string,array<double>>")[F.col("column_name")]


def histogram(df: DataFrame, keys: list[str], columns: list[str], edges: Edges) -> DataFrame:
    """Counts per bin of shared edges, with the bounds of each bin."""
    counts = bin_counts(numeric_long(df, keys, columns, edges), [*keys, "column_name"])
    return with_bin_bounds(counts.where(F.col("bin").isNotNull()), columns, edges)


def with_bin_bounds(counts: DataFrame, columns: list[str], edges: Edges) -> DataFrame:
    """Lower and upper edge of each bin; null where the bin is open."""
    bounds = per_column({c: edges.get(c, []) for c in columns})
    return counts.withColumn("lower", F.get(bounds, F.col("bin") - 1)).withColumn(
        "upper", F.get(bounds, F.col("bin"))
    )
