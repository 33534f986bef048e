"""Profiles, request ids and drift on a log that keeps growing."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidegauge.functions.columns import count_where, quoted
from tidegauge.operators.alerts import drift_metrics, evaluate_rules
from tidegauge.operators.drift import share_measures
from tidegauge.operators.profile import state_aggregates
from tidegauge.operators.windows import SLICE_KEYS, WINDOW_KEYS, group_keys, nested_granularities, with_slices
from tidegauge.spec import MonitorSpec


#: Settings of a query whose operators keep state by key.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def read_log_stream(
    spark: SparkSession, path: str, schema: T.StructType, timestamp_col: str, **options: str
) -> DataFrame:
    """A folder of Parquet files as a stream; event time as TIMESTAMP, which watermarks need."""
    reader = spark.readStream.schema(schema)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.parquet(path).withColumn(timestamp_col, F.col(timestamp_col).cast("timestamp"))


def _closed_windows(
    log: DataFrame, spec: MonitorSpec, delay: str, count: Callable[[DataFrame, list], DataFrame]
) -> DataFrame:
    """What ``count`` makes of the rows of each granularity, by window, model and slice.

    ``count`` gets the rows and the grouping columns, the window as ``_window``. Every
    granularity is an aggregation of its own over one stream.
    """
    timed = log.withWatermark(spec.timestamp_col, delay)
    rows = with_slices(timed, spec.slicing_exprs) if spec.slicing_exprs else timed
    by = [F.col(spec.model_id_col).cast("string").alias("model_id")] if spec.model_id_col else []
    by += [F.col(c) for c in SLICE_KEYS] if spec.slicing_exprs else []
    found = None
    for granularity in spec.granularities:
        counted = count(rows, [F.window(spec.timestamp_col, granularity).alias("_window"), *by])
        named = counted.select(
            F.lit(granularity).alias("granularity"),
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            *[quoted(c) for c in counted.columns if c != "_window"],
        )
        found = named if found is None else found.unionByName(named)
    return found


def stream_profile(
    log: DataFrame, spec: MonitorSpec, columns: list[str], delay: str = "1 hour"
) -> DataFrame:
    """Numeric profile per closed window, model and slice; rows later than ``delay`` are dropped.

    State per group has a fixed size: counters, moments and one quantile sketch per column.
    """
    aggregates = [F.count("*").alias("n_rows")]
    for c in columns:
        number = F.col(c).cast("double")
        v = F.when(~F.isnan(number), number)
        aggregates += [
            count_where(F.col(c).isNull()).alias(f"{c}_num_nulls"),
            F.avg(v).alias(f"{c}_avg"),
            F.min(v).alias(f"{c}_min"),
            F.max(v).alias(f"{c}_max"),
            F.stddev(v).alias(f"{c}_stddev"),
            F.percentile_approx(v, 0.5, 10_000).alias(f"{c}_median"),
        ]
    return _closed_windows(log, spec, delay, lambda rows, by: rows.groupBy(*by).agg(*aggregates))


def stream_unique_requests(log: DataFrame, key: str, timestamp_col: str, delay: str = "1 hour") -> DataFrame:
    """The first row per request id; ids are forgotten once ``delay`` has passed."""
    return log.withWatermark(timestamp_col, delay).dropDuplicatesWithinWatermark([key])


def stream_value_counts(
    log: DataFrame, spec: MonitorSpec, columns: list[str], delay: str = "1 hour"
) -> DataFrame:
    """Rows per closed window, model, slice, categorical column and value; one state row per value."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns
    ]

    def count(rows: DataFrame, by: list) -> DataFrame:
        # the cells of a row are told apart from the log's own columns
        long = rows.withColumn("_cell", F.explode(F.array(*cells)))
        named = [F.col("_cell.column_name").alias("column_name"), F.col("_cell.value").alias("value")]
        return long.groupBy(*by, *named).agg(F.count("*").alias("n"))

    return _closed_windows(log, spec, delay, count)


class _LastWindow(StatefulProcessor):
    """Keeps the counts of the last closed window of a group and hands each window on with those before it."""

    def __init__(self, keys: list[str]) -> None:
        self.keys = keys

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "start timestamp, cells array<string>, counts array<long>")

    def handleInputRows(self, key, rows, timers):  # noqa: N802
        windows = pd.concat(rows).sort_values("window_start", kind="stable")
        before = self.last.get() if self.last.exists() else None
        out = []
        for start, group in windows.groupby("window_start", sort=True):
            cells = dict(zip(group["value"], group["n"].astype(int)))
            known = dict(zip(before[1], before[2])) if before is not None else {}
            for value in sorted({*cells, *known}, key=lambda v: (v is None, v or "")):
                out.append((*key, start, group["window_end"].iloc[0], value, cells.get(value, 0), known.get(value, 0)))
            before = (start, list(cells), list(cells.values()))
        self.last.update(before)
        yield pd.DataFrame(out, columns=[*self.keys, "window_start", "window_end", "value", "n", "n_before"])

    def close(self) -> None:
        pass


def consecutive_counts(counts: DataFrame) -> DataFrame:
    """Closed windows' value counts, each beside the counts of the window before it of its group.

    Takes what :func:`stream_value_counts` gives. A value of either window is one row with ``n``
    and ``n_before``, both 0 where the window lacks it; the first window of a group has only zeros
    before it. State per group is one window's values. Run it with :data:`KEYED_STATE`.
    """
    keys = [c for c in counts.columns if c not in ("window_start", "window_end", "value", "n")]
    schema = T.StructType([counts.schema[k] for k in keys])
    for name, kind in (("window_start", "timestamp"), ("window_end", "timestamp"), ("value", "string"), ("n", "long"), ("n_before", "long")):
        schema = schema.add(name, kind)
    return counts.groupBy(*keys).transformWithStateInPandas(_LastWindow(keys), schema, "Append", "None")


def consecutive_scores(pairs: DataFrame) -> DataFrame:
    """Total variation of each window from the one before it, from rows of :func:`consecutive_counts`."""
    keys = [c for c in pairs.columns if c not in ("value", "n", "n_before")]
    known = F.col("value").isNotNull()
    n, before = F.when(known, F.col("n")).otherwise(0), F.when(known, F.col("n_before")).otherwise(0)
    sized = pairs.withColumns({"_n": n, "_b": before}).groupBy(*keys).agg(
        F.sum("_n").alias("window_count"), F.sum("_b").alias("reference_count"), F.collect_list(F.struct("_n", "_b")).alias("_cells")
    )
    gap = F.aggregate(
        "_cells", F.lit(0.0), lambda done, x: done + F.abs(x["_n"] / F.col("window_count") - x["_b"] / F.col("reference_count"))
    )
    measured = F.when((F.col("window_count") > 0) & (F.col("reference_count") > 0), gap / 2)
    return sized.withColumn("total_variation", measured).drop("_cells")


def stream_late_labels(
    log: DataFrame, labels: DataFrame, key: str, log_time: str, label_time: str, wait: str, delay: str = "1 hour"
) -> DataFrame:
    """Log rows with the labels that come within ``wait`` of them; a row without one follows when that time is over.

    Both streams carry a watermark, so state holds the rows of that time only. A row is emitted
    once for each of its labels, and once with a null label if there is none.
    """
    ours = log.withWatermark(log_time, delay)
    theirs = labels.select(
        F.col(key).alias("_key"), F.col(label_time).alias("_label_time"), *[c for c in labels.columns if c not in (key, label_time)]
    ).withWatermark("_label_time", delay)
    in_time = F.expr(f"_label_time >= `{log_time}` AND _label_time <= `{log_time}` + INTERVAL {wait}")
    return ours.join(theirs, (F.col(key) == F.col("_key")) & in_time, "leftOuter").drop("_key", "_label_time")


def stream_profile_states(log: DataFrame, spec: MonitorSpec, columns: list[str], delay: str = "1 hour") -> DataFrame:
    """Mergeable states of the finest closed windows: counters, moments, rank and distinct sketches.

    One aggregation of the rows, whatever the granularities; coarser windows are merged from what
    it stores (:func:`tidegauge.operators.profile.profile_of_merged_states`). State per group is of a fixed size.
    """
    finest = nested_granularities(spec.granularities)
    if finest is None:
        raise ValueError("coarser windows must be made of whole finest ones")
    base = replace(spec, granularities=(finest,))

    def count(rows: DataFrame, by: list) -> DataFrame:
        values = {}
        for c in columns:
            number = F.col(c).cast("double")
            values |= {c: F.when(~F.isnan(number), number), f"{c}.is_nan": F.isnan(number)}
        return rows.withColumns(values).groupBy(*by).agg(*state_aggregates(columns, []))

    return _closed_windows(log, base, delay, count)


def drift_sink(
    baseline_counts: DataFrame,
    path: str,
    spec: MonitorSpec | None = None,
    rules: DataFrame | None = None,
    alerts_path: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that scores the closed windows of a batch and stores them.

    Groups are those of ``spec`` (by default windows alone) and meet the baseline counts of
    their slice. With ``rules`` the batch's violations are stored at ``alerts_path``. In
    append mode all counts of a window arrive in one batch, when the watermark passes its
    end. Each batch writes its own partition, so a batch that is run again after a failure
    replaces its rows instead of adding them twice. A batch without rows writes an empty file,
    so what never fired is an empty table and not a missing one.
    """
    keys = [*(WINDOW_KEYS if spec is None else group_keys(spec)), "column_name"]
    match = [k for k in keys if k in baseline_counts.columns]

    def save(rows: DataFrame, batch_id: int, to: str) -> None:
        rows.write.mode("overwrite").parquet(f"{to}/batch_id={batch_id}")

    def store(batch: DataFrame, batch_id: int) -> None:
        # the counts are read twice below; without the cache the stream state would be too
        counts = batch.persist()
        try:
            scored = share_measures(counts, baseline_counts, keys, match, "value").withColumn(
                "drift_type", F.lit("baseline")
            )
            save(scored, batch_id, path)
            if rules is not None:
                scores = drift_metrics(scored.withColumn("drift_score", F.col("total_variation")))
                save(evaluate_rules(scores, rules, None), batch_id, alerts_path)
        finally:
            counts.unpersist()

    return store


def run_available(stream: DataFrame, path: str, checkpoint: str, settings: dict[str, str] | None = None) -> StreamingQuery:
    """Write everything that is there now to Parquet, append mode, and wait for it.

    ``settings`` hold for this query only: a query keeps the settings it was started with.
    """
    conf = stream.sparkSession.conf
    before = {name: conf.get(name, None) for name in settings or {}}
    for name, value in (settings or {}).items():
        conf.set(name, value)
    try:
        query = (
            stream.writeStream.outputMode("append")
            .format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)
    return query


def run_available_batches(
    stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """As ``run_available`` with a function per batch."""
    query = (
        stream.writeStream.outputMode("append")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
