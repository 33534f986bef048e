"""Exact duplicates by sorting the content itself.

Rows are range-partitioned by the first characters of their normalised text and, where texts
begin alike, a hash of the whole: Spark samples these short keys and takes the splitters
from the sample, so no whole text reaches the driver. Each partition is sorted outside
memory if need be, equal texts come to stand side by side, and a window over the text
compares every row with its neighbour in full. A text that the sample shows to hold a large share of the rows gets
several runs in different partitions; the heads of such runs are compared once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.columns import quoted
from tidegauge.llm.common import pick, stage, unused

#: Rows sampled to find texts that are too frequent for one run, and the share that makes them so.
SAMPLED = 200_000
HOT_SHARE = 1 / 500
#: Characters of a text that splitters look at before its hash.
BEGINNING = 32


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def hot_texts(texts: DataFrame, n: int, sampled: int = SAMPLED) -> DataFrame:
    """``hot``, ``runs``: hashes of frequent texts (column ``norm``) and over how many runs to deal their rows.

    At most ``1 / HOT_SHARE`` texts or so can hold that share of the sample each, however
    many rows there are, so the result may be broadcast.
    """
    partitions = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fraction = min(1.0, sampled / max(n, 1))
    least = max(16, int(n * fraction * HOT_SHARE))
    return (
        texts.sample(fraction, 17).groupBy(F.xxhash64("norm").alias("hot")).agg(F.count("*").alias("rows"))
        .where(F.col("rows") >= least)
        .select("hot", F.ceil(F.col("rows") * (partitions / max(1.0, n * fraction))).cast("int").alias("runs"))
    )


def sorted_runs(rows: DataFrame, norm: str, run: str, hot: str, n: int) -> tuple[DataFrame, list[str]]:
    """``rows`` with ``run`` and ``hot``, range-partitioned, and the columns that the rows of one run share.

    The whole text is among those columns, so a window over them compares it in full.
    """
    frequent, runs, beginning, hashed = (unused(rows, c) for c in ("frequent", "runs", "beginning", "hash"))
    found = stage(hot_texts(rows.select(F.col(norm).alias("norm")), n), "hot-texts").toDF(frequent, runs)
    dealt = rows.join(F.broadcast(found), F.xxhash64(F.col(norm)) == F.col(frequent), "left")
    spread = F.pmod(F.monotonically_increasing_id(), F.coalesce(runs, F.lit(1))).cast("int")
    keyed = dealt.withColumns({
        run: spread, hot: F.col(frequent).isNotNull(), beginning: F.substring(norm, 1, BEGINNING), hashed: F.xxhash64(norm),
    })
    return keyed.drop(frequent, runs).repartitionByRange(beginning, hashed, run), [beginning, hashed, norm, run]


def best_first(keys: list[str], points: str, doc_id: str):
    return Window.partitionBy(*keys).orderBy(F.col(points).desc(), F.col(doc_id).asc_nulls_last())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sampled: int = SAMPLED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they agree byte for byte without white space; the row with the most
    characters in its own text stays, then the one with the smallest id (null last); of rows
    alike in both any one, but one only. Null texts count as empty, and all empty texts are
    one group. Texts of any length are compared whole. An empty table gives an empty result;
    other columns are not looked at.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", normalised(F.col("text")).alias("norm"), F.length(F.coalesce("text", F.lit(""))).alias("points")
    )
    sorted_rows, keys = sorted_runs(rows, "norm", "run", "hot", docs.count())
    order, whole = best_first(keys, "points", "doc_id"), Window.partitionBy(*keys)
    placed = sorted_rows.select(
        "doc_id", "points", "run", "hot", "norm",
        F.row_number().over(order).alias("place"),
        F.first("doc_id").over(order).alias("keep_id"),
        F.count("*").over(whole).alias("group_size"),
    )
    runs = stage(
        placed.select(
            "doc_id", "points", "run", "hot", "place", "keep_id", "group_size",
            F.sha2("norm", 256).alias("text_sha256"),
            F.when(F.col("hot") & (F.col("place") == 1), F.col("norm")).alias("head"),
        ),
        "sorted-runs",
    )
    best = F.min(F.struct((-F.col("points")).alias("fewer"), F.col("doc_id").isNull().alias("last"), "doc_id", "run"))
    # a head per run of a frequent text: their number is bounded by the sample and the partitions
    groups = (
        runs.where("head is not null").groupBy("head")
        .agg(best.alias("best"), F.sum("group_size").alias("size"), F.first("text_sha256").alias("digest"))
        .select("best", "size", "digest")
    )
    alone = runs.where("not hot").select(
        "doc_id", "keep_id", "group_size", (F.col("place") == 1).alias("kept"), "text_sha256"
    )
    together = runs.where("hot").join(F.broadcast(groups), F.col("text_sha256") == F.col("digest")).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("place") == 1) & (F.col("run") == F.col("best.run"))).alias("kept"),
        "text_sha256",
    )
    return alone.unionByName(together)


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sampled: int = SAMPLED) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are; see :func:`exact_duplicates`."""
    names = docs.columns
    norm, points, run, hot, place = (unused(docs, c) for c in ("norm", "points", "run", "hot", "place"))
    text, doc_id = F.col(quoted(text_col)), quoted(id_col)
    rows = docs.withColumns({norm: normalised(text), points: F.length(F.coalesce(text, F.lit("")))})
    sorted_rows, keys = sorted_runs(rows, norm, run, hot, docs.count())
    heads = stage(
        sorted_rows.withColumn(place, F.row_number().over(best_first(keys, points, doc_id))).where(F.col(place) == 1)
        .withColumn(norm, F.when(F.col(hot), F.col(norm))),
        "run-heads",
    )
    best = F.min(F.struct((-F.col(points)).alias("fewer"), F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("id"), F.col(run).alias("run")))
    firsts = heads.where(F.col(hot)).groupBy(F.col(norm).alias("_norm")).agg(best.alias("_best"))
    firsts = firsts.select("_norm", F.col("_best.run").alias("_run"))
    won = heads.where(F.col(hot)).join(
        firsts, (F.col(norm) == F.col("_norm")) & (F.col(run) == F.col("_run")), "left_semi"
    )
    keep = [F.col(quoted(c)) for c in names]
    return heads.where(~F.col(hot)).select(*keep).unionByName(won.select(*keep))


EXACT_DUPLICATES_SQL = r"""
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
      FROM documents)
WINDOW best AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id ASC NULLS LAST)
"""
