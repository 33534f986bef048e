"""Weighted rendezvous hashing of record keys over shards.

Every (key, shard) pair draws a number from a hash; the shard with the best draw, scaled by
its weight, gets the record. A record depends on its key and the shards alone, so rows need
no shuffle to be placed, and a new shard takes only those records for which it draws best.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import pick, stage

#: Copies of one record that are turned back into rows at a time.
PIECE = 100_000


def best_draw(key: Column, weights: Mapping[int, float] | Sequence[float]) -> Column:
    """``cost`` and ``shard`` of a key: the smallest ``-ln(u) / weight`` over the shards, ``u`` drawn from a hash.

    ``weights`` maps shard numbers to weights, or lists the weights of shards 0, 1, ...; a
    shard of weight 0 gets nothing. Null keys are one key of their own.
    """
    pairs = list(weights.items()) if isinstance(weights, Mapping) else list(enumerate(weights))
    pairs = [(int(s), float(w)) for s, w in pairs if w > 0]
    if not pairs:
        raise ValueError("no shard has a weight above 0")
    name = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))

    def draw(shard: int, weight: float) -> Column:
        # 52 bits of the digest, in the middle of their steps so that the logarithm is finite
        digits = F.substring(F.md5(F.concat(name, F.lit(f":{shard}")).cast("binary")), 1, 13)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.log(u) / F.lit(weight)).alias("cost"), F.lit(shard).alias("shard"))

    draws = [draw(s, w) for s, w in pairs]
    return F.least(*draws) if len(draws) > 1 else draws[0]


def shard_of(key: Column, weights: Mapping[int, float] | Sequence[float]) -> Column:
    """The shard of a key alone; see :func:`best_draw`."""
    return best_draw(key, weights)["shard"]


def with_slots(records: DataFrame, shard: str = "shard") -> DataFrame:
    """``records`` with ``slot``: its place from 0 within its shard, ordered by the columns from left to right.

    All columns must be comparable; nulls come first. Equal records are counted before they
    are numbered, and a shard is cut into ranges numbered side by side, whose first slots are
    running sums of the ranges' sizes, so neither a shard nor a repeated record is one
    task's work: the copies of a record are turned back into rows in pieces of
    :data:`PIECE`, dealt out over the tasks.
    """
    columns = records.columns
    counted = records.groupBy(*columns).agg(F.count("*").alias("_copies"))
    ranged = stage(counted.repartitionByRange(shard, *columns).withColumn("_range", F.spark_partition_id()), "records")
    sizes = ranged.groupBy(F.col(shard).alias("_shard"), F.col("_range").alias("_of")).agg(F.sum("_copies").alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_shard", "_of", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(shard, "_range").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_at", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    known = placed.join(starts, (F.col(shard) == F.col("_shard")) & (F.col("_range") == F.col("_of"))).select(
        *columns, "_copies", (F.col("_start") + F.col("_at")).alias("_first")
    )
    if ranged.where(F.col("_copies") > PIECE).isEmpty():
        return _as_rows(known, columns)
    pieces = known.where(F.col("_copies") > PIECE).withColumn(
        "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(PIECE).cast("long")))
    ).select(
        *columns, F.least(F.lit(PIECE).cast("long"), F.col("_copies") - F.col("_piece")).alias("_copies"),
        (F.col("_first") + F.col("_piece")).alias("_first"),
    )
    dealt = pieces.repartition(shard, "_first")
    return _as_rows(known.where(F.col("_copies") <= PIECE), columns).union(_as_rows(dealt, columns))


def _as_rows(records: DataFrame, columns: list[str]) -> DataFrame:
    """Records with a number of copies as rows, with the slots from ``_first`` on."""
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)).alias("_copy")
    return records.select(*columns, "_first", copy).select(*columns, (F.col("_first") + F.col("_copy")).alias("slot"))


def shard_documents(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The shard and slot of every row under the law ``key``, and its shard with one shard more.

    ``size`` is the text's bytes (null: none) plus 8, ``text_crc32`` that of those bytes.
    Null ids are one key; repeated rows share a shard and take a slot each; an empty table
    gives an empty result; other columns are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    records = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        best_draw(F.col("doc_id"), [1.0] * shards).alias("best"),
        best_draw(F.col("doc_id"), {shards: 1.0}).alias("newcomer"),
    ).select(
        "doc_id", "size", "text_crc32", "law",
        F.col("best.shard").alias("shard"),
        F.least("best", "newcomer")["shard"].alias("grown_shard"),
    )
    return with_slots(records)


#: crc32 is not in every SQL dialect: a table from its polynomial, then byte by byte.
SHARDS_SQL = """
WITH crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
bytes AS (SELECT DISTINCT text, hex(encode(text)) AS h FROM texts),
crcs AS (
  SELECT text, xor(list_reduce(
           list_transform(range(1, length(h), 2), lambda p: ('0x' || substr(h, p::INT, 2))::BIGINT),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295) AS crc
  FROM bytes, crc_table),
draws AS (
  SELECT row, shard, -ln((('0x' || substr(md5(key || ':' || shard), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496) AS cost
  FROM (SELECT row_number() OVER () AS row, coalesce('k' || doc_id::VARCHAR, 'null') AS key FROM texts),
       (SELECT unnest(range(25)) AS shard)),
placed AS (SELECT row, arg_min(shard, (cost, shard)) FILTER (shard < 24) AS shard, arg_min(shard, (cost, shard)) AS grown FROM draws GROUP BY row)
SELECT doc_id, octet_length(encode(text)) + 8 AS size, crc AS text_crc32, 'key' AS law, shard::INT AS shard, grown::INT AS grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, octet_length(encode(text)), crc) - 1 AS slot
FROM (SELECT row_number() OVER () AS row, * FROM texts) JOIN placed USING (row) JOIN crcs USING (text)
"""
