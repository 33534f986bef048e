"""Rendezvous hashing: the law, the balance, the moves, the slots."""

import hashlib
import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clashing, documents, frame, odd_documents
from tidegauge.llm import rendezvous as rv


def plain_shard(key, weights):
    name = "null" if key is None else f"k{key}"

    def cost(shard):
        return -math.log((int(hashlib.md5(f"{name}:{shard}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / weights[shard]

    return min((s for s in weights if weights[s] > 0), key=lambda s: (cost(s), s))


def check_slots(rows):
    for shard in {r.shard for r in rows}:
        own = sorted((r for r in rows if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        ids = [(r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in own]
        assert ids == sorted(ids)


def test_whole_table_and_moves(spark):
    rows = rv.shard_documents(documents(spark)).collect()
    texts = {r.doc_id: r.text or "" for r in documents(spark).collect()}
    for r in rows:
        assert r.shard == plain_shard(r.doc_id, dict.fromkeys(range(24), 1.0))
        assert r.grown_shard in (r.shard, 24) and r.grown_shard == plain_shard(r.doc_id, dict.fromkeys(range(25), 1.0))
        assert (r["size"], r.text_crc32, r.law) == (len(texts[r.doc_id].encode()) + 8, zlib.crc32(texts[r.doc_id].encode()), "key")
    check_slots(rows)


def test_odd_rows(spark):
    rows = odd_documents()
    got = rv.shard_documents(clashing(frame(spark, rows))).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    check_slots(got)
    assert rv.shard_documents(frame(spark, [])).count() == 0


def test_a_repeated_record_over_a_third_of_the_rows(spark):
    rows = spark.range(900).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    got = rv.shard_documents(rows).collect()
    assert len(got) == 900
    check_slots(got)


def test_weights(spark):
    weights = {3: 1.0, 5: 2.0, 8: 0.0, 9: 1.0}
    keys = spark.range(20_000)
    counts = {r.s: r["count"] for r in keys.groupBy(rv.shard_of(F.col("id"), weights).alias("s")).count().collect()}
    assert set(counts) == {3, 5, 9} and abs(counts[5] / 20_000 - 0.5) < 0.02
    heavier = keys.select(rv.shard_of(F.col("id"), weights).alias("a"), rv.shard_of(F.col("id"), weights | {9: 3.0}).alias("b"))
    assert {r.b for r in heavier.where("a <> b").collect()} == {9}  # rows move only to the shard that gained
    some = keys.limit(300).select("id", rv.shard_of(F.col("id"), weights).alias("s")).collect()
    assert all(r.s == plain_shard(r.id, weights) for r in some)
    with pytest.raises(ValueError):
        rv.shard_of(F.col("id"), {1: 0.0})


def test_plan_has_no_python(spark):
    plan = rv.shard_documents(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("piece", [1, 7, 100_000])
def test_copies_in_pieces(spark, monkeypatch, piece):
    """A record on a third of all rows comes back in pieces, with every slot once."""
    monkeypatch.setattr(rv, "PIECE", piece)
    rows = [(i, f"t{i}", None, None, 0) for i in range(60)] + [(5, "hot", None, None, 0)] * 40
    got = rv.shard_documents(frame(spark, rows), shards=3).collect()
    assert len(got) == 100
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sum(r.size == 11 and r.doc_id == 5 for r in got) == 40
