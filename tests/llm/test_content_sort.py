"""Exact duplicates against grouping in memory."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import content_sort as cs


def expected(rows):
    """Results without the flag, and the kept ids: of rows alike in length and id any may stay."""
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out, kept = [], Counter()
    for norm, members in groups.items():
        keep = min(members)[3]
        kept[keep] += 1
        out += [(m[3], keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return by_key(out), kept


def agrees(got, rows):
    want, kept = expected(rows)
    got = got.collect()
    assert by_key((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert Counter(r.doc_id for r in got if r.kept) == kept
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_whole_table(spark):
    agrees(cs.exact_duplicates(documents(spark)), [(r.doc_id, r.text) for r in documents(spark).collect()])


def test_odd_rows(spark):
    rows = odd_documents()
    docs = clashing(frame(spark, rows))
    agrees(cs.exact_duplicates(docs), [r[:2] for r in rows])
    assert cs.exact_duplicates(frame(spark, [])).count() == 0
    kept = cs.without_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == expected([r[:2] for r in rows])[1]


@pytest.mark.parametrize("sampled", [200_000, 500])
def test_a_text_with_a_third_of_the_rows(spark, sampled):
    rows = [(i, "hot " * (1 + i % 3) if i % 3 == 0 else f"text {i % 1000}") for i in range(3000)]
    rows += [(0, "h o t"), (None, "hot"), (0, "h o t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    agrees(cs.exact_duplicates(docs, sampled=sampled), rows)
    kept = cs.without_duplicates(docs, sampled=sampled).collect()
    assert Counter(r.doc_id for r in kept) == expected(rows)[1]


def test_a_hot_text_has_runs_in_several_partitions(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same").alias("norm"), F.lit(4).alias("points"))
    found = cs.hot_texts(docs, 4000).collect()
    assert len(found) == 1 and found[0].runs == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_one_range_exchange_and_no_python(spark):
    rows = documents(spark).select("doc_id", cs.normalised(F.col("text")).alias("norm"), F.length("text").alias("points"))
    sorted_rows, keys = cs.sorted_runs(rows, "norm", "run", "hot", 200)
    placed = sorted_rows.withColumn("place", F.row_number().over(cs.best_first(keys, "points", "doc_id")))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    assert "Python" not in plan and "Arrow" not in plan
