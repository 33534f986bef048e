"""The pipeline against its stages done plainly, and the registered queries."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.crosscheck import connect, rows_of
from tests.llm import test_bpe, test_content_sort, test_decontaminate, test_shingle_copies
from tests.llm.helpers import SF_DIR, by_key, clashing, frame, odd_documents
from tidegauge.llm import toxicity
from tidegauge.llm.queries import ORACLES, QUERIES


def test_registered_queries_agree_with_sql(spark):
    connection = connect(SF_DIR)
    for name, sql in ORACLES.items():
        ours, theirs = QUERIES[name](spark, SF_DIR).toPandas(), connection.execute(sql).df()
        assert sorted(ours.columns) == sorted(theirs.columns) and rows_of(ours) == rows_of(theirs), name
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{n}" for n in range(1, 14)), "pipeline"]


def test_pipeline_against_plain_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity_scores(docs, labels).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if not scores[r.doc_id]]
    _, kept = test_content_sort.expected(rows)
    rows = sorted(r for r in rows if kept[r[0]])
    groups = test_shingle_copies.plain_groups([t for _, t in rows])
    rows = [r for i, r in enumerate(rows) if groups[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {r[0] for r in test_decontaminate.expected(rows, items) if not r[-1]}
    rows = [r for r in rows if r[0] in clean]
    want = test_bpe.expected(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), rows)
    assert 0 < len(rows) < docs.count()
    assert by_key(corpus_pipeline.run(spark, SF_DIR).collect()) == by_key(want)


def test_stages_keep_the_columns_and_clean_rows(spark):
    texts = ["clean words of one kind only", "entirely other things stand here", "a third text with nothing odd about it"]
    docs = frame(spark, [(i, t, "en", "src", len(t)) for i, t in enumerate(texts)])
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, SF_DIR)
        assert kept.columns == docs.columns and by_key(kept.collect()) == by_key(docs.collect()), name
    assert re.fullmatch("[a-z_]+", "".join(n for n, _ in corpus_pipeline.STAGES))


def test_odd_rows_and_an_empty_table_pass_all_stages(spark, tmp_path):
    """Nulls, repeated rows and very long texts go through; of equal texts the longest is left, of near copies the smallest id."""
    for rows in (odd_documents(), []):
        folder = f"{tmp_path}/{len(rows)}"
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
        clashing(frame(spark, rows)).write.parquet(f"{folder}/documents.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        kept = {r.doc_id for r in got}
        assert len(got) == len(kept) and kept <= {r[0] for r in rows}
        assert not rows or {2, 5, 7, 9} <= kept and not {0, 1, 3, 4, 6, 8, None} & kept
