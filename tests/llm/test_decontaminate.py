"""The positional index against sliding windows over lists of words."""

import hashlib
import re

from pyspark.sql import functions as F

from tests.llm.helpers import SF_DIR, by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import decontaminate as dc


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        have, hit, found = words(text), set(), set()
        places = {}
        for i, w in enumerate(have):
            places.setdefault(w, []).append(i)
        for item, phrase in items:
            phrase = words(phrase)
            size = min(window, len(phrase))
            for at in range(len(phrase) - size + 1 if size else 0):
                part = phrase[at : at + size]
                for start in places.get(part[0], []):
                    if have[start : start + size] == part:
                        hit.update(range(start, start + size))
                        found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(have), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def test_whole_table(spark):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    docs = [(r.doc_id, r.text) for r in documents(spark).collect()]
    want = expected(docs, [(r.item_id, r.text) for r in benchmark.collect()])
    assert any(r[-1] for r in want)
    assert by_key(dc.contaminated_documents(documents(spark), benchmark).collect()) == by_key(want)


def test_odd_rows_small_segments_and_blocks(spark):
    rows = odd_documents()
    items = [
        (1, "quick BROWN fox"), (2, "the lazy dog, and runs far away from all of them; more words that are not there"), (10, "a"),
        (None, "brown fox"), (1, "over the lazy"), (3, None), (4, "..."), (5, "w1 the w2 the w3 the w4 the w5 the w6"), (6, "the the"),
    ]
    benchmark = frame(spark, items, "item_id long, text string")
    want = by_key(expected([r[:2] for r in rows], items))
    docs = clashing(frame(spark, rows))
    assert by_key(dc.contaminated_documents(docs, clashing(benchmark)).collect()) == want
    assert by_key(dc.contaminated_documents(docs, benchmark, segment_bytes=50, block_bytes=20).collect()) == want
    empty = frame(spark, [], "item_id long, text string")
    assert dc.contaminated_documents(docs, empty).where("contaminated").count() == 0
    assert dc.contaminated_documents(frame(spark, []), benchmark).count() == 0


def test_clean_rows_stay_with_all_columns(spark):
    rows = odd_documents()
    benchmark = frame(spark, [(1, "quick brown fox")], "item_id long, text string")
    docs = clashing(frame(spark, rows))
    kept = dc.without_contaminated(docs, benchmark)
    clean = docs.where(~F.lower(F.coalesce("text", F.lit(""))).contains("quick brown fox"))
    assert kept.columns == docs.columns
    assert by_key(kept.collect()) == by_key(clean.collect())


def test_proximity(spark):
    docs = frame(spark, [(1, "a x b y c"), (2, "c b a"), (3, "a b"), (4, "a x x x b c a"), (5, "a a b c")], "doc_id long, text string")
    items = frame(spark, [(1, "a b c"), (2, "a a")], "item_id long, text string")
    found = dc.proximity_matches(dc.build_index(docs), items, 1).collect()
    assert by_key(found) == by_key([(2, "1", 0, 3), (4, "1", 4, 7), (5, "1", 0, 4), (5, "1", 1, 4), (5, "2", 0, 2)])


def test_the_benchmark_never_passes_the_driver(spark, monkeypatch):
    """Windows are cut by tasks; only the numbers of blocks are collected."""
    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", lambda *_, **__: 1 / 0)
    benchmark = frame(spark, [(i, f"one two three w{i} four") for i in range(30)] + [(None, "one two")], "item_id long, text string")
    blocks = dc.phrase_blocks(dc._texts(benchmark, "item_id", "text"), 3, 100)
    assert 1 < len(blocks.numbers) <= 7
    found = {bytes(r.phrase): sorted(r["items"]) for r in spark.read.parquet(blocks.folder).collect()}
    assert found[b"one two three"] == sorted(map(str, range(30))) and found[b"one two"] == [] and found[b"two three w3"] == ["3"]
    assert len(found) == 2 + 60
