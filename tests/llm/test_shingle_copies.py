"""Near copies of the pipeline against the Jaccard similarity of all pairs."""

import random
import re

import pytest

import corpus_pipeline
from tests.llm.helpers import SF_DIR, by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import shingle_copies as sc


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_groups(texts):
    """Smallest position reachable, by comparing all pairs."""
    sets, group = [plain_set(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and (a == b or min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and 5 * len(a & b) >= 4 * len(a | b)):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def least_ids(rows):
    groups = plain_groups([r[1] for r in rows])
    return [min((r[0] for r, h in zip(rows, groups) if h == g and r[0] is not None), default=None) for g in set(groups)]


def copies(n, spoiled, seed=1):
    """Copies of one text, each with some words replaced."""
    random.seed(seed)
    base = [f"w{random.randrange(5000)}" for _ in range(300)]
    for _ in range(n):
        words = list(base)
        for at in random.sample(range(300), random.choice(spoiled)):
            words[at] = f"x{random.random()}"
        yield " ".join(words)


def test_the_stage_drops_what_is_similar(spark):
    """Documents 1 and 177 share 548 of 660 shingles, and differ in 11 bits of a SimHash."""
    rows = sorted((r.doc_id, r.text) for r in documents(spark).collect())
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark), SF_DIR)
    assert by_key((r.doc_id,) for r in kept.collect()) == by_key((i,) for i in least_ids(rows))
    assert 177 not in {r.doc_id for r in kept.collect()}


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_documents()
    docs = clashing(frame(spark, rows))
    kept = sc.first_of_groups(docs)
    assert kept.columns == docs.columns
    assert by_key((r.doc_id,) for r in kept.collect()) == by_key((i,) for i in least_ids(rows))
    assert sc.first_of_groups(frame(spark, [])).count() == 0


@pytest.mark.parametrize("chunk,columns,first", [(256, 8192, 4), (3, 64, 1), (1, 7, 0)])
def test_clusters_chains_and_large_buckets(spark, monkeypatch, chunk, columns, first):
    for name, value in (("CHUNK", chunk), ("COLUMNS", columns), ("FIRST", first)):
        monkeypatch.setattr(sc, name, value)
    texts = [t for seed in range(4) for t in copies(40, [2, 5, 7, 9, 14], seed)]
    random.seed(2)
    chain = [f"v{i}" for i in range(500)]
    texts += [" ".join(chain[at : at + 200]) for at in range(0, 300, 20)]
    random.shuffle(texts)
    rows = list(enumerate(texts))
    kept = sc.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    want = least_ids(rows)
    assert 5 < len(want) < len(rows)
    assert by_key((r.doc_id,) for r in kept.collect()) == by_key((i,) for i in want)


def test_pairs_at_the_bound_share_a_band():
    random.seed(6)
    for _ in range(300):
        shared, ours, theirs = ([random.getrandbits(64) for _ in range(n)] for n in (160, 20, 20))
        a, b = (sc.np.unique(sc.np.array(shared + own, dtype=sc.np.uint64)) for own in (ours, theirs))
        assert (sc.bands(a) == sc.bands(b)).any()


def test_no_pair_of_the_given_documents_is_missed(spark):
    """All 48 pairs of distinct texts at sf0.1 with a similarity of 0.8 or more share a band.

    Pairs are found by counting common shingles among all documents, which is exact.
    """
    texts = sorted({r.text for r in documents(spark, "/root/testdata/sf0.1").select("text").collect() if r.text})
    sets = [sc.shingles(t) for t in texts]
    holders = {}
    for i, found in enumerate(sets):
        for h in found.tolist():
            holders.setdefault(h, []).append(i)
    common = {}
    for group in holders.values():
        for x, a in enumerate(group):
            for b in group[x + 1 :]:
                common[a, b] = common.get((a, b), 0) + 1
    different = {(a, b) for (a, b), n in common.items() if n * 9 >= (len(sets[a]) + len(sets[b])) * 4 and n != max(len(sets[a]), len(sets[b]))}
    keys = {i: set(sc.bands(sets[i]).tolist()) for pair in different for i in pair}
    assert len(different) == 48 and all(keys[a] & keys[b] for a, b in different)


@pytest.mark.parametrize("columns", [3, 50, 8192])
def test_common_values_by_products(monkeypatch, columns):
    monkeypatch.setattr(sc, "COLUMNS", columns)
    rng = sc.np.random.default_rng(3)
    sets = [sc.np.unique(rng.integers(0, 90, rng.integers(0, 60))) for _ in range(12)]
    assert sc.common_counts(sets).tolist() == [[len(set(a) & set(b)) for b in sets] for a in sets]


def test_a_collision_of_half_hashes_brings_back_all_pairs(spark, monkeypatch):
    """Pairs that fail the verification lead to one of all pairs, so none that is similar is lost."""
    texts = [*copies(12, [2, 5, 9], 1), *copies(12, [3, 7], 2)]
    rows = list(enumerate(texts))
    calls, real = [], sc.verified

    def verified(pairs, sets):
        calls.append(pairs)
        found = real(pairs, sets)
        return found.limit(0) if len(calls) == 2 else found

    monkeypatch.setattr(sc, "verified", verified)
    monkeypatch.setattr(sc, "FIRST", 0)
    kept = sc.first_of_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert by_key((r.doc_id,) for r in kept.collect()) == by_key((i,) for i in least_ids(rows))
    assert len(calls) == 3


def test_a_forest_connects_what_its_pairs_connect():
    rng = sc.np.random.default_rng(8)
    i, j = rng.integers(0, 40, (2, 300))
    keep = sc.forest_of(i, j, 40)
    assert keep.sum() == 39 and sc.forest_of(i[keep], j[keep], 40).all()


def test_pivots_link_copies_that_the_overlap_confirms(spark):
    """Copies with one word replaced link by their SimHashes; a text that only shares the SimHash does not."""
    from pyspark.sql import functions as F

    texts = [*copies(4, [1]), "other words that stand for themselves and nothing else at all"]
    sets = [sc.shingles(t) for t in texts]
    prints = [sc.signed(sc.majority(s)) for s in sets]
    near = {(i, j) for i in range(4) for j in range(i + 1, 4) if (prints[i] ^ prints[j]).bit_count() <= 4}
    heads = spark.createDataFrame([*enumerate(prints), (5, prints[0])], "id long, fp long")
    hashes = [(i, s.view("int64").tolist()) for i, s in enumerate([*sets, sets[4]])]
    found = {(r.a, r.b) for r in sc.pivot_edges(heads, spark.createDataFrame(hashes, "id long, hashes array<long>")).collect()}
    assert near and found and found <= near
    assert {i for pair in found for i in pair} == {i for pair in near for i in pair}
    signed = spark.createDataFrame([(t,) for t in texts], "text string").select(sc._signature(F.col("text")).alias("s")).select("s.fp")
    assert sorted(r.fp for r in signed.collect()) == sorted(prints)
