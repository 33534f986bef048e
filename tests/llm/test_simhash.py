"""SimHash near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from tests.llm.helpers import by_key, clashing, documents, frame, odd_documents
from tidegauge.llm import simhash_pivots as sp
from tidegauge.llm.components import components


def plain_print(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=4):
    """Smallest position reachable, by comparing all pairs."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def expected(rows):
    prints = [plain_print(t) for _, t in rows]
    groups = plain_groups(prints)
    least = {g: min((i for (i, _), h in zip(rows, groups) if h == g and i is not None), default=None) for g in groups}
    return [(i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, groups)]


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert by_key(sp.near_duplicates(documents(spark)).collect()) == by_key(expected(rows))


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_documents()
    got = sp.near_duplicates(clashing(frame(spark, rows)))
    assert by_key(got.collect()) == by_key(expected([r[:2] for r in rows]))
    assert sp.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("chunk,extra", [(4096, 1), (4096, 2), (20, 1), (7, 2)])
def test_links_of_clusters_and_hot_buckets(spark, chunk, extra):
    """Chains, dense clusters and unrelated prints; small chunks force buckets to be dealt out."""
    random.seed(3)
    prints = [random.getrandbits(64) for _ in range(60)]
    for centre in prints[:4]:
        at = centre
        for _ in range(60):
            at ^= sum(1 << b for b in random.sample(range(64), random.choice([1, 3, 4, 5])))
            prints += [at, centre ^ sum(1 << b for b in random.sample(range(64), 2))]
    prints = sorted(set(prints))
    groups = plain_groups(prints)
    frame_ = spark.createDataFrame([(sp.signed(p),) for p in prints], "fp long")
    edges = sp.link_edges(frame_, 4, chunk, extra)
    for a, b in edges.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= 4
    labels = {r.node: r.label for r in components(edges).collect()}
    ours = [labels.get(sp.signed(p), sp.signed(p)) for p in prints]
    assert len(set(zip(ours, groups))) == len(set(ours)) == len(set(groups))


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(5)
    left = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 4, replace=False)) for _ in left], dtype=np.uint64)
    right = left ^ flips
    tables = sp.distance_table(left), sp.distance_table(right)
    assert len(sp.close_pairs(left, right, tables, 4)) == len(left)


def test_blocks_grow_with_the_number_of_prints():
    assert [sp.blocks_needed(n, 4) for n in (10, 10**5, 10**8, 10**10, 10**11)] == [1, 2, 3, 4, 5]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    found = components(spark.createDataFrame([*chain, *star, (5, 5), (7, 6)], "a long, b long")).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.label, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [50, 201]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = odd_documents()
    kept = sp.first_of_groups(clashing(frame(spark, rows)))
    assert kept.columns == clashing(frame(spark, rows)).columns
    groups = plain_groups([plain_print(r[1]) for r in rows])
    assert kept.count() == len(set(groups))
    ids = {min((r[0] for r, h in zip(rows, groups) if h == g and r[0] is not None), default=None) for g in groups}
    assert {r.doc_id for r in kept.collect()} == ids
