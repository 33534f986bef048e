"""Hard negatives against plain integer products of all pairs."""

import math

import numpy as np
import pytest

from tests.llm.helpers import SF_DIR, by_key
from tidegauge.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, row int, score string"


def plain(rows, scale=256.0, every=50, positives=5, negatives=3, shift=True):
    kept = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if shift and vec_id is not None and vec_id % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept.append((vec_id, [math.floor(scale * float(x)) for x in v], label))
    out = []
    for i, (anchor, a, label) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), vec_id is None, vec_id or 0, other) for j, (vec_id, v, other) in enumerate(kept) if j != i]
        scored.sort(key=lambda r: r[:3])
        for p, _, pid, other in [r for r in scored if r[3] == label][:positives]:
            low_high = [r for r in scored if r[3] != label and 50 * -p <= 100 * -r[0] <= 95 * -p]
            out += [(anchor, pid, k + 1, r[2] if not r[1] else None, -p, -r[0]) for k, r in enumerate(low_high[:negatives])]
    return out


def collected(df):
    return by_key([(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()])


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want = plain(rows)
    assert len(want) > 50
    assert collected(hn.mined_embeddings(df)) == by_key(want)


@pytest.mark.parametrize("rows_per_block,anchors_per_block", [(4096, 2048), (7, 2)])
def test_odd_rows_blocks_and_clashing_columns(spark, rows_per_block, anchors_per_block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)], i % 3, i, "x") for i in range(160)]
    same = [float(np.float32(x)) for x in rng.normal(size=4)]
    rows += [(200 + i % 3, same, 1, i, "x") for i in range(60)]  # one vector, few ids
    rows += [(200, same, 2, 0, "x"), (50, [1.0, 2.0], 0, 0, None), (100, [], 1, 0, None), (150, [0.5] * 6, 2, 0, None)]
    rows += [(250, None, 1, 0, None), (300, [1.0, None], 1, 0, None), (350, [1.0, float("nan")], 1, 0, None)]
    rows += [(400, [float("inf"), 1.0], 1, 0, None), (450, same, None, 0, None), (None, same, 2, 0, None), (None, same, 1, 0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = hn.hard_negatives(df, rows_per_block=rows_per_block, anchors_per_block=anchors_per_block)
    want = plain([r[:3] for r in rows], shift=False)
    assert len(want) > 20 and collected(got) == by_key(want)


def test_empty_tables(spark):
    assert hn.mined_embeddings(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(50, [1.0], 1, 0, None), (3, [1.0], 2, 0, None)], SCHEMA)
    assert hn.mined_embeddings(one).count() == 0


@pytest.mark.parametrize("top", [3, 300, 2**20, 2**29, 2**40])
def test_packed_scores_are_exact(top):
    rng = np.random.default_rng(top)
    rows = rng.integers(-top, top, (40, 9))
    rows = rows if top < 2**30 else rows.astype(object)
    anchor = rng.integers(-min(top, 2**20), min(top, 2**20), 9)
    for ours in (rows, rows * 0, abs(rows)):
        want = [sum(int(x) * int(y) for x, y in zip(anchor, r)) for r in ours]
        assert hn.Packed(ours).scores(anchor).tolist() == want


def test_a_score_beyond_a_long_is_an_error():
    rows = np.full((2, 3), 1 << 40, dtype=object)
    with pytest.raises(ArithmeticError):
        hn.Packed(rows).scores(np.full(3, 1 << 40, dtype=object))
