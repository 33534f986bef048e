"""Hard negatives by Kronecker-packed products.

The components of many candidates in one dimension are made non-negative by a bias and laid side
by side into the fields of one wide integer, fields wide enough for a whole inner product. An
anchor then takes one multiplication per component for all candidates of a block, and the fields
of the sum, less what the biases added, are the exact scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import pick, stage

#: Rows in a block of candidates, anchors in a block of anchors.
ROWS, ANCHORS = 4096, 2048
_LONG = 1 << 63


def components(vectors: pd.Series, scale: float) -> np.ndarray:
    """``floor(scale * x)`` of every component as integers, one row per vector; shorter vectors end in zeros."""
    width = max(map(len, vectors), default=0)
    scaled = np.zeros((len(vectors), width))
    for row, v in zip(scaled, vectors):
        row[: len(v)] = v
    scaled = np.floor(scaled * scale)
    if scaled.size == 0 or np.abs(scaled).max() < 2.0**31:
        return scaled.astype(np.int64)
    return np.frompyfunc(int, 1, 1)(scaled)


class Packed:
    """Candidates' components, one wide integer per dimension."""

    def __init__(self, rows: np.ndarray) -> None:
        self.n, self.width = rows.shape
        self.bias = max(0, -int(rows.min())) if rows.size else 0
        self.raised = rows + self.bias
        self.top = int(self.raised.max()) if rows.size else 0
        self.sums = self.raised.sum(axis=1) if rows.size else np.zeros(self.n, np.int64)
        self.wide: dict[int, list[int]] = {}

    def _integers(self, size: int) -> list[int]:
        """The packed dimensions with fields of ``size`` bytes."""
        if size not in self.wide:
            if size <= 8:
                columns = (c.astype(f"<u{size}").tobytes() for c in self.raised.T)
            else:
                columns = (b"".join(int(x).to_bytes(size, "little") for x in c) for c in self.raised.T)
            self.wide[size] = [int.from_bytes(c, "little") for c in columns]
        return self.wide[size]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The exact inner products of all candidates with one anchor; an error if one does not fit a long."""
        if not self.width or not self.n:
            return np.zeros(self.n, np.int64)
        a = [int(x) for x in anchor[: self.width]] + [0] * (self.width - len(anchor))
        lift = max(0, -min(a))
        lifted = [x + lift for x in a]
        bound = sum(lifted) * self.top
        size = 4 if bound < 1 << 32 else 8 if bound < _LONG else -(-bound.bit_length() // 8)
        total = 0
        for x, wide in zip(lifted, self._integers(size)):
            total += x * wide
        data = total.to_bytes(self.n * size, "little")
        if size <= 8:
            fields = np.frombuffer(data, f"<u{size}").astype(np.int64)
        else:
            fields = np.array([int.from_bytes(data[i : i + size], "little") for i in range(0, len(data), size)], dtype=object)
        if max(bound, lift * self.width * self.top, self.bias * sum(map(abs, a))) >= _LONG >> 2:
            exact = fields.astype(object) - self.bias * sum(a) - lift * self.sums.astype(object)
            if max(exact) >= _LONG or min(exact) < -_LONG:
                raise ArithmeticError("an inner product does not fit a long")
            return exact.astype(np.int64)
        return fields - self.bias * sum(a) - lift * self.sums


def _first(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` places of ``at`` with the highest scores, ties in the order of ``at``."""
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _ordered(block: pd.DataFrame, scale: float) -> tuple[pd.DataFrame, np.ndarray]:
    """A block by id, nulls last, and its components."""
    block = block.sort_values(["nameless", "id", "row"], kind="stable").reset_index(drop=True)
    return block, components(block["vector"], scale)


def _ids(rows: pd.DataFrame) -> list[int | None]:
    return [None if missing else i for i, missing in zip(rows["id"], rows["nameless"])]


def _positives(rows: pd.DataFrame, anchors: pd.DataFrame, scale: float, k: int) -> Iterator[tuple]:
    rows, values = _ordered(rows, scale)
    ids, numbers = _ids(rows), rows["row"].to_numpy()
    of_label = {label: np.array(at) for label, at in rows.groupby("label").indices.items()}
    packed: dict[int, Packed] = {}
    for label, number, a in zip(anchors["label"], anchors["row"], components(anchors["vector"], scale)):
        if label in of_label:
            at = of_label[label]
            if label not in packed:
                packed[label] = Packed(values[at])
            scores = packed[label].scores(a)
            for i in _first(scores, np.flatnonzero(numbers[at] != number), k):
                yield number, numbers[at[i]], ids[at[i]], scores[i]


def _negatives(rows: pd.DataFrame, anchors: pd.DataFrame, scale: float, k: int, low: int, high: int) -> Iterator[tuple]:
    rows, values = _ordered(rows, scale)
    ids, numbers, labels = _ids(rows), rows["row"].to_numpy(), rows["label"].to_numpy()
    packed = Packed(values)
    for label, number, at_least, a in zip(anchors["label"], anchors["row"], anchors["floors"], components(anchors["vector"], scale)):
        scores = packed.scores(a)
        # 50 p <= 100 n <= 95 p as bounds of n; Python integers do not overflow
        bounds = [(rank, -(-low * int(p) // 100), high * int(p) // 100) for rank, p in enumerate(at_least)]
        if all(least > most for _, least, most in bounds):
            continue
        widest = min(b[1] for b in bounds if b[1] <= b[2]), max(b[2] for b in bounds if b[1] <= b[2])
        at = np.flatnonzero((labels != label) & (scores >= widest[0]) & (scores <= widest[1]))
        at = at[np.argsort(-scores[at], kind="stable")]
        falling = -scores[at]
        for rank, least, most in bounds:
            if least <= most:
                start = np.searchsorted(falling, -most)
                stop = min(start + k, np.searchsorted(falling, -least, side="right"))
                for i in at[start:stop]:
                    yield number, rank, numbers[i], ids[i], scores[i]


def _in_blocks(rows: DataFrame, anchors: DataFrame, blocks: tuple[int, int], told, schema: str) -> DataFrame:
    """Every block of anchors against every block of rows; ``told`` yields rows of ``schema`` for such a pair."""
    row_blocks, anchor_blocks = blocks

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n))

    def others(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    tasks = max(1, min(2 * row_blocks * anchor_blocks, 20_000))
    left = rows.select("*", block(row_blocks).alias("r"), others(anchor_blocks).alias("q")).repartition(tasks, "r", "q")
    right = anchors.select("*", block(anchor_blocks).alias("q"), others(row_blocks).alias("r")).repartition(tasks, "r", "q")
    names = [part.split()[0] for part in schema.split(", ")]

    def pair(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found = list(told(ours, theirs)) if len(ours) and len(theirs) else []
        return pd.DataFrame({n: pd.Series([f[i] for f in found], dtype="Int64") for i, n in enumerate(names)})

    return left.groupBy("r", "q").cogroup(right.groupBy("r", "q")).applyInPandas(pair, schema)


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    anchor_every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = 256.0,
    rows_per_block: int = ROWS,
    anchors_per_block: int = ANCHORS,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose id ``anchor_every`` divides. Positives are their first other rows of
    the same label by falling score, ties by smaller id; negatives of a positive are the first rows
    of another label whose score lies between ``low`` and ``high`` percent of the positive's.

    All rows are compared, a block of rows with a block of anchors in each task. Blocks are dealt out
    by a number of the row, so neither a frequent label, id nor vector makes a block larger. Rows
    without label or vector, and those with a null, infinite or undefined component, take no part. A null id is
    no anchor and comes after all others; rows that share an id are rows of their own; vectors of unequal length are compared as if the shorter ended in zeros. An
    empty table, a table without anchors and anchors without positives give no rows.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    named = pick(vectors, id=id_col, vector=vector_col, label=label_col)
    usable = named.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(finite).select(
        F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"), F.col("label").cast("long").alias("label")
    )
    numbered = stage(usable.select("*", F.monotonically_increasing_id().alias("row")), "vectors")
    # a null id would turn a column of longs into floating-point numbers
    rows = numbered.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("nameless"), "vector", "label", "row")
    anchors = stage(numbered.where(F.col("id") % anchor_every == 0), "anchors")
    blocks = max(1, -(-numbered.count() // rows_per_block)), max(1, -(-anchors.count() // anchors_per_block))

    near = _in_blocks(
        rows, anchors.select("vector", "label", "row"), blocks,
        lambda ours, theirs: _positives(ours, theirs, scale, positives), "anchor long, other long, id long, score long",
    )

    def best(found: DataFrame, k: int, *group: str) -> DataFrame:
        """The first of all blocks' firsts."""
        order = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)

    chosen = stage(best(near, positives, "anchor"), "positives")
    floors = chosen.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("found"))
    seeking = anchors.join(floors, F.col("row") == F.col("anchor")).select("vector", "label", "row", F.col("found.score").alias("floors"))
    hard = _in_blocks(
        rows, seeking, blocks,
        lambda ours, theirs: _negatives(ours, theirs, scale, negatives, low, high), "anchor long, rank long, other long, id long, score long",
    )
    mined = best(hard, negatives, "anchor", "rank").select(
        "anchor", (F.col("rank") + 1).alias("of"), F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    of = chosen.select("anchor", F.col("place").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    seekers = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return mined.join(of, ["anchor", "of"]).join(seekers, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def shifted_labels(label: Column, id_: Column) -> Column:
    """The label the query mines with: where 7 divides the id, the next of ten."""
    return F.when(id_ % 7 == 0, (label.cast("long") + 1) % 10).otherwise(label)


def mined_embeddings(embeddings: DataFrame) -> DataFrame:
    """:func:`hard_negatives` of ``vec_id``, ``embedding``, ``label`` with shifted labels."""
    named = pick(embeddings, vec_id="vec_id", embedding="embedding", label="label")
    return hard_negatives(named.withColumn("label", shifted_labels(F.col("label"), F.col("vec_id"))))
