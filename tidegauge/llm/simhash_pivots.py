"""SimHash near-duplicates with pivot distance tables.

A document's fingerprint is the bitwise majority of the hashes of its word shingles. Two
fingerprints link when they differ in few bits; components of links are the groups of near
duplicates. Fingerprints that could link share a bucket (some blocks of bits must agree).
Inside a bucket the distances of every fingerprint to a fixed set of reference fingerprints
are tabulated; by the triangle inequality a pair whose table rows differ by more than the
threshold in any coordinate cannot link and is discarded, and what survives is verified bit
by bit.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import quoted
from tidegauge.llm.common import lower_ascii, pick, stage, unused
from tidegauge.llm.components import components

BITS = 64
#: Reference fingerprints: rows of the 64-bit Walsh functions, so that each measures another direction.
PIVOTS = np.array(
    [sum(((i & p).bit_count() & 1) << i for i in range(BITS)) for p in (0, 1, 2, 4, 8, 16, 32, 63)], dtype=np.uint64
)
#: Fingerprints of one bucket compared in one task; a larger bucket is cut into pairs of chunks.
CHUNK = 4096
#: Up to this size a bucket is compared pair by pair, together with all others of the batch.
SMALL = 32

_LOWER = lower_ascii()


def fingerprint(text: str | None, width: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles; 0 for a text without words or a null."""
    # bytes.split() parts at the six white space bytes x20 and x09-x0D and no others
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    if len(words) < width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        ends = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = [0, *ends[: len(words) - width]]
        hash64 = xxhash.xxh64_intdigest
        hashes = [hash64(joined[a : b - 1], 42) for a, b in zip(starts, ends[width - 1 :])]
    return majority(np.array(hashes, dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have set, as an unsigned number."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_column(text: Column, width: int = 4) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, width) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(found.view(np.int64))

    return simhash(text)


def block_masks(distance: int, extra: int) -> list[int]:
    """Bit masks of which one at least is untouched when ``distance`` bits differ.

    The 64 bits fall into ``distance + extra`` blocks; differing bits touch ``distance`` of
    them at most, so some ``extra`` blocks agree as a whole.
    """
    blocks = distance + extra
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in itertools.combinations(masks, extra)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def blocks_needed(n: int, distance: int) -> int:
    """How many agreeing blocks a bucket key takes so that unrelated fingerprints rarely meet.

    With ``b`` key bits, ``n / 2**b`` unrelated fingerprints share a bucket; a further block
    costs more keys per fingerprint but keeps that number small at any size. No choice
    loses a link.
    """
    extra = 1
    while extra < 5 and n > 4 << (BITS * extra // (distance + extra)):
        extra += 1
    return extra


def distance_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint to each pivot, one row per pivot."""
    return np.stack([np.bitwise_count(prints ^ p) for p in PIVOTS]).astype(np.int8)


def close_pairs(left: np.ndarray, right: np.ndarray, tables: tuple[np.ndarray, np.ndarray], distance: int) -> np.ndarray:
    """Positions at which the two lists of fingerprints link: pivots first, then the bits."""
    at = np.arange(len(left))
    for ours, theirs in zip(*tables):
        at = at[np.abs(ours[at] - theirs[at]) <= distance]
    return at[np.bitwise_count(left[at] ^ right[at]) <= distance]


def forest(prints: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect whatever links inside one bucket: fewer than the fingerprints in it.

    A search from each fingerprint over those not yet reached; they are kept in the order of
    their distance to the first pivot, so only a slice of them can link at all.
    """
    table = distance_table(prints)
    order = np.argsort(table[0], kind="stable")
    prints, table = prints[order], table[:, order]
    left = np.arange(len(prints))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            first = table[0][left]
            low, high = np.searchsorted(first, [table[0][at] - distance, table[0][at] + distance + 1])
            near = left[low:high]
            for row in table[1:]:
                near = near[np.abs(row[near] - row[at]) <= distance]
            near = near[np.bitwise_count(prints[near] ^ prints[at]) <= distance]
            if len(near):
                yield np.full(len(near), prints[at]), prints[near]
                left = left[~np.isin(left, near, assume_unique=True)]
                queue.extend(near)


def bucket_edges(combo: np.ndarray, key: np.ndarray, cell: np.ndarray, prints: np.ndarray, masks: np.ndarray, distance: int):
    """Linking edges of whole buckets given as sorted runs.

    Small buckets are compared pair by pair, all of them at once, and a pair is told only in
    the first bucket it shares; larger ones are spanned by a forest.
    """
    fresh = np.r_[True, (combo[1:] != combo[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]
    starts = np.flatnonzero(fresh)
    sizes = np.diff(np.r_[starts, len(prints)])
    out = [e for a, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL]) for e in forest(prints[a : a + n], distance)]
    small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL), sizes))
    if len(small):
        run = np.repeat(np.arange(len(sizes)), sizes)[small]
        prints, combo = prints[small], combo[small]
        table = distance_table(prints)
        for step in range(1, SMALL):
            at = np.flatnonzero(run[step:] == run[:-step])
            if not len(at):
                break
            at = at[close_pairs(prints[at], prints[at + step], (table[:, at], table[:, at + step]), distance)]
            apart = prints[at] ^ prints[at + step]
            first = np.argmax((apart[:, None] & masks) == 0, axis=1) if len(at) else at
            at = at[first == combo[at]]
            out.append((prints[at], prints[at + step]))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def link_edges(prints: DataFrame, distance: int = 4, chunk: int = CHUNK, extra: int | None = None) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``) that connect all links.

    Not every linking pair is listed, but every linking pair is connected by edges, each of
    which is itself a link. A bucket with more than ``chunk`` fingerprints is dealt out as
    pairs of chunks to as many tasks, so no bucket is one task.
    """
    extra = extra or blocks_needed(prints.count(), distance)
    masks = block_masks(distance, extra)
    keyed = prints.select(
        "fp",
        F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("combo"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                for i, m in enumerate(masks)
            ])
        ).alias("bucket"),
    ).select("fp", "bucket.combo", "bucket.key")
    hot = stage(
        keyed.groupBy("combo", "key").agg(F.count("*").alias("n")).where(F.col("n") > chunk)
        .select("combo", "key", F.ceil(F.col("n") / chunk).cast("int").alias("parts")),
        "hot-buckets",
    )
    if hot.isEmpty():
        dealt = keyed.withColumn("cell", F.lit(0).cast("long"))
    else:
        part = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
        cells = F.transform(
            F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1),
            lambda other: F.least(other, part).cast("long") * (1 << 31) + F.greatest(other, part),
        )
        dealt = keyed.join(hot, ["combo", "key"], "left").select("fp", "combo", "key", F.explode(cells).alias("cell"))
    sorted_runs = dealt.repartition("combo", "key", "cell").sortWithinPartitions("combo", "key", "cell")
    mask_array = np.array(masks, dtype=np.uint64)

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def told(combo, key, cell, fps):
            a, b = bucket_edges(combo, key, cell, fps.view(np.uint64), mask_array, distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("combo", "key", "cell", "fp")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1])
            last = int(np.argmax(same))  # the last run may go on in the next batch
            if last:
                yield told(*[x[:last] for x in now])
            held = [x[last:] for x in now]
        if held is not None:
            yield told(*held)

    return sorted_runs.mapInArrow(edges, "a long, b long").distinct()


def group_prints(signatures: DataFrame, distance: int = 4, chunk: int = CHUNK) -> DataFrame:
    """``fp``, ``label`` of its component, ``component_id``: the smallest id of the documents in it.

    ``signatures`` has ``doc_id`` and ``fp``. Documents with one fingerprint are one class
    before anything is compared, so a third of all rows with one text costs one row here.
    """
    classes = stage(signatures.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "print-classes")
    edges = link_edges(classes.select("fp"), distance, chunk)
    labels = components(edges)
    labelled = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    return labelled.join(least, "label").select("fp", "label", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, width: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` per row of ``docs``.

    A null or wordless text has fingerprint zero and links like any other; texts of any
    length are read whole. Null ids are ignored for the smallest id (a component of none but
    null ids has a null one); repeated rows appear as often as they are given; an empty table
    gives an empty result. Other columns of ``docs`` are not looked at.
    """
    chosen = pick(docs, doc_id=id_col, text=text_col)
    signatures = stage(chosen.select("doc_id", fingerprint_column(F.col("text"), width).alias("fp")), "signatures")
    groups = group_prints(signatures, distance, chunk)
    return signatures.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, width: int = 4, chunk: int = CHUNK
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the row with the smallest id.

    Null ids come last; among equal ids one row stays. All columns are kept as they are. The
    marked rows are written once, so every step sees the same row numbers.
    """
    names = docs.columns
    fp, row = unused(docs, "fp"), unused(docs, "row_number")
    marked = stage(
        docs.withColumn(fp, fingerprint_column(F.col(quoted(text_col)), width)).withColumn(row, F.monotonically_increasing_id()),
        "marked-rows",
    )
    keys = pick(marked, doc_id=id_col, fp=fp, row=row)
    groups = group_prints(keys, distance, chunk)
    labels = groups.select(F.col("fp").alias("print"), "label")
    firsts = (
        keys.groupBy("fp")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first"))
        .join(labels, F.col("fp") == F.col("print"))
        .groupBy("label")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("_kept_row"))
    )
    return marked.join(firsts, marked[row] == firsts["_kept_row"], "left_semi").select(*[F.col(quoted(c)) for c in names])
