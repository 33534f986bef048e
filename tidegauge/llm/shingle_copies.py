"""Near copies by SimHash pivots and the overlap of word shingles, for the pipeline.

Two texts are near copies when their sets of five-word shingles have a Jaccard similarity of
0.8 or more. The SimHashes of the shingles are linked first, by buckets, pivot distance tables
and bits (:mod:`tidegauge.llm.simhash_pivots`). Pairs of similarity 0.8 differ in up to 17 bits
though, and no blocks of so few bits agree by chance seldom enough, so what four bits do not
reach comes from bands of minimum hashes: a pair with similarity 0.8 shares none of them with
probability 1.2e-7, a more similar one with less. Each pair that counts is verified by its
exact overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import quoted
from tidegauge.llm.common import bound_batches, let_go, lower_ascii, pick, stage, unused
from tidegauge.llm.components import components
from tidegauge.llm.simhash_pivots import link_edges, majority, signed

WIDTH = 5
#: Bands of minimum hashes, and minima in one band.
BANDS, ROWS = 40, 5
#: Bands in which every text is first compared with the smallest id of its bucket alone.
FIRST = 4
#: Members of a bucket that one task compares with as many others, and columns of a product at a time.
CHUNK, COLUMNS = 256, 8192

_LOWER = lower_ascii()
_random = np.random.default_rng(20)
_FACTORS = _random.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_MIX = _random.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _random.integers(0, 2**63, BANDS, dtype=np.uint64)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, a wordless one has none."""
    words = text.encode().translate(_LOWER).split() if text else []
    hash64 = xxhash.xxh64_intdigest
    last = max(1, len(words) - width + 1) if words else 0
    return np.unique(np.array([hash64(b" ".join(words[i : i + width]), 42) for i in range(last)], dtype=np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key per band of minimum hashes; none without shingles."""
    if not len(hashes):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 256):
        least = np.minimum(least, (hashes[at : at + 256, None] * _FACTORS + _SHIFTS).min(axis=0))
    return ((least.reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) ^ _BAND).view(np.int64)


def _signature(text: Column) -> Column:
    @F.pandas_udf("n int, class binary, fp long, bands array<long>")
    def signature(texts: pd.Series) -> pd.DataFrame:
        let_go()
        sets = map(shingles, texts)
        rows = [(len(s), xxhash.xxh3_128_digest(s.tobytes()), signed(majority(s)), bands(s)) for s in sets]
        return pd.DataFrame(rows, columns=["n", "class", "fp", "bands"])

    return signature(text)


def _set(text: Column) -> Column:
    @F.pandas_udf("array<long>")
    def hashed(texts: pd.Series) -> pd.Series:
        let_go()
        return pd.Series([shingles(t).view(np.int64) for t in texts], dtype=object)

    return hashed(text)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets overlap by four fifths of their union or more."""
    common = F.size(F.array_intersect("ours", "theirs"))
    both = pairs.join(sets.toDF("a", "ours"), "a").join(sets.toDF("b", "theirs"), "b")
    return both.where(common * 9 >= (F.size("ours") + F.size("theirs")) * 4).select("a", "b")


def pivot_edges(heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified edges between texts whose SimHashes link: pivot tables discard, bits and then the overlap verify.

    ``heads`` has ``id``, ``fp``. Texts of one SimHash meet the smallest id among them; between
    SimHashes there are fewer edges than SimHashes in each bucket.
    """
    prints = stage(heads.groupBy("fp").agg(F.min("id").alias("first")), "prints")
    links = link_edges(prints.select("fp"))
    ends = links.join(prints.toDF("a", "x"), "a").join(prints.toDF("b", "y"), "b")
    between = ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    alike = heads.join(prints, "fp").select(F.col("first").alias("a"), F.col("id").alias("b"))
    return stage(verified(between.union(alike).distinct().where("a < b"), sets), "pivot-edges")


def star_edges(heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified edges from texts to the smallest id of their bucket, in the first bands.

    ``heads`` has ``id``, ``bands``. A row for each text and band, however large its bucket is;
    it connects nearly all of a group of copies, so that few of its buckets are looked at again.
    """
    few = heads.select("id", F.explode(F.slice("bands", 1, FIRST)).alias("band"))
    least = few.groupBy("band").agg(F.min("id").alias("a"))
    pairs = few.join(least, "band").select("a", F.col("id").alias("b")).distinct().where("a < b")
    return stage(verified(pairs, sets), "star-edges")


def dealt_members(heads: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several groups, once for each ``part`` of a bucket they are compared in.

    ``heads`` has ``id``, ``n``, ``bands``; ``labels`` the group (``label``) of each ``node`` known so far. Two members
    of the largest group of a bucket need not be compared, so that group and the others are cut
    into chunks, each of the former meets each of the latter, and the latter meet each other.
    """
    known = heads.join(labels, heads["id"] == labels["node"], "left").select("id", "bands", F.coalesce("label", "id").alias("label"))
    now = known.select("id", "label", F.explode("bands").alias("band"))
    groups = now.groupBy("band", "label").agg(F.count("*").alias("size")).groupBy("band").agg(
        F.sum("size").alias("total"), F.max(F.struct("size", "label")).alias("most")
    ).where("total > most.size")
    inner, outer = F.ceil(F.col("most.size") / CHUNK).cast("int"), F.ceil((F.col("total") - F.col("most.size")) / CHUNK).cast("int")
    open_ = groups.select("band", F.col("most.label").alias("major"), inner.alias("inner"), outer.alias("outer"), (F.col("total") <= CHUNK).alias("whole"))
    members = now.join(open_, "band")

    def name(first: Column | str, second: Column | str, third: Column) -> Column:
        return F.concat_ws("-", *[c.cast("string") if isinstance(c, Column) else F.lit(c) for c in (first, second, third)])

    def chunk(n: str) -> Column:
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def up_to(n: str) -> Column:
        return F.sequence(F.lit(0), F.col(n) - 1)

    major = F.col("label") == F.col("major")
    ours = F.transform(up_to("outer"), lambda o: name("both", chunk("inner"), o))
    theirs = F.concat(
        F.transform(up_to("inner"), lambda c: name("both", c, chunk("outer"))),
        F.transform(up_to("outer"), lambda o: name("outer", F.least(o, chunk("outer")), F.greatest(o, chunk("outer")))),
    )
    parts = F.when(F.col("whole"), F.array(F.lit("whole"))).when(major, ours).otherwise(theirs)
    return members.select("band", "id", "label", major.alias("major"), F.explode(parts).alias("part"))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets have in common, by products of 0/1 matrices."""
    sizes = [len(s) for s in sets]
    _, places = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(places, kind="stable")
    places, owner = places[order], owner[order]
    found = np.zeros((len(sets), len(sets)), np.float32)
    last = int(places[-1]) + 1 if len(places) else 0
    for at in range(0, last, COLUMNS):
        low, high = np.searchsorted(places, [at, at + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[owner[low:high], places[low:high] - at] = 1
        found += block @ block.T
    return found


def forest_of(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Which of the pairs of places below ``n`` connect what the pairs before them have not."""
    above = list(range(n))

    def top(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    keep = np.zeros(len(i), bool)
    for at, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = top(x), top(y)
        if x != y:
            above[x], keep[at] = y, True
    return keep


def similar_in_part(band: int, part: str, rows: pd.DataFrame, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids that may be similar, among the members of a part of a bucket; a pair is looked at in the first band it shares.

    All of them, or a ``forest`` that connects what they connect.
    """
    if part.startswith("both"):
        wanted = rows["major"].to_numpy()[:, None] != rows["major"].to_numpy()[None, :]
    else:
        wanted = np.ones((len(rows), len(rows)), bool)
    label, n = rows["label"].to_numpy(), rows["n"].to_numpy()
    wanted &= np.triu(label[:, None] != label[None, :], 1)
    wanted &= np.minimum(n[:, None], n[None, :]) * 5 >= np.maximum(n[:, None], n[None, :]) * 4
    i, j = np.nonzero(wanted)
    bands_of = np.stack(rows["bands"].to_numpy())
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 14):
        x, y = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
        keep[at : at + (1 << 14)] = bands_of[x, (bands_of[x] == bands_of[y]).argmax(axis=1)] == band
    i, j = i[keep], j[keep]
    if not len(i):
        return i, j
    used = np.unique(np.r_[i, j])
    sets = [np.unique(h) for h in rows["short"].iloc[used]]
    lost = n[used] - np.array([len(s) for s in sets])  # shingles that share their first half with another
    at = np.searchsorted(used, [i, j])
    common = common_counts(sets)[at[0], at[1]] + lost[at[0]] + lost[at[1]]
    close = common * 9 >= (n[i] + n[j]) * 4
    ids, i, j = rows["id"].to_numpy(), i[close], j[close]
    kept = forest_of(i, j, len(rows)) if forest else slice(None)
    return ids[i[kept]], ids[j[kept]]


def bucket_pairs(members: DataFrame, heads: DataFrame, sets: DataFrame, forest: bool) -> DataFrame:
    """Pairs ``(a, b)`` of members of a bucket that may be similar; few of them are not, for their sets are compared by half hashes."""
    short = sets.select("id", F.transform("hashes", lambda h: F.shiftright(h, 32).cast("int")).alias("short"))
    # rows are few by now; before, a text with its bands would have been written once for each of them
    together = members.join(short.join(heads.select("id", "n", "bands"), "id"), "id").repartition("band", "part").sortWithinPartitions("band", "part")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        held: list[pd.DataFrame] = []

        def told() -> Iterator[pd.DataFrame]:
            rows = pd.concat(held, ignore_index=True)
            a, b = similar_in_part(rows["band"].iloc[0], rows["part"].iloc[0], rows, forest)
            if len(a):
                yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

        for batch in batches:
            if not len(batch):
                continue
            band, part = batch["band"].to_numpy(), batch["part"].to_numpy(object)
            cuts = (np.flatnonzero((band[1:] != band[:-1]) | (part[1:] != part[:-1])) + 1).tolist()
            for x, y in zip([0, *cuts], [*cuts, len(batch)]):
                if held and (held[-1]["band"].iloc[-1] != band[x] or held[-1]["part"].iloc[-1] != part[x]):
                    yield from told()
                    held = []
                held.append(batch.iloc[x:y])
        if held:
            yield from told()

    return together.mapInPandas(compare, "a long, b long").distinct()


def similar_edges(heads: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified edges ``(a, b)`` that connect whatever is similar and shares a bucket.

    ``heads`` has ``id``, ``n``, ``fp``, ``bands``; ``sets`` the shingles of each id that shares a bucket. After
    :func:`pivot_edges` and :func:`star_edges` only buckets that still hold several groups are looked at, and in them
    only pairs of different groups, part by part of a bucket, by products of matrices in a task.
    A part gives a forest of its pairs, so a large group costs rows, not pairs. Each pair is
    verified; should one of them be a collision, all pairs of all parts are verified instead.
    """
    known = pivot_edges(heads, sets).union(star_edges(heads, sets))
    members = stage(dealt_members(heads, components(known)), "open-members")
    pairs = stage(bucket_pairs(members, heads, sets, True), "candidate-pairs")
    found = stage(verified(pairs, sets), "similar-pairs")
    if found.count() < pairs.count():
        found = stage(verified(bucket_pairs(members, heads, sets, False), sets), "similar-pairs")
    return known.union(found)


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id.

    Wordless and null texts are alike. Null ids come last; among equal ids one row stays. All
    columns are kept as they are. ``docs`` is read three times and must say the same each
    time, as a table does; its texts are not written again.
    """
    bound_batches(docs.sparkSession)
    text, digest = F.col(quoted(text_col)), unused(docs, "digest")
    told = docs.withColumn(digest, F.coalesce(F.sha2(text.cast("binary"), 256), F.lit("")))
    signed = pick(told, doc_id=id_col, digest=digest, text=text_col).withColumn("s", _signature(F.col("text")))
    signatures = stage(
        signed.select("doc_id", "digest", "s.n", "s.class", "s.fp", "s.bands", F.monotonically_increasing_id().alias("row")), "shingle-signatures"
    )
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    classes = stage(signatures.groupBy("class").agg(F.min("row").alias("id"), F.min(order).alias("first")), "shingle-classes")
    heads = stage(
        signatures.join(classes.select("id"), F.col("row") == F.col("id"), "left_semi").select(F.col("row").alias("id"), "n", "digest", "fp", "bands"), "shingle-heads"
    )
    keyed = heads.select("id", F.explode("bands").alias("band"))
    rows = keyed.groupBy("band").agg(F.count("*").alias("rows"))
    sharing = keyed.join(rows, "band").groupBy("id").agg(F.max("rows").alias("most")).where("most > 1").select("id")
    wanted = sharing.join(heads.select("id", F.col("digest").alias("wanted")), "id")
    texts = pick(told, digest=digest, text=text_col).join(wanted, F.col("digest") == F.col("wanted"))
    sets = stage(texts.groupBy("id").agg(F.first("text").alias("text")).select("id", _set(F.col("text")).alias("hashes")), "candidate-shingles")
    labels = components(similar_edges(heads.select("id", "n", "fp", "bands"), sets)).toDF("node", "found")
    labelled = classes.join(labels, F.col("id") == F.col("node"), "left").select("id", "first", F.coalesce("found", "id").alias("label"))
    firsts = labelled.groupBy("label").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.digest").alias("_digest")
    )
    rows = signatures.groupBy("doc_id", "digest").agg(F.count("*").alias("_rows"))
    firsts = stage(
        firsts.join(rows, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("digest"))).select("_id", "_digest", "_rows"), "kept-keys"
    )

    def of(keys: DataFrame) -> DataFrame:
        same = (told[digest] == keys["_digest"]) & told[quoted(id_col)].eqNullSafe(keys["_id"])
        return told.join(keys, same, "left_semi")

    repeated = firsts.where("_rows > 1")
    kept = of(firsts)
    if not repeated.isEmpty():  # rows alike in id and text
        kept = of(firsts.where("_rows = 1")).union(of(repeated).dropDuplicates([id_col, digest]))
    return kept.drop(digest)
