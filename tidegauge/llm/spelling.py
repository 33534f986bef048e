"""Spelling variants of words by blocked Gram matrices.

A word is a vector of letter counts. One edit changes it by a squared distance of 1 (a letter
more or less) or 2 (one letter for another), so NumPy products of blocks of such vectors tell
which pairs can be one edit apart; these are verified letter by letter.

Blocks are cut by length, and finer the more words there are: the letters are dealt out to
classes, and one edit takes one letter from a class and puts one into a class at most. Words that
are one edit apart therefore agree in their class counts once one letter is taken from the longer
of them (or from both, if they are of one length): this *reduced cell* is the block. No pair is
lost, and every pair meets in exactly one block.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import lower_ascii, pick, stage

#: Shortest words and least occurrences; how much more frequent a form is; one run in so many loses a letter.
MIN_LENGTH, MIN_COUNT, FORM_RATIO, DAMAGED = 7, 2, 10, 31
#: Words a task counts before it hands them on; words of 32 letters in a block before it is cut into chunks.
COUNTED, CHUNK = 300_000, 8192
#: Words for each doubling of the classes of letters, and entries of a Gram matrix at a time.
WORDS_PER_CLASS, TILE = 8_000, 4 << 20
#: All letters a word can have.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))

_LOWER = lower_ascii()
_runs = re.compile("[a-zÀ-ÿ]+").findall
_PLACE = np.zeros(0x100, np.int64)
_PLACE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def words_of(doc_id: str, text: str, damaged: int = DAMAGED) -> Iterator[tuple[str, int]]:
    """The words of one text of :data:`MIN_LENGTH` or more with their counts.

    A word may come twice, as it stands and as what another run is without one letter.
    """
    before = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_runs(text.encode().translate(_LOWER).decode())).items():
        size = len(run)
        if size < MIN_LENGTH:
            continue
        h = zlib.crc32(run.encode(), before)
        if h % damaged == 0:
            if size == MIN_LENGTH:
                continue
            at = h % size
            run = run[:at] + run[at + 1 :]
        yield run, n


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n``: the words that occur often enough. Tasks add up before the shuffle, in bounded memory."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[str] = Counter()

        def told() -> pd.DataFrame:
            return pd.DataFrame({"word": list(found.keys()), "n": list(found.values())})

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                for word, n in words_of(doc_id, text):
                    found[word] += n
                if len(found) >= COUNTED:
                    yield told()
                    found.clear()
        if found:
            yield told()

    read = pick(docs, doc_id=id_col, text=text_col).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    counted = read.mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def letter_classes(words: DataFrame, classes: int) -> list[str]:
    """Letters dealt out to classes that are about equally frequent; at most 90 counts reach the driver."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    weights = {r["letter"]: r["count"] for r in letters.where("letter <> ''").collect()}
    dealt, loads = [""] * classes, [0] * classes
    for letter in sorted(weights, key=lambda x: (-weights[x], x)):
        least = loads.index(min(loads))
        dealt[least] += letter
        loads[least] += weights[letter]
    return dealt


def blocks(words: DataFrame, classes: list[str]) -> DataFrame:
    """``words`` once for each ``block`` (class counts of the reduced cell, two chunks), with ``taken`` (class, -1: nothing) and ``mine`` (chunk).

    A block of more than :data:`CHUNK` words is cut into chunks and dealt out to all pairs of
    them, so that no block is too large for a task.
    """
    size = F.length("word")

    def written(counts: list[Column]) -> Column:
        return F.concat_ws(",", *[c.cast("string") for c in counts])

    def count(letters: str) -> Column:
        return size - F.length(F.translate("word", letters, "")) if letters else F.lit(0)

    counted = words.select("*", size.alias("size"), *[count(letters).alias(f"c{i}") for i, letters in enumerate(classes)])
    counts = [F.col(f"c{i}") for i in range(len(classes))]
    cells = [F.struct(written(counts).alias("key"), F.lit(-1).alias("taken"))] + [
        F.when(
            counts[i] > 0, F.struct(written([c - 1 if j == i else c for j, c in enumerate(counts)]).alias("key"), F.lit(i).alias("taken"))
        )
        for i in range(len(classes))
    ]
    spread = F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("cell")
    # sizes of blocks from the cells, of which there are far fewer than words
    per_cell = counted.groupBy("size", *[f"c{i}" for i in range(len(classes))]).agg(F.count("*").alias("n"))
    sizes = per_cell.select("n", "size", spread).groupBy("cell.key").agg(F.sum("n").alias("n"), F.max("size").alias("size"))
    limit = F.greatest(F.lit(16), F.floor(F.lit(CHUNK * 32) / F.greatest("size", F.lit(32))))
    large = sizes.where(F.col("n") > limit).select("key", F.ceil(F.col("n") / limit).cast("int").alias("chunks"))
    placed = counted.select("word", "n", spread).select("word", "n", "cell.*").join(large, "key", "left")
    mine = F.pmod(F.xxhash64("word"), F.coalesce("chunks", F.lit(1))).cast("int")
    with_all = placed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
    block = F.concat_ws("/", "key", F.least("mine", "other").cast("string"), F.greatest("mine", "other").cast("string"))
    return with_all.select(block.alias("block"), "taken", "word", "n", "mine")


class _Side:
    """Words of one length, at places of a block, as letters and as letter counts."""

    def __init__(self, at: np.ndarray, words: np.ndarray) -> None:
        self.at = at
        width = len(words[at[0]]) if len(at) else 0
        self.letters = words[at].astype(f"U{max(1, width)}").view(np.uint32).reshape(len(at), max(1, width))
        places = _PLACE[self.letters] + np.arange(len(at))[:, None] * len(LETTERS)
        # sums of squares stay below what the type holds exactly
        kind = np.float32 if width < 2048 else np.float64
        self.counts = np.bincount(places.ravel(), minlength=len(at) * len(LETTERS)).reshape(len(at), len(LETTERS)).astype(kind)
        self.square = (self.counts**2).sum(axis=1, keepdims=True)


def _close(a: _Side, b: _Side) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places whose squared distance is at most two, one tile of the Gram matrix after the other."""
    used = a.counts.any(axis=0) & b.counts.any(axis=0)  # others add nothing to a product
    left = np.hstack([-2 * a.counts[:, used], a.square, np.ones_like(a.square)])
    right = np.hstack([b.counts[:, used], np.ones_like(b.square), b.square]).T
    step = max(1, TILE // max(1, right.shape[1]))
    for at in range(0, len(left), step):
        # a word and itself, and all pairs twice, where both sides are the same
        from_ = at if a is b else 0
        i, j = np.divmod(np.flatnonzero(left[at : at + step] @ right[:, from_:] <= 2), right.shape[1] - from_)
        i, j = i + at, j + from_
        yield (i[i < j], j[i < j]) if a is b else (i, j)


def _one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row by row one edit leads from ``a`` to ``b``, which are equally long or ``a`` one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    n = b.shape[1]
    ahead = np.logical_and.accumulate(a[:, :n] == b, axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= n


def near_in_block(block: str, taken: np.ndarray, words: np.ndarray, n: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words with near words in this block, how many, and the count and name of the most frequent, ties by code points."""
    key, low, high = block.split("/")
    first = next((i for i, c in enumerate(key.split(",")) if c != "0"), len(words))
    order = np.array(sorted(range(len(words)), key=lambda i: (-n[i], words[i])))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    near, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    longer, shorter = _Side(np.flatnonzero(taken >= 0), words), _Side(np.flatnonzero(taken < 0), words)
    for a, b in ((longer, longer), (longer, shorter)):
        if not len(a.at) or not len(b.at):
            continue
        for i, j in _close(a, b):
            p, q = a.at[i], b.at[j]
            # words of one cell share a block for each of their classes: they meet in the first;
            # words of one chunk meet where both chunks are theirs
            keep = (taken[p] != taken[q]) | (taken[p] <= first)
            if low != high:
                keep &= mine[p] != mine[q]
            i, j = i[keep], j[keep]
            for at in range(0, len(i), 1 << 16):
                x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
                true = _one_edit(a.letters[x], b.letters[y])
                p, q = a.at[x[true]], b.at[y[true]]
                for x, y in ((p, q), (q, p)):
                    near += np.bincount(x, minlength=len(near))
                    np.minimum.at(best, x, rank[y])
    found = np.flatnonzero(near)
    top = order[best[found]]
    return words[found], near[found], n[top], words[top]


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near``, ``best_n``, ``best`` for every word that has a near word."""
    classes = max(1, (words.count() // WORDS_PER_CLASS).bit_length())
    dealt = blocks(words, letter_classes(words, classes))
    columns = ["taken", "word", "n", "mine"]

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """One block after the other, each with its columns as arrays; blocks may go on in the next batch."""
        name, held = None, []
        for batch in batches:
            names = batch["block"].to_numpy(object)
            arrays = [batch[c].to_numpy() for c in columns]
            cuts = (np.flatnonzero(names[1:] != names[:-1]) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(names)]):
                if a < b and names[a] != name:
                    if held:
                        yield name, *map(np.concatenate, zip(*held))
                    name, held = names[a], []
                held.append([x[a:b] for x in arrays])
        if held:
            yield name, *map(np.concatenate, zip(*held))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        rows = 0
        for stretch in stretches(batches):
            found.append(near_in_block(*stretch))
            rows += len(found[-1][0])
            if rows > 10_000:
                yield pd.DataFrame(dict(zip(("word", "near", "best_n", "best"), map(np.concatenate, zip(*found)))))
                found, rows = [], 0
        if rows:
            yield pd.DataFrame(dict(zip(("word", "near", "best_n", "best"), map(np.concatenate, zip(*found)))))

    together = dealt.repartition("block").sortWithinPartitions("block")
    found = together.mapInPandas(compare, "word string, near long, best_n long, best string")
    # the most frequent near word; the smallest of those
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for the rows ``word``, ``form``: where following forms ends.

    A form occurs ten times as often as its word, so chains are short; each round doubles the
    steps taken.
    """
    chain = stage(forms.select("word", F.col("form").alias("root")), "form-chains")
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stage(
            chain.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "form-chains",
        )
        chain = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            return chain


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word of seven letters or more that occurs twice or more.

    A word's form is the most frequent word one edit away, if that occurs ten times as often;
    the root is where forms lead. Null and empty texts have no words; a null id counts as an
    empty one; repeated rows count as often as they stand; words of any length are compared whole;
    an empty table gives no rows; other columns of ``docs`` play no part.
    """
    words = stage(count_words(docs, id_col, text_col), "words")
    near = near_words(words)
    formed = F.col("best_n") >= FORM_RATIO * F.col("n")
    told = stage(
        words.join(near, "word", "left").select(
            "word", F.when(formed, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(formed, F.col("best_n")).alias("form_n"),
        ),
        "word-forms",
    )
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
