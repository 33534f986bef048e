"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on stretches of ordinary text and one on the
stretches of toxic text that are peculiar to it; the toxic one stands behind the
ordinary one, so that ordinary words cost the same under both. A window (a word and its delimiters) that the toxic dictionary
shortens much better than the ordinary one is evidence; how much, for each pair of lengths,
is calibrated on labelled documents that took no part in the dictionaries. A document's
score is a logistic function of its strongest windows and its length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import quoted
from tidegauge.llm.common import bound_batches, crc_fold, kept, pick, unused

#: Labelled documents of each kind that a model is fitted on at most, and bytes of their texts together.
MAX_TOXIC, MAX_ORDINARY, MAX_BYTES = 3000, 5000, 64 << 20
#: Stretches of ordinary text a dictionary is trained on at most, evenly from all that there are.
MAX_STRETCHES = 20_000
#: A word is peculiar to toxic text if it occurs in so many toxic documents (a share of them, and a number) and
#: the logarithm of its odds there against elsewhere is so high.
PECULIAR_SHARE, PECULIAR_LEAST, PECULIAR_ODDS = 0.02, 3, 2.5
#: Bytes of the ordinary dictionary, and of the toxic one at most.
BASE_BYTES, TOXIC_BYTES = 8192, 4096
LEVEL = 6
#: Bytes of a window without its frame; longer words are cut into overlapping windows.
WINDOW = 48
#: Words remembered by a worker, and windows compressed in one call.
REMEMBERED, AT_ONCE = 250_000, 1 << 16
#: Distinct length differences and lengths that the calibration tells apart.
GAINS, LENGTHS = 24, 80
#: Bytes of a window's lead and trail, and places of both in the dictionary that a fit tries.
FRAME_BYTES = 24
FRAMES = [(4096, 5096), (1000, 3000), (5096, 2048), (3000, 6144), (6144, 1500), (2500, 7000)]
#: Documents with a score from here on are toxic.
THRESHOLD = 0.7

# A-Z lower-cased, control bytes as white space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 32 else b for b in range(256))


def windows_of(text: str | None) -> list[bytes]:
    """The words of a whole text; words beyond a window's size as overlapping windows."""
    words = text.encode().translate(_FOLD).split() if text else []
    if not words or len(max(words, key=len)) <= WINDOW:
        return words
    half = WINDOW // 2
    return [w[at : at + WINDOW] for w in words for at in range(0, max(1, len(w) - half), half)]


@dataclass(frozen=True)
class ToxicityModel:
    """What the workers need: both dictionaries' own content, evidence by window lengths, weights."""

    ordinary: bytes
    peculiar: bytes
    frame: tuple[int, int]
    evidence: np.ndarray
    weights: np.ndarray

    @property
    def fitted(self) -> bool:
        return bool(self.weights.any())


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


class Lengths:
    """Compressed lengths of windows under both dictionaries.

    Every window stands between a lead and a trail that both dictionaries hold: without
    them zstandard would not search the last bytes, nor compress so short a block at all.
    """

    def __init__(self, ordinary: bytes, toxic: bytes, lead: bytes, trail: bytes) -> None:
        self.both = [_compressor(ordinary), _compressor(toxic)]
        self.lead, self.trail = lead + b" ", b" " + trail

    def cells(self, windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per window the gain of the toxic dictionary and the length under the ordinary one, both clipped."""
        found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for at in range(0, len(windows), AT_ONCE):
            framed = [self.lead + w + self.trail for w in windows[at : at + AT_ONCE]]
            sizes = np.fromiter(map(len, framed), np.uint64, len(framed))
            segments = np.stack([np.cumsum(sizes) - sizes, sizes], axis=1).astype(np.uint64).tobytes()
            block = zstandard.BufferWithSegments(b"".join(framed), segments)
            for out, compressor in zip(found, self.both):
                made = compressor.multi_compress_to_buffer(block, threads=1)
                out.append(np.fromiter(map(len, made), np.int64, len(made)))
        ordinary, toxic = map(np.concatenate, found)
        return np.clip(ordinary - toxic, 0, GAINS - 1), np.clip(ordinary, 0, LENGTHS - 1)


def trained(size: int, samples: list[bytes]) -> bytes:
    """A dictionary trained by zstandard; of samples too few or too short for that, their own bytes."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def ordinary_dictionary(texts: list[list[bytes]], labels: list[int]) -> bytes:
    """A dictionary trained on stretches of ordinary documents, given as lists of windows."""
    stretches = [s for windows, y in zip(texts, labels) if not y for s in _stretches(windows)]
    step = max(1, len(stretches) // MAX_STRETCHES)
    return trained(BASE_BYTES, stretches[::step] or [b"the of and to in is"] * 64)


def peculiar_windows(texts: list[list[bytes]], labels: list[int]) -> list[bytes]:
    """The windows that are far more usual in toxic documents, the most usual first."""
    seen: tuple[Counter, Counter] = Counter(), Counter()
    totals = Counter(labels)
    for windows, y in zip(texts, labels):
        seen[y].update(set(windows))
    least = max(PECULIAR_LEAST, totals[1] * PECULIAR_SHARE)

    def odds(window: bytes) -> float:
        return math.log((seen[1][window] + 0.5) / (totals[1] + 1)) - math.log((seen[0][window] + 0.5) / (totals[0] + 1))

    return sorted((w for w, n in seen[1].items() if n >= least and odds(w) > PECULIAR_ODDS), key=lambda w: (-seen[1][w], w))


def toxic_dictionary(texts: list[list[bytes]], labels: list[int]) -> bytes:
    """A dictionary trained on the stretches of toxic documents that are peculiar to them.

    Trained on whole toxic documents, nearly all of it would be ordinary words. It is as large
    as the different peculiar words are together, so that frequent stretches come several times.
    """
    chosen = peculiar_windows(texts, labels)
    known = set(chosen)
    stretches = [b" " + w + b" " for windows, y in zip(texts, labels) if y for w in windows if w in known]
    size = sum(len(w) + 2 for w in chosen)
    return trained(min(TOXIC_BYTES, max(256, size)), stretches) or b" "


def lengths_under(ordinary: bytes, peculiar: bytes, frame: tuple[int, int]) -> Lengths:
    """The toxic dictionary holds the ordinary one too, so ordinary words cost the same in both.

    ``frame`` says where in the ordinary dictionary the lead and the trail of a window stand.
    """
    pad = b" " * 16  # the very end of a dictionary is not searched
    lead, trail = (ordinary[at : at + FRAME_BYTES] for at in frame)
    return Lengths(ordinary + pad, ordinary + peculiar + pad, lead, trail)


def _stretches(windows: list[bytes]) -> Iterator[bytes]:
    for at in range(0, len(windows), 10):
        yield b" ".join(windows[at : at + 10])


def features(evidence: Iterable[float], n: int) -> list[float]:
    """The three strongest windows, the logarithm of the number of windows, and a constant."""
    top = sorted((e for e in evidence if e > 0), reverse=True)[:3]
    return [*top, *[0.0] * (3 - len(top)), math.log(n + 3), 1.0]


def logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weights of a ridge logistic regression by damped Newton steps."""

    def loss(weights: np.ndarray) -> float:
        margin = rows @ weights
        return float(np.logaddexp(0, margin).sum() - labels @ margin + ridge / 2 * weights @ weights)

    weights = np.zeros(rows.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (labels - p) - ridge * weights
        step = np.linalg.solve((rows.T * (p * (1 - p))) @ rows + ridge * np.eye(len(weights)), slope)
        while loss(weights + step) > loss(weights) + 1e-12 and np.abs(step).max() > 1e-9:
            step /= 2
        weights = weights + step
        if np.abs(step).max() < 1e-7:
            break
    return weights


def weigh(measured: list[tuple[list[tuple[int, int]], int, int]]) -> np.ndarray:
    """The log odds of each cell, from documents as (cells with a gain, number of windows, label)."""
    counts, totals = np.zeros((2, GAINS, LENGTHS)), Counter(y for _, _, y in measured)
    for cells, _, y in measured:
        for cell in set(cells):
            counts[(y, *cell)] += 1
    evidence = np.log((counts[1] + 0.5) / (1 + totals[1])) - np.log((counts[0] + 0.5) / (1 + totals[0]))
    evidence[counts.sum(axis=0) < 3] = 0
    return evidence


def calibrate(measured: list) -> tuple[np.ndarray, np.ndarray, float]:
    """Evidence and weights from all, and the loss when halves learn and are judged in turn."""
    loss = 0.0
    for turn in (0, 1):
        evidence, others = weigh(measured[turn::2]), measured[1 - turn :: 2]
        rows, labels = _rows(evidence, others)
        margin = rows @ logistic(*_rows(evidence, measured[turn::2]))
        loss += float(np.logaddexp(0, margin).sum() - labels @ margin)
    evidence = weigh(measured)
    return evidence, logistic(*_rows(evidence, measured)), loss


def _rows(evidence: np.ndarray, measured: list) -> tuple[np.ndarray, np.ndarray]:
    rows = [features((evidence[c] for c in cells), n) for cells, n, _ in measured]
    return np.array(rows), np.array([float(y) for _, _, y in measured])


def fit(rows: list[tuple[str | None, int]]) -> ToxicityModel:
    """A model from (text, label) pairs: dictionaries from every other one, calibration on the rest.

    How well short words show depends on where lead and trail lie in the dictionary; of a few
    frames the one whose calibration predicts best is taken. Without both labels in both
    halves the model is not fitted and scores 0.
    """
    one: dict[bytes, bytes] = {}  # each distinct window is held once
    texts, labels = [[one.setdefault(w, w) for w in windows_of(t)] for t, _ in rows], [int(y) for _, y in rows]
    if [set(labels[k::2]) for k in (0, 1)] != [{0, 1}, {0, 1}]:
        return ToxicityModel(b"", b"", (0, 0), np.zeros((GAINS, LENGTHS)), np.zeros(5))
    ordinary, peculiar = ordinary_dictionary(texts[::2], labels[::2]), toxic_dictionary(texts[::2], labels[::2])
    held, answers, best = texts[1::2], labels[1::2], None
    words = list(set().union(*held))
    for frame in FRAMES:
        gains, sizes = lengths_under(ordinary, peculiar, frame).cells(words)
        with_gain = {words[i]: (int(gains[i]), int(sizes[i])) for i in np.flatnonzero(gains)}
        measured = [([with_gain[w] for w in windows if w in with_gain], len(windows), y) for windows, y in zip(held, answers)]
        evidence, weights, loss = calibrate(measured)
        if best is None or loss < best[0]:
            best = loss, ToxicityModel(ordinary, peculiar, frame, evidence, weights)
    return best[1]


class Scorer:
    """Scores texts in a worker; compresses each distinct word once while it is remembered."""

    def __init__(self, model: ToxicityModel) -> None:
        self.model = model
        self.lengths = lengths_under(model.ordinary, model.peculiar, model.frame)
        self.known: dict[bytes, float] = {}

    def scores(self, texts: Iterable[str | None]) -> Iterator[float]:
        block: list[list[bytes]] = []
        n = 0
        for text in texts:
            block.append(windows_of(text))
            n += len(block[-1])
            if n >= AT_ONCE * 4:
                yield from self._block(block)
                block, n = [], 0
        yield from self._block(block)

    def _block(self, block: list[list[bytes]]) -> Iterator[float]:
        needed = set().union(*block)
        if len(self.known) > REMEMBERED:
            self.known = {w: self.known[w] for w in needed if w in self.known}
        new = list(needed.difference(self.known))
        self.known.update(zip(new, self.model.evidence[self.lengths.cells(new)].tolist()))
        known = self.known.__getitem__
        rows = np.array([features(map(known, windows), len(windows)) for windows in block]).reshape(-1, 5)
        yield from (1 / (1 + np.exp(-np.clip(rows @ self.model.weights, -30, 30)))).tolist()


def _scorer(model: ToxicityModel) -> Scorer:
    return kept(("scorer", hash((model.peculiar, model.weights.tobytes()))), lambda: Scorer(model))


def score_column(model: ToxicityModel, text: Column, spark) -> Column:
    """The score of a text column; 0 for all where the model could not be fitted."""
    if not model.fitted:
        return F.lit(0.0)
    bound_batches(spark)
    shipped = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_scorer(shipped.value).scores(texts)), dtype="float64")

    return score(text)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY, folds: int = 3, held_fold: int = 1, max_bytes: int = MAX_BYTES,
) -> ToxicityModel:
    """A model fitted on labelled rows outside the held-out fold of the id.

    At most ``max_toxic`` toxic and ``max_ordinary`` other documents are used, those with
    the smallest hashes of their ids, one text for each id, and of these as many as come to
    ``max_bytes``; this bounded sample is all that reaches the driver. A label that comes twice
    with two values counts as toxic.
    """
    marks = pick(labels, doc_id=id_col, toxic=label_col).where("doc_id is not null and toxic in (0, 1)")
    marks = marks.where(crc_fold(F.col("doc_id"), folds) != held_fold).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.withColumn("turn", F.xxhash64("doc_id"))
    chosen = [marks.where(F.col("toxic") == y).orderBy("turn", "doc_id").limit(n) for y, n in ((1, max_toxic), (0, max_ordinary))]
    named = pick(docs, doc_id=id_col, text=text_col)
    hashed = named.withColumn("hash", F.xxhash64("text"))
    # first which text, by numbers alone: a labelled id may stand on any number of rows
    sizes = hashed.withColumn("size", F.octet_length(F.coalesce("text", F.lit("")))).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    found = sizes.groupBy("doc_id", "turn", "toxic").agg(F.min("hash").alias("hash"), F.min_by("size", "hash").alias("size"))
    taken, total = [], 0
    for row in sorted(found.collect(), key=lambda r: (r["turn"], r["doc_id"])):
        if total + row["size"] <= max_bytes:
            taken.append((row["doc_id"], row["hash"], row["turn"], row["toxic"]))
            total += row["size"]
    if not taken:
        return fit([])
    kind = named.schema["doc_id"].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(taken, f"doc_id {kind}, hash long, turn long, toxic int")
    texts = hashed.join(F.broadcast(wanted), ["doc_id", "hash"]).groupBy("doc_id", "turn", "toxic").agg(F.first("text").alias("text"))
    rows = sorted(texts.collect(), key=lambda r: (r["turn"], r["doc_id"]))
    return fit([(r["text"], r["toxic"]) for r in rows])


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` per row of ``docs``.

    Null and empty texts are scored as documents without windows. A null id is not held out
    (it belongs to no fold) and never learned from; repeated rows are scored alike; an empty
    table gives an empty result; without usable labels every score is 0. Only text enters
    a score.
    """
    model = train(docs, labels, id_col, text_col, **settings)
    chosen = pick(docs, doc_id=id_col, text=text_col)
    held = F.coalesce(crc_fold(F.col("doc_id"), settings.get("folds", 3)) == settings.get("held_fold", 1), F.lit(False))
    return chosen.select(
        "doc_id", held.alias("held_out"), score_column(model, F.col("text"), docs.sparkSession).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not found toxic, all columns as they are.

    Rows with a null, empty or wordless text stay; repeated rows stay or go together; without
    usable labels all stay; an empty table stays empty; a column called like one of ours is no matter.
    """
    model, score = train(docs, labels, text_col=text_col), unused(docs, "score")
    scored = docs.withColumn(score, score_column(model, F.col(quoted(text_col)), docs.sparkSession))
    return scored.where(F.col(score) < THRESHOLD).drop(score)
