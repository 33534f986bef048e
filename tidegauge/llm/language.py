"""Language identification as inference of a mixture.

Each language is a distribution over hashed byte trigrams, counted over all training text.
A document is a mixture of languages whose proportions expectation-maximisation estimates
from the likelihoods of its trigrams; languages join the document's set, the strongest
first, as long as the penalised likelihood of the set grows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import crc_fold, pick

BUCKETS = 1 << 16
#: Added to each count; iterations and the change that ends them; overlapping trigrams per independent one.
SMOOTHING, ROUNDS, STILL, OVERLAP = 0.05, 40, 1e-4, 3.0
#: Characters of a text turned into trigrams at a time.
AT_ONCE = 1 << 20
UNDETERMINED = "und"

_letter = regex.compile(r"\p{L}").search


def trigram_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the byte trigrams of a lower-cased text."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    data = np.frombuffer(b" " + " ".join(text.lower().split()).encode() + b" ", dtype=np.uint8)
    for at in range(0, len(data) - 2, AT_ONCE):
        part = data[at : at + AT_ONCE + 2].astype(np.uint32)
        mixed = part[:-2] * np.uint32(0x9E3779B1) + part[1:-1] * np.uint32(0x85EBCA6B) + part[2:] * np.uint32(0xC2B2AE35)
        counts += np.bincount((mixed ^ mixed >> np.uint32(15)) >> np.uint32(8) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, and the logarithm of each bucket's share in them (languages by buckets)."""

    languages: list[str]
    log_shares: np.ndarray


def mix(shares: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the languages (rows of ``shares``) and the log-likelihood they reach."""
    n = counts.sum()
    weights = np.full(len(shares), 1 / len(shares))
    for _ in range(ROUNDS if len(shares) > 1 else 0):
        joint = weights @ shares
        fresh = weights * (shares @ (counts / joint)) / n
        moved = np.abs(fresh - weights).max()
        weights = fresh
        if moved < STILL:
            break
    return weights, float(counts @ np.log(weights @ shares))


def identify(model: LanguageModel, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
    """The main language, its proportion, and the set of languages with proportions."""
    if not text or not model.languages or not _letter(text):
        return UNDETERMINED, 0.0, []
    counts = trigram_counts(text)
    present = np.flatnonzero(counts)
    counts, logs = counts[present].astype(float), model.log_shares[:, present]
    peak = logs.max(axis=0)
    shares = np.exp(logs - peak)  # a factor per trigram changes no proportion and no comparison
    order = np.argsort(-mix(shares, counts)[0], kind="stable")
    penalty = 0.5 * np.log(counts.sum() + 1)
    best = None
    for size in range(1, len(order) + 1):
        chosen = order[:size]
        weights, likelihood = mix(shares[chosen], counts)
        value = likelihood / OVERLAP - penalty * size
        if best is not None and value <= best[0]:
            break
        best = value, chosen, weights
    _, chosen, weights = best
    main = int(np.argmax(weights))
    found = [(model.languages[i], float(w)) for i, w in zip(chosen, weights)]
    return found[main][0], min(1.0, found[main][1]), found


def train(docs: DataFrame, lang_col: str, text_col: str) -> LanguageModel:
    """A model of all rows with a language and a text.

    Tasks count trigrams per language and send one number per bucket they met; what reaches
    the driver grows with the languages, not with the documents.
    """
    rows = pick(docs, lang=lang_col, text=text_col).where("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: defaultdict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, dtype=np.int64))
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                totals[lang] += trigram_counts(text.as_py())
        for lang, counts in totals.items():
            present = np.flatnonzero(counts)
            yield pa.RecordBatch.from_pydict({
                "lang": [lang] * len(present), "bucket": pa.array(present, pa.int32()), "n": pa.array(counts[present], pa.int64()),
            })

    counted = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    table = np.zeros((len(languages), BUCKETS))
    table[np.searchsorted(languages, counted["lang"].to_numpy(str)) if languages else [], counted["bucket"].to_numpy(int)] = counted["n"]
    table += SMOOTHING
    return LanguageModel(languages, np.log(table / table.sum(axis=1, keepdims=True)))


def identify_languages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, held_fold: int = 0
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``languages`` per row of ``docs``.

    Learned from rows with a language whose id is outside the held-out fold; predictions see
    the text only. A text that is null or has no letter is ``und`` with score 0. A null id
    belongs to no fold: not held out and not learned from. Repeated rows count as often as
    they occur; without any training text all is ``und``; an empty table gives an empty
    result. Whole texts are read. ``score`` is the main language's proportion.
    """
    chosen = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    fold = crc_fold(F.col("doc_id"), folds)
    shipped = docs.sparkSession.sparkContext.broadcast(train(chosen.where(fold != held_fold), "lang", "text"))

    @F.pandas_udf("lang_pred string, score double, languages array<struct<lang:string,share:double>>")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        rows = [identify(shipped.value, t) for t in texts]
        return pd.DataFrame({
            "lang_pred": pd.Series([r[0] for r in rows], dtype=object),
            "score": pd.Series([r[1] for r in rows], dtype=float),
            "languages": pd.Series([[{"lang": lang, "share": share} for lang, share in r[2]] for r in rows], dtype=object),
        })

    held = F.coalesce(fold == held_fold, F.lit(False)).alias("held_out")
    return chosen.select("doc_id", held, predicted("text").alias("r")).select("doc_id", "held_out", "r.*")
