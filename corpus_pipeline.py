"""The corpus pipeline: toxicity, exact and near duplicates, benchmark passages, token ids.

Each stage takes what the one before it kept, decides on whole texts, and writes nothing
itself; :func:`run` writes every stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegauge.llm import bpe, content_sort, decontaminate, shingle_copies, toxicity
from tidegauge.llm.common import load, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, load(spark, sf_dir, "labels"))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return content_sort.without_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_copies.first_of_groups(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` with the number and digest of its token ids, and the digest of what they decode to.

    Fewer characters at once than alone: executors still hold what the stages before took.
    """
    return bpe.round_trips(docs, public_tokenizers.path("word_bpe_49k.json"), at_once=1 << 20)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_duplicates", drop_exact_duplicates),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_passages),
    ("encoding", encode),
]

#: No stage but the second has a form in SQL; tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"stage-{name}")
    return docs
