"""The named queries of this subpackage: one per operator, over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidegauge.llm import (
    bpe, content_sort, decontaminate, hard_negatives, html_crf, language, quality, rendezvous, simhash_pivots, spelling, token_binary, toxicity,
    warc_zip,
)
from tidegauge.llm.common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


@query()
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_files(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query(warc_zip.ROUND_TRIP_SQL)
def op2_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archive_round_trip(load(spark, sf_dir, "pages"))


@query()
def op3_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.near_duplicates(load(spark, sf_dir, "documents"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query(rendezvous.SHARDS_SQL)
def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendezvous.shard_documents(load(spark, sf_dir, "documents"))


@query()
def op6_bpe_speculate_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trips(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query()
def op8_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query()
def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_languages(load(spark, sf_dir, "documents"))


@query(content_sort.EXACT_DUPLICATES_SQL)
def op10_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(load(spark, sf_dir, "documents"))


@query()
def op11_spelling_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(load(spark, sf_dir, "documents"))


@query()
def op12_crf_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.main_texts(load(spark, sf_dir, "pages"))


@query()
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined_embeddings(load(spark, sf_dir, "embeddings"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
