"""One query for each operator of this subpackage, the pipeline, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from articlelake.llm import (
    decontamination,
    exactdedup,
    langid,
    linededup,
    mixing,
    neardup,
    negatives,
    quotes,
    surrogates,
    tokens,
    topk,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


@_query(mixing.SQL)
def op1_mix_sources(spark, sf):
    return mixing.mix(_read(spark, sf, "documents")).documents()


@_query()
def op2_surrogates(spark, sf):
    return surrogates.replace_entities(_read(spark, sf, "documents"))


@_query()
def op3_toxicity(spark, sf):
    return toxicity.train_and_score(_read(spark, sf, "documents"), _read(spark, sf, "labels"))


@_query(linededup.SQL)
def op4_line_runs(spark, sf):
    kept = linededup.dedup_lines(_read(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@_query()
def op5_benchmark_index(spark, sf):
    return decontamination.decontaminate(_read(spark, sf, "documents"), _read(spark, sf, "benchmark"))


@_query()
def op6_minhash_groups(spark, sf):
    return neardup.near_groups(_read(spark, sf, "documents"))


@_query(exactdedup.SQL)
def op7_exact_dedup(spark, sf):
    return exactdedup.exact_groups(_read(spark, sf, "documents"))


@_query()
def op8_language_spans(spark, sf):
    return langid.train_and_identify(_read(spark, sf, "documents"))


@_query()
def op9_quote_links(spark, sf):
    return quotes.reply_order(_read(spark, sf, "conversations"))


@_query()
def op10_token_ids(spark, sf):
    folder = tokens.write_ids(_read(spark, sf, "documents"))
    return tokens.read_back(spark, folder)


@_query()
def op11_whitening(spark, sf):
    return whitening.whiten(_read(spark, sf, "embeddings"))


@_query(negatives.SQL)
def op12_hard_negatives(spark, sf):
    label = negatives.relabelled(F.col("vec_id"), F.col("label"))
    return negatives.hard_negatives(_read(spark, sf, "embeddings"), label=label)


@_query(topk.SQL)
def op13_exact_top_k(spark, sf):
    return topk.exact_top_k(_read(spark, sf, "embeddings"))


@_query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)
