"""From raw documents to token ids: language, near duplicates, benchmark passages, mixing, encoding.

Every stage is a function (spark, docs, sf_dir) -> DataFrame over all rows its
predecessor kept. All but the last return the columns of documents, further ones included.
Null and empty texts have no letters and go in the first stage. Rows alike in id and text become one
in the second, where ties are settled by the smallest id. Very long texts are handled whole throughout, and an empty table passes
through all stages as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from articlelake.llm import decontamination, langid, mixing, neardup, tokens
from articlelake.llm.common import name, written

#: The stages learn, hash and balance over what is there, which SQL cannot express.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, or without a language of at least half their letters, go."""
    model = langid.learn(docs.filter(~langid.held_out(name("doc_id"))), "doc_id", "text", "lang")
    return langid.keep_known(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates stays, at the similarity that `op6` links at."""
    return neardup.keep_one_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids are written, and read back: doc_id, start, n_tokens, ids_crc32."""
    return tokens.read_back(spark, tokens.write_ids(docs))


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents, each written to the shared folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for stage, function in STAGES:
        docs = written(function(spark, docs, sf_dir), stage)
    return docs
