"""Sinks: JSON exports, backups, Markdown folders, bucketed tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_articles_json(articles: DataFrame, path: str) -> None:
    """JSON lines, dates as text; read back by `read_articles_json`."""
    articles.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_backup(indices: Mapping[str, DataFrame], path: str) -> None:
    """All documents of each index, without query highlights, as gzip JSON."""
    for name, articles in indices.items():
        (
            articles.drop("highlights")
            .withColumn("index", F.lit(name))
            .write.mode("append")
            .partitionBy("index")
            .option("compression", "gzip")
            .json(path)
        )


def write_raw_backup(documents: DataFrame, path: str) -> None:
    """Untyped documents (`value` holds JSON text), unchanged, as gzip lines."""
    documents.select("value").write.mode("errorifexists").option(
        "compression", "gzip"
    ).text(path)


def article_markdown() -> Column:
    """One article as a Markdown document with a header."""

    def line(label: str, value: Column) -> Column:
        return F.concat(F.lit(f"**{label}:** "), value)

    facts = F.concat_ws(
        "  \n",
        line("Source", F.col("source")),
        line("Author", F.col("author")),
        line("Published", F.date_format("publish_date", "yyyy-MM-dd HH:mm:ss")),
        line("Address", F.col("url")),
        line("Tags", F.nullif(F.array_join("tags.automatic", ", "), F.lit(""))),
    )
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), F.col("title")),
        F.concat(F.lit("> "), F.col("description")),
        facts,
        F.col("formatted_content"),
    )


def markdown_documents(articles: DataFrame) -> DataFrame:
    return articles.select("profile", "id", article_markdown().alias("markdown"))


def write_markdown(articles: DataFrame, path: str, file_per_article: bool = False) -> None:
    """Rendered articles below one folder per profile.

    By default a folder holds Parquet files of `(id, markdown)`. With
    `file_per_article` each article gets a folder of its own, for small exports
    that people will open by hand.
    """
    documents = markdown_documents(articles)
    if file_per_article:
        documents.withColumnRenamed("markdown", "value").write.mode(
            "errorifexists"
        ).partitionBy("profile", "id").text(path)
    else:
        documents.write.mode("errorifexists").partitionBy("profile").parquet(path)


def write_bucketed(articles: DataFrame, table: str, path: str, buckets: int, key: str = "id") -> None:
    """Catalog table clustered by key: merges on it then leave the store in place."""
    (
        articles.write.mode("errorifexists")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .format("parquet")
        .saveAsTable(table)
    )
