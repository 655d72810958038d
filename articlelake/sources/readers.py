"""Readers: crawled pages, feeds, JSON exports, Markdown trees, word lists, rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import page_urls
from ..operators.pages import split_by_status
from ..schemas import ARTICLE_SCHEMA, PROFILE_SCHEMA


def read_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Crawled pages fetched with status 200, and the rest with a reason."""
    return split_by_status(spark.read.parquet(path))


def read_articles_json(
    spark: SparkSession, path: str, array: bool = False, schema: T.StructType = ARTICLE_SCHEMA
) -> DataFrame:
    """Articles from JSON lines, or from files holding one JSON array each.

    Prefer lines: Spark splits them, while an array file is one task.
    """
    return spark.read.schema(schema).option("multiLine", array).json(path)


def read_profiles(
    spark: SparkSession, path: str, include_disabled: bool = False
) -> DataFrame:
    """Site rules; a missing `enabled` counts as enabled."""
    rules = spark.read.schema(PROFILE_SCHEMA).option("multiLine", True).json(path)
    on = F.coalesce(F.col("enabled"), F.lit(True))
    return rules if include_disabled else rules.filter(on)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, trimmed, each once."""
    return spark.read.text(path).select(F.trim("value").alias("token")).distinct()


# --------------------------------------------------------------------------- feeds

# Where each feed format keeps an entry's id.
_FEED = (
    "channel struct<item: array<struct<guid: string>>>, "
    "item array<struct<_about: string, `_rdf:about`: string>>, "
    "entry array<struct<id: string>>"
)


def feed_urls(feeds: DataFrame, max_per_feed: int = 10) -> DataFrame:
    """Ids of the first entries of each feed, in feed order, repeats kept.

    `feeds` holds `feed_url` and `xml`, and may hold more columns, which stay.
    An unreadable feed, or one whose entries lack an id, gives one row with a
    null `url` and a `reason`.
    """
    parsed = F.from_xml(F.col("xml"), _FEED, {"mode": "PERMISSIVE"})
    rss = F.transform(F.col("__feed.channel.item"), lambda e: F.trim(e["guid"]))
    rdf = F.transform(
        F.col("__feed.item"), lambda e: F.coalesce(e["_about"], e["_rdf:about"])
    )
    atom = F.transform(F.col("__feed.entry"), lambda e: F.trim(e["id"]))
    is_feed = F.col("xml").rlike(r"<(?:\w+:)?(?:rss|feed|RDF)[\s>]")
    none = F.array().cast("array<string>")
    ids = F.when(is_feed, F.coalesce(rss, rdf, atom, none))
    kept = [F.col(c) for c in feeds.columns if c != "xml"]
    capped = feeds.withColumn("__feed", parsed).select(
        *kept, F.slice(ids, 1, max_per_feed).alias("__ids")
    )
    broken = F.col("__ids").isNull() | F.exists("__ids", lambda i: i.isNull())
    rows = F.when(
        broken, F.array(F.lit(None).cast("string"))
    ).otherwise(F.col("__ids"))
    reason = F.when(F.col("__ids").isNull(), F.lit("not a feed")).when(
        broken, F.lit("entry without id")
    )
    return (
        capped.withColumn("reason", reason)
        .select(*kept, F.posexplode_outer(rows).alias("pos", "url"), "reason")
        .filter("pos is not null")
    )


def expand_url_template(
    templates: DataFrame, column: str, start: int = 2, size: int = 5
) -> DataFrame:
    """Page addresses of each template; one without `%` is an error."""
    return templates.withColumn("url", F.explode(page_urls(F.col(column), start, size)))


# ------------------------------------------------------------------------ Markdown

_FRONT = r"(?s)\A\s*---[ \t]*\r?\n(.*?\n)?---[ \t]*(?:\r?\n(.*))?\z"
REQUIRED_KEYS = ("id", "title", "description", "source")


def _header_value(header: Column, key: str) -> Column:
    """Value of a flat `key: value` header line, with folded lines and quotes undone."""
    raw = F.regexp_extract(header, rf"(?m)^{key}[ \t]*:[ \t]*([^\n]*(?:\n[ \t]+[^\n]*)*)", 1)
    flat = F.trim(F.regexp_replace(raw, r"\s*\n\s*", " "))
    single = F.replace(
        F.regexp_extract(flat, r"(?s)^'(.*)'$", 1), F.lit("''"), F.lit("'")
    )
    double = F.regexp_replace(F.regexp_extract(flat, r'(?s)^"(.*)"$', 1), r'\\(["\\])', "$1")
    value = (
        F.when(flat.rlike(r"(?s)^'.*'$"), single)
        .when(flat.rlike(r'(?s)^".*"$'), double)
        .when(flat.isin("null", "~"), F.lit(""))
        .otherwise(flat)
    )
    return F.nullif(value, F.lit(""))


def read_markdown_raw(spark: SparkSession, path: str) -> DataFrame:
    """`(path, content)` of one Markdown file or of a whole tree."""
    single = path.endswith(".md")
    files = spark.read.text(
        path,
        wholetext=True,
        recursiveFileLookup=not single,
        pathGlobFilter=None if single else "*.md",
    )
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")
    )


def parse_markdown(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split `(path, content)` files into header fields and body, with rejects."""
    content = F.col("content")
    header = F.regexp_extract(content, _FRONT, 1)
    body = F.when(content.rlike(_FRONT), F.regexp_extract(content, _FRONT, 2)).otherwise(
        content
    )
    parsed = files.select(
        F.col("path").alias("file_path"),
        *[_header_value(header, k).alias(k) for k in (*REQUIRED_KEYS, "image")],
        F.regexp_replace(body, r"(?U)^\s++|(?<!\s)\s++$", "").alias("content"),
    )
    errors = F.array_compact(
        F.array(
            *[
                F.when(F.col(k).isNull(), F.lit(f"{k} is missing"))
                for k in REQUIRED_KEYS
            ]
        )
    )
    checked = parsed.withColumn("errors", errors)
    return (
        checked.filter(F.size("errors") == 0).drop("errors"),
        checked.filter(F.size("errors") > 0),
    )


def read_markdown_corpus(
    spark: SparkSession, path: str
) -> tuple[DataFrame, DataFrame]:
    """Articles written as Markdown with a header, and files lacking a key."""
    return parse_markdown(read_markdown_raw(spark, path))


def read_raw_documents(spark: SparkSession, path: str) -> DataFrame:
    """Untyped documents, one JSON value per line, kept as text."""
    return spark.read.text(path).filter(F.trim("value") != "")


__all__: Sequence[str] = [
    "expand_url_template",
    "feed_urls",
    "parse_markdown",
    "read_articles_json",
    "read_markdown_corpus",
    "read_markdown_raw",
    "read_pages",
    "read_profiles",
    "read_raw_documents",
    "read_word_list",
]
