"""From crawled pages to article records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import spread_dates
from ..functions.html import Converter, InlineConverter
from ..functions.indicators import Indicator
from ..functions.text import clean_text
from ..functions.urls import article_id, profile_slug
from ..operators.corpus import with_tags
from ..operators.merge import align_schema, not_stored
from ..operators.pages import split_by_status, with_content, with_meta, with_rules, without_rules
from ..schemas import ARTICLE_SCHEMA

def build_articles(
    pages: DataFrame,
    profiles: DataFrame,
    common_words: Sequence[str] | DataFrame,
    as_of: Column,
    store: DataFrame | None = None,
    converters: Mapping[str, Converter] | None = None,
    indicators: Mapping[str, Indicator] | None = None,
    inline: Mapping[str, InlineConverter] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Articles of `(url, html, profile)` pages, and rejected pages with `errors`.

    A page fetched with another status than 200, without a known profile, or
    without a field its profile asks for is rejected: articles, rejects and pages
    already stored are all pages. Stored ones are dropped before anything is parsed. From there to
    the finished record no row is shuffled: metadata, content, tags and
    indicators are all computed in the page's own row.
    """
    usable, failed = split_by_status(pages)
    if store is not None:
        usable = not_stored(usable, store, "url")
    unknown = without_rules(usable, profiles)
    read = with_meta(with_rules(usable, profiles), as_of)
    rejected = (
        read.filter(F.size("errors") > 0)
        .select("url", "profile", "errors")
        .unionByName(failed.select("url", "profile", F.array("reason").alias("errors")))
        .unionByName(unknown.select("url", "profile", F.array(F.lit("no profile")).alias("errors")))
    )
    good = with_content(read.filter(F.size("errors") == 0), converters, inline)
    articles = good.select(
        article_id(F.col("url")).alias("id"),
        "meta.title",
        "meta.description",
        "url",
        "meta.image_url",
        "profile",
        F.col("site_name").alias("source"),
        "meta.author",
        "meta.publish_date",
        as_of.alias("inserted_at"),
        clean_text(F.col("content_text")).alias("content"),
        F.col("markdown").alias("formatted_content"),
    )
    tagged = with_tags(articles, common_words, "content", indicators=indicators)
    ml = F.struct(
        F.array().cast("array<string>").alias("labels"), F.lit(0).alias("incident")
    )
    return align_schema(tagged.withColumn("ml", ml), ARTICLE_SCHEMA), rejected


def parse_results(pages: DataFrame, profiles: DataFrame, as_of: Column) -> DataFrame:
    """`(profile, url, ok)`: whether each page yields an article."""
    read = with_meta(with_rules(pages, profiles), as_of)
    unknown = without_rules(pages, profiles).select("profile", "url", F.lit(False).alias("ok"))
    return read.select("profile", "url", (F.size("errors") == 0).alias("ok")).unionByName(unknown)


def articles_from_markdown(
    parsed: DataFrame, start: Column, end: Column, seed: int = 0, url: Column | None = None
) -> DataFrame:
    """Articles of parsed Markdown files, dated evenly in `[start, end)`.

    They were not crawled; without a `url` each gets one of its own, made of its id.
    """
    url = F.concat(F.lit("urn:article:"), F.col("id")) if url is None else url
    dated = parsed.withColumn(
        "__date", spread_dates(F.col("id"), start, end, seed)
    )
    articles = dated.select(
        article_id(F.col("id")).alias("id"),
        "title",
        "description",
        url.alias("url"),
        F.coalesce("image", F.lit("")).alias("image_url"),
        profile_slug(F.col("source")).alias("profile"),
        "source",
        F.col("source").alias("author"),
        F.col("__date").alias("publish_date"),
        F.col("__date").alias("inserted_at"),
        "content",
        F.col("content").alias("formatted_content"),
    )
    return align_schema(articles, ARTICLE_SCHEMA)
