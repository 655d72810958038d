"""Jobs that change a stored corpus.

Each returns the corpus as it should become; `ArticleStore.replace` or
`ArticleStore.append` then makes it so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import assume_utc, uniform_draw, was_naive
from ..functions.indicators import Indicator
from ..functions.urls import article_id
from ..operators.corpus import sparse_embed, with_tags
from ..operators.merge import delete_by_id, new_articles, update_fields, upsert
from ..operators.quality import Rules, article_rules, validate
from ..session import scratch_dir
from .build import articles_from_markdown


def regenerate_tags(
    articles: DataFrame,
    common_words: Sequence[str] | DataFrame,
    indicators: Mapping[str, Indicator] | None = None,
) -> DataFrame:
    """The corpus with all tags computed again from its content.

    Tags are replaced where the article lies: no join, no shuffle.
    """
    return with_tags(articles, common_words, "content", indicators=indicators).select(
        *articles.columns
    )


def modified_dates(
    articles: DataFrame, fields: Sequence[str] = ("publish_date", "inserted_at"), key: str = "id"
) -> DataFrame:
    """`(key, *fields)` of articles whose date text named no zone, as instants."""
    changed = F.lit(False)
    for f in fields:
        changed |= F.coalesce(was_naive(F.col(f)), F.lit(False))
    return articles.filter(changed).select(
        key, *[assume_utc(F.col(f)).alias(f) for f in fields]
    )


def unreadable_dates(
    articles: DataFrame, fields: Sequence[str] = ("publish_date", "inserted_at"), key: str = "id"
) -> DataFrame:
    """`(key, field, value)` of date texts that cannot be read, for which `add_timezone` rejects an article."""
    texts = [F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value"), assume_utc(F.col(f)).alias("read")) for f in fields]
    each = articles.select(key, F.inline(F.array(*texts)))
    return each.filter("value IS NOT NULL AND read IS NULL").select(key, "field", "value")


def add_timezone(
    articles: DataFrame, fields: Sequence[str] = ("publish_date", "inserted_at")
) -> tuple[DataFrame, DataFrame]:
    """The articles with date text read as instants, UTC where no zone was named, and rejects.

    An article with a date that is there but cannot be read is a reject, unchanged, with
    a `reason`; nothing of it gets lost.
    """
    bad = F.array_compact(
        F.array(*[F.when(F.col(f).isNotNull() & assume_utc(F.col(f)).isNull(), F.lit(f"{f} is not a date")) for f in fields])
    )
    checked = articles.withColumn("__bad", bad)
    good = checked.filter(F.size("__bad") == 0).drop("__bad").withColumns({f: assume_utc(F.col(f)) for f in fields})
    rejected = checked.filter(F.size("__bad") > 0).withColumn("reason", F.array_join("__bad", "; ")).drop("__bad")
    return good, rejected


def import_articles(
    batch: DataFrame,
    store: DataFrame,
    as_of: Column,
    embed: bool = False,
    rules: Rules | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Valid articles of an export that are not stored yet, and rejects."""
    fresh, no_url = new_articles(batch, store)
    good, bad = validate(fresh, rules or article_rules(as_of))
    rejected = no_url.select("id", "url", "reason").unionByName(
        bad.select(
            "id",
            "url",
            F.array_join(
                F.transform(
                    "errors", lambda e: F.concat(e["field"], F.lit(" "), e["message"])
                ),
                "; ",
            ).alias("reason"),
        )
    )
    return (sparse_embed(good) if embed else good), rejected


def load_corpus(
    store: DataFrame, parsed: DataFrame, start: Column, end: Column, seed: int = 0
) -> DataFrame:
    """The corpus with parsed Markdown files saved into it."""
    return upsert(store, articles_from_markdown(parsed, start, end, seed))


def delete_corpus(store: DataFrame, parsed: DataFrame) -> DataFrame:
    """The corpus without the articles of parsed Markdown files."""
    return delete_by_id(store, parsed.select(article_id(F.col("id")).alias("id")))


def backfill_headers(
    files: DataFrame, sources: DataFrame, descriptions: DataFrame, seed: int = 0
) -> DataFrame:
    """Header fields for raw Markdown `(path, content)` files that have none.

    Title comes from the file name and id from the whole text; `sources(source)`
    are dealt out repeatably by path, and `descriptions(path, description)` are
    supplied.
    """
    numbered = _numbered(sources.select("source").filter("source is not null").distinct(), "source")
    pick = uniform_draw(F.col("path"), F.lit(numbered.count()), seed)
    files = files.select("path", "content").withColumn("__pick", pick).join(numbered, F.col("__pick") == F.col("__number"), "left")
    source = F.col("source")
    return files.join(descriptions, "path", "left").select(
        "path",
        article_id(F.col("content")).alias("id"),
        F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("title"),
        "description",
        source.alias("source"),
        F.lit(None).cast("string").alias("image"),
        "content",
    )


def _numbered(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their place in sorted order as `__number`, from 0.

    Parts of the order are numbered where they lie; only the sizes of parts meet in one task.
    """
    ordered = values.repartitionByRange(column).sortWithinPartitions(column)
    path = scratch_dir(values.sparkSession, "numbered")
    # Written once: a part keeps its number and size however often it is read.
    ordered.withColumn("__id", F.monotonically_increasing_id()).write.parquet(path)
    parts = values.sparkSession.read.parquet(path)
    part, low = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = parts.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)  # one row per part
    before = sizes.select("__part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    placed = parts.withColumn("__part", part).join(before, "__part")
    return placed.select(column, (F.col("__before") + low).alias("__number"))


def with_header(filled: DataFrame) -> DataFrame:
    """`(path, content)` with the filled-in header written in front of the text."""

    def line(key: str) -> Column:
        quoted = F.replace(F.col(key), F.lit("'"), F.lit("''"))
        return F.concat(F.lit(f"{key}: '"), quoted, F.lit("'"))

    header = F.concat_ws("\n", *[line(k) for k in ("id", "title", "description", "source")])
    return filled.select(
        "path",
        F.concat(F.lit("---\n"), header, F.lit("\n---\n\n"), F.col("content")).alias(
            "content"
        ),
    )


__all__ = [
    "add_timezone",
    "backfill_headers",
    "delete_corpus",
    "import_articles",
    "load_corpus",
    "modified_dates",
    "regenerate_tags",
    "update_fields",
    "with_header",
]
