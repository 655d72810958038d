"""Queues of articles to judge, and the judgements applied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import update_fields

# The labels in index order, and the incident codes.
LABELS = (
    "trends",
    "vulnerability",
    "incident",
    "research",
    "apt",
    "ransomware group",
    "malware",
)
NO_LABEL = "none"
INCIDENT_UNKNOWN, INCIDENT_NO, INCIDENT_YES = 0, 1, 2


def query_articles(
    articles: DataFrame,
    limit: int = 0,
    sort_by: str | None = None,
    sort_order: str = "desc",
    sources: Sequence[str] | None = None,
    fields: Sequence[str] | None = None,
    key: str = "id",
) -> DataFrame:
    """Filter by source profile, sort (ties by key), limit and project.

    `limit=0` means all rows.
    """
    found = articles
    if sources is not None:
        found = found.filter(F.col("profile").isin(*sources))
    if sort_by is not None:
        by = F.desc_nulls_last(sort_by) if sort_order == "desc" else F.asc_nulls_last(sort_by)
        found = found.orderBy(by, key)
    if limit:
        found = found.limit(limit)
    if fields is not None:
        found = found.select(*dict.fromkeys([key, *fields]))
    return found


def label_queue(
    articles: DataFrame, limit: int = 1000, filter_first: bool = False
) -> DataFrame:
    """Unlabelled articles among the newest `limit`.

    With `filter_first`, the newest `limit` unlabelled ones.
    """
    unlabelled = F.coalesce(F.size("ml.labels"), F.lit(0)) <= 0
    if filter_first:
        return query_articles(articles.filter(unlabelled), limit, "publish_date")
    return query_articles(articles, limit, "publish_date").filter(unlabelled)


def incident_queue(articles: DataFrame) -> DataFrame:
    """Articles nobody has judged yet, newest first."""
    return query_articles(
        articles.filter(F.col("ml.incident") == INCIDENT_UNKNOWN), 0, "publish_date"
    )


def label_names(choice: Column) -> Column:
    """`"0,3"` to label names; no choice gives `["none"]`; a bad one gives null."""
    names = F.transform(F.split(choice, ","), _label_name)
    bad = F.exists(names, lambda n: n.isNull())
    return F.when(choice == "", F.array(F.lit(NO_LABEL))).when(~bad, names)


def _label_name(index: Column) -> Column:
    i = F.trim(index).try_cast("int")
    table = F.array(*[F.lit(n) for n in LABELS])
    return F.when(i.between(0, len(LABELS) - 1), F.get(table, i))


def apply_labels(
    articles: DataFrame, decisions: DataFrame, order: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Store `(id, choice)` decisions in `ml.labels`; unreadable ones are rejected.

    Of several readable decisions on an article the last by `order` counts; without an
    order such decisions are an error.
    """
    named = decisions.withColumn("labels", label_names(F.col("choice")))
    rejected = named.filter("labels is null").drop("labels").withColumn(
        "reason", F.lit("not a list of label numbers")
    )
    return _with_ml(articles, named.filter("labels is not null"), "labels", order), rejected


def incident_code(is_incident: Column) -> Column:
    return F.when(is_incident, F.lit(INCIDENT_YES)).otherwise(F.lit(INCIDENT_NO))


def apply_incident(
    articles: DataFrame, decisions: DataFrame, order: Sequence[str] | None = None
) -> DataFrame:
    """Store `(id, is_incident)` decisions in `ml.incident`; `order` as for labels."""
    coded = decisions.withColumn("incident", incident_code(F.col("is_incident")))
    return _with_ml(articles, coded, "incident", order)


def _with_ml(
    articles: DataFrame, decisions: DataFrame, member: str, order: Sequence[str] | None
) -> DataFrame:
    """Update one member of `ml` where a decision exists."""
    flat = articles.withColumn("__value", F.col("ml")[member])
    changed = update_fields(
        flat, decisions.withColumn("__value", F.col(member)), ["__value"], order=order
    )
    empty = F.struct(
        F.lit(None).cast("array<string>").alias("labels"),
        F.lit(INCIDENT_UNKNOWN).alias("incident"),
    )
    ml = F.coalesce(F.col("ml"), empty).withField(member, F.col("__value"))
    kept = F.col("ml").isNull() & F.col("__value").isNull()
    return changed.withColumn("ml", F.when(~kept, ml)).drop("__value")
