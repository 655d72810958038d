"""Validation, corrections, reference checks and run reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.dates import assume_utc
from ..functions.urls import is_valid_url
from ..session import broadcast_if_bounded
from .labels import query_articles
from .merge import last_written

#: field -> [(message, expression that is true for a good value)]
Rules = Mapping[str, Sequence[tuple[str, Column]]]


def article_rules(as_of: Column) -> dict[str, list[tuple[str, Column]]]:
    """What every stored article must satisfy; dates may be text or timestamps."""

    def filled(name: str) -> tuple[str, Column]:
        return "is required", F.coalesce(F.col(name) != "", F.lit(False))

    date = assume_utc(F.col("publish_date").cast("string"))
    return {
        "id": [filled("id")],
        "title": [filled("title")],
        "description": [filled("description")],
        "url": [filled("url"), ("is not an http address", is_valid_url(F.col("url")))],
        "publish_date": [
            ("is not a date", date.isNotNull()),
            ("is in the future", date <= as_of),
        ],
    }


def with_errors(df: DataFrame, rules: Rules) -> DataFrame:
    """Add `errors`: one `struct<field, message>` per broken rule.

    A rule that gives null is broken only by the field's own first rule, so a
    missing value is reported once.
    """
    checks = []
    for field, tests in rules.items():
        for message, passes in tests:
            broken = ~F.coalesce(passes, F.lit(True))
            checks.append(
                F.when(
                    broken,
                    F.struct(F.lit(field).alias("field"), F.lit(message).alias("message")),
                )
            )
    return df.withColumn("errors", F.array_compact(F.array(*checks)))


def validate(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their errors."""
    checked = with_errors(df, rules)
    return (
        checked.filter(F.size("errors") == 0).drop("errors"),
        checked.filter(F.size("errors") > 0),
    )


def query_checked(articles: DataFrame, rules: Rules, **query) -> tuple[DataFrame, DataFrame]:
    """What `labels.query_articles` finds, as its good rows and its bad rows with their errors.

    Rules are checked on the rows found, before fields are left out; the bad rows keep all their fields.
    """
    fields, key = query.pop("fields", None), query.get("key", "id")
    good, bad = validate(query_articles(articles, **query), rules)
    return (good if fields is None else good.select(*dict.fromkeys([key, *fields]))), bad


def apply_corrections(
    invalid: DataFrame,
    fixes: DataFrame,
    deletes: DataFrame,
    rules: Rules,
    fields: Sequence[str],
    key: str = "id",
    order: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Apply `(id, field, new_value)` decisions and validate again.

    Returns rows that are good now and rows that still are not; rows listed in
    `deletes` are in neither. Of several fixes of one field the last by `order` counts;
    without an order they are an error. Fixes of other fields than `fields` do
    not get lost: `unused_corrections` lists them.
    """
    each = fixes.filter(F.col("field").isin(*fields)).withColumn("__at", F.struct(F.col(key), F.col("field")))
    if order is None:
        last = each.groupBy("__at").agg(F.first("new_value", ignorenulls=False).alias("new_value"), F.count(F.lit(1)).alias("n"))
        complaint = F.concat(F.lit("no order for the fixes of "), F.col("__at")["field"])
        last = last.withColumn("__at", F.when(F.col("n") > 1, F.raise_error(complaint).cast(last.schema["__at"].dataType)).otherwise(F.col("__at")))
    else:
        last = last_written(each, "__at", {"new_value": F.col("new_value")}, order)
    # One value per field is left, so any aggregate takes it.
    wide = last.groupBy(F.col("__at")[key].alias(key)).agg(
        *[
            F.max(F.when(F.col("__at")["field"] == f, F.struct(F.lit(True).alias("set"), "new_value"))).alias(f"__{f}")
            for f in fields
        ]
    )
    left = invalid.drop("errors").join(
        broadcast_if_bounded(deletes.select(key)), key, "left_anti"
    )
    types = dict(invalid.dtypes)
    fixed = left.join(wide, key, "left").withColumns(
        {
            f: F.when(
                F.col(f"__{f}").isNotNull(), F.col(f"__{f}")["new_value"].try_cast(types[f])
            ).otherwise(F.col(f))
            for f in fields
        }
    )
    return validate(fixed.select(*left.columns), rules)


def unused_corrections(
    invalid: DataFrame, fixes: DataFrame, fields: Sequence[str], key: str = "id"
) -> DataFrame:
    """Fixes that `apply_corrections` has no place for, each with a `reason`."""
    other = fixes.filter(~F.coalesce(F.col("field").isin(*fields), F.lit(False))).withColumn(
        "reason", F.lit("not a field to correct")
    )
    known = fixes.filter(F.col("field").isin(*fields))
    ids = broadcast_if_bounded(invalid.select(key).distinct())
    return other.unionByName(known.join(ids, key, "left_anti").withColumn("reason", F.lit("no such row")))


def missing_references(
    profiles: DataFrame, files: DataFrame, strict: bool = False
) -> DataFrame:
    """Script names used by a profile for which `files(name)` has no entry.

    With `strict`, reading the result fails and names the first missing one.
    """
    used = profiles.select(
        F.col("source.profile_name").alias("profile"),
        F.explode("scraping.js_injections").alias("name"),
    )
    missing = used.join(
        broadcast_if_bounded(files.select("name").distinct()), "name", "left_anti"
    ).select("profile", "name")
    if not strict:
        return missing
    complaint = F.raise_error(F.concat(F.col("name"), F.lit(" not found")))
    return missing.withColumn("name", F.coalesce(complaint.cast("string"), "name"))


# ------------------------------------------------------------------------- reports


def unique_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def url_counts(profiles: DataFrame, urls: DataFrame) -> DataFrame:
    """Addresses per profile, zeros included, in profile order.

    Counting comes before the join, so a profile with most of the addresses is
    one row by then.
    """
    counts = urls.groupBy("profile").agg(F.count("url").alias("urls"))
    return (
        profiles.select("profile")
        .distinct()
        .join(counts, "profile", "left")
        .select("profile", F.coalesce("urls", F.lit(0)).alias("urls"))
        .orderBy("profile")
    )


def parse_success(profiles: DataFrame, results: DataFrame) -> DataFrame:
    """Good and failed pages per profile, zeros included, in profile order."""
    good = F.coalesce(F.col("ok"), F.lit(False))
    counts = results.groupBy("profile").agg(
        F.count_if(good).alias("success"), F.count_if(~good).alias("failure")
    )
    return (
        profiles.select("profile")
        .distinct()
        .join(counts, "profile", "left")
        .select(
            "profile",
            F.coalesce("success", F.lit(0)).alias("success"),
            F.coalesce("failure", F.lit(0)).alias("failure"),
        )
        .orderBy("profile")
    )


def any_left(urls: DataFrame) -> bool:
    """Whether a run has anything to do; reads no more than it must."""
    return not urls.isEmpty()


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they pass through a job; `rows` is always counted."""
    report = Observation(name)
    metrics = {"rows": F.count(F.lit(1)), **{k: F.count_if(c) for k, c in counts.items()}}
    return df.observe(report, *[c.alias(k) for k, c in metrics.items()]), report
