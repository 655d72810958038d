"""Date rules as Column expressions. Nothing here reads the clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"\d:\d\d.*(?:[Zz]|[+-]\d\d(?::?\d\d)?)\s*$"
_DATE_ONLY = r"^\s*\d{4}-\d\d-\d\d\s*$"

#: Tried in order after plain ISO text; a leading weekday is skipped.
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss XXX",
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
    "yyyy/MM/dd",
)


def has_offset(text: Column) -> Column:
    """Whether a date string names its own zone."""
    return text.rlike(_OFFSET)


def assume_utc(text: Column) -> Column:
    """ISO text to an instant: its own offset if it has one, else UTC."""
    text = F.trim(text)
    return F.try_to_timestamp(
        F.when(has_offset(text), text)
        .when(text.rlike(_DATE_ONLY), F.concat(text, F.lit("T00:00:00Z")))
        .otherwise(F.concat(text, F.lit("Z")))
    )


def was_naive(text: Column) -> Column:
    """True for a readable date that had no zone and therefore changes."""
    return F.coalesce(assume_utc(text).isNotNull() & ~has_offset(text), F.lit(False))


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First reading that works: ISO, then each format, in UTC when it has no zone."""
    text = F.regexp_replace(F.trim(text), r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", "")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(assume_utc(text), *tries)


def publish_date(
    selected: Column,
    linked: Column,
    as_of: Column,
    formats: Sequence[str] = DATE_FORMATS,
    fall_through: bool = False,
) -> Column:
    """Date of an article as `struct<value, origin>`.

    Selected text wins; structured data is read only when the selector gave
    nothing (or, with `fall_through`, when its text is unreadable); otherwise
    the date is `as_of` and `origin` says so.
    """
    from_selector = parse_date(F.nullif(selected, F.lit("")), formats)
    from_linked = parse_date(linked, formats)
    may_fall = F.lit(fall_through) | (F.coalesce(selected, F.lit("")) == "")
    return (
        F.when(from_selector.isNotNull(), _dated(from_selector, "selector"))
        .when(may_fall & from_linked.isNotNull(), _dated(from_linked, "json_ld"))
        .otherwise(_dated(as_of, "as_of"))
    )


def _dated(value: Column, origin: str) -> Column:
    return F.struct(value.alias("value"), F.lit(origin).alias("origin"))


def uniform_draw(key: Column, span: Column, seed: int) -> Column:
    """Repeatable whole number in `[0, span)` drawn from a row's key."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), span)


def spread_dates(key: Column, start: Column, end: Column, seed: int = 0) -> Column:
    """A whole second in `[start, end)` per key, the same on every run."""
    span = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.timestamp_seconds(F.unix_timestamp(start) + uniform_draw(key, span, seed))
