"""URL and key rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_valid_url(url: Column) -> Column:
    """Absolute http(s) address with a dot somewhere after the scheme."""
    return url.rlike(r"(?d)^https?://.*\.")


def resolve_url(root: Column, target: Column) -> Column:
    """Absolute targets stay; relative ones follow the site address.

    An address ending in a slash gives that slash up; any other address stays
    whole and gets a slash in between when the target brings none.
    """
    joined = F.when(
        root.endswith("/"), F.concat(_drop_last(root), target)
    ).otherwise(
        F.concat(root, F.when(target.startswith("/"), F.lit("")).otherwise(F.lit("/")), target)
    )
    return F.when(is_valid_url(target), target).otherwise(joined)


def _drop_last(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - 1)


def article_id(url: Column) -> Column:
    """Key of an article: md5 of its address, in lower-case hex."""
    return F.md5(url)


def profile_slug(source: Column) -> Column:
    return F.replace(F.lower(source), F.lit(" "), F.lit(""))


def site_icon(address: Column) -> Column:
    """Default image of a site, with exactly one slash before the file name."""
    return F.concat(F.regexp_replace(address, "/+$", ""), F.lit("/favicon.ico"))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def page_urls(template: Column, start: int, size: int) -> Column:
    """The addresses `start .. start+size-1` of a paged listing, one per `%` template."""
    numbers = F.sequence(F.lit(start), F.lit(start + size - 1))
    filled = F.transform(
        numbers, lambda n: F.replace(template, F.lit("%"), n.cast("string"))
    )
    missing = F.raise_error(F.concat(F.lit("no % for the page number in "), template))
    return F.when(F.contains(template, F.lit("%")), filled).otherwise(missing)
