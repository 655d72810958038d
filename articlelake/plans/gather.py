"""Article addresses from feeds and front pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.pages import extract_links
from ..session import broadcast_if_bounded
from ..sources.readers import feed_urls

METHODS = ("rss", "scraping", "dynamic")


def gather_urls(
    profiles: DataFrame,
    feeds: DataFrame,
    front_pages: DataFrame,
    max_per_source: int = 10,
) -> tuple[DataFrame, DataFrame]:
    """`(profile, url)` of all profiles, and failed profiles with a reason.

    `feeds` is `(profile, feed_url, xml)` and `front_pages` is `(profile, url,
    html)`; each profile uses the one its retrieval method names. A profile without
    a feed or page fails, as does one with a failing source; a failed profile has no
    addresses while the others go on. Feed entries keep repeats; front-page links do not.
    """
    methods = profiles.select(
        F.col("source.profile_name").alias("profile"),
        F.col("source.retrieval_method").alias("method"),
    )
    unknown = methods.filter(
        ~F.coalesce(F.col("method").isin(*METHODS), F.lit(False))
    ).select("profile", F.lit("unknown retrieval method").alias("reason"))

    by_feed = broadcast_if_bounded(methods.filter("method = 'rss'").select("profile"))
    entries = feed_urls(feeds.join(by_feed, "profile"), max_per_source)
    bad_feeds = entries.filter("url is null").select("profile", "reason").distinct()
    from_feeds = entries.select("profile", "url").join(
        bad_feeds.select("profile"), "profile", "left_anti"
    )

    crawled = profiles.filter(F.col("source.retrieval_method").isin("scraping", "dynamic"))
    empty = (
        methods.filter("method = 'rss'")
        .join(feeds.select("profile").distinct(), "profile", "left_anti")
        .select("profile", F.lit("no feed").alias("reason"))
        .unionByName(
            methods.filter("method IN ('scraping', 'dynamic')")
            .join(front_pages.select("profile").distinct(), "profile", "left_anti")
            .select("profile", F.lit("no front page").alias("reason"))
        )
    )
    front_pages = front_pages.join(
        broadcast_if_bounded(crawled.select(F.col("source.profile_name").alias("profile"))), "profile", "left_semi"
    )
    links, bad_pages = extract_links(front_pages, crawled, max_per_source)
    return (
        from_feeds.unionByName(links),
        unknown.unionByName(bad_feeds).unionByName(bad_pages).unionByName(empty),
    )
