"""Incremental ingest: crawled pages appear as files, articles join the corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import latest_per_key, not_stored
from ..operators.pages import split_by_status, with_profile
from ..plans.build import build_articles
from ..sources.store import ArticleStore


def ingest_incremental(
    spark: SparkSession,
    source_dir: str,
    page_schema: T.StructType,
    profiles: DataFrame,
    common_words: Sequence[str] | DataFrame,
    store: ArticleStore,
    checkpoint_dir: str,
    as_of: Column,
    max_files_per_batch: int = 1000,
    rejects_dir: str | None = None,
) -> None:
    """Process every page file not seen before, then stop.

    Each batch drops stored addresses, parses the rest and adds them as a
    folder named after stream and batch. A batch that is tried again writes
    the same folder, so nothing is stored twice. Every page that does not become
    an article is written with its reasons below `rejects_dir`, which is
    the checkpoint's name with `-rejects` unless given. Pages without an address have
    nothing to be known by and are rejected.
    """

    rejects = rejects_dir or f"{checkpoint_dir.rstrip('/')}-rejects"

    def add(pages: DataFrame, batch: int) -> None:
        # The id lives in the checkpoint: a new checkpoint never reuses a folder.
        stream_id = spark.read.json(f"{checkpoint_dir}/metadata").first()["id"]
        folder = f"stream-{stream_id}-{batch}"
        usable, failed = split_by_status(pages)
        nameless = usable.filter("url IS NULL").withColumn("reason", F.lit("no url"))
        fresh = not_stored(usable.filter("url IS NOT NULL"), store.read(without=folder), "url")
        once = latest_per_key(fresh, "url", ["page_id"])
        if "profile" not in once.columns:
            once = with_profile(once, profiles)
        articles, rejected = build_articles(once, profiles, common_words, as_of)
        store.append(articles, folder)
        unread = failed.select("url", "reason").unionByName(nameless.select("url", "reason"))
        unread = unread.select("url", F.lit(None).cast("string").alias("profile"), F.array("reason").alias("errors"))
        rejected.unionByName(unread).write.mode("overwrite").parquet(f"{rejects}/{folder}")

    stream = (
        spark.readStream.schema(page_schema)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .parquet(source_dir)
    )
    query = (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
