"""Exact duplicates by a tree of merged digest runs.

Every partition of the corpus is a run of (digest, smallest id, copies). In each
round a run sends every entry to the run whose number agrees with one more digit
of the entry's digest, and what arrives is merged. After the last round each run
holds one slice of all digests and every digest once. An entry never meets more
than `radix` runs' entries of its digest in a round, so a text that is a third
of the corpus costs one entry per run and round.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm.common import WHITE, name, written

RUNS = 64
RADIX = 8


def exact_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", runs: int = RUNS, radix: int = RADIX
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after every run of white space has
    become one blank; a null text counts as empty. The smallest id of a group
    stays. Null ids are greater than all others: keep_id is null only where all
    ids of the group are. Rows that repeat both id and text all count as copies
    and share `kept`. An empty table gives an empty result; other columns are
    not looked at. Entries agree only if SHA-256, length in bytes and a second
    hash do.
    """
    flat = F.regexp_replace(F.coalesce(name(text), F.lit("")), WHITE, " ")
    digests = docs.select(
        name(key).alias("doc_id"),
        F.unhex(F.sha2(flat, 256)).alias("digest"),
        F.struct(F.octet_length(flat).alias("bytes"), F.xxhash64(flat).alias("second")).alias("proof"),
        # Two bytes of the digest decide which run it ends up in.
        F.conv(F.substring(F.sha2(flat, 256), 1, 4), 16, 10).cast("int").alias("slice"),
    )
    digests = written(digests, "digests")
    best = digests.select(
        "digest", "proof", "slice", "doc_id", F.lit(1).cast("long").alias("copies"),
        F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"),
    )
    for level in range(max(1, math.ceil(math.log(runs, radix)))):
        step = radix**level
        own = F.floor(F.col("slice") / step) % radix
        there = F.floor(F.col("run") / step) % radix
        best = (
            best.withColumn("run", (F.col("run") + (own - there) * step).cast("int"))
            .groupBy("run", "digest", "proof", "slice")
            .agg(F.min("doc_id").alias("doc_id"), F.sum("copies").alias("copies"))
        )
    groups = best.select(
        "digest", "proof", F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size")
    )
    return digests.join(groups, ["digest", "proof"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


SQL = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
      FROM documents)
WINDOW g AS (PARTITION BY text_sha256)
"""
