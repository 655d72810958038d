"""Shared folder, bounded Arrow batches and column helpers of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space everywhere in this subpackage: blank, tab, LF, VT, FF, CR.
WHITE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"
BLANKS = " \t\n\x0b\f\r"

#: Documents handed to a Python worker at once; each worker cuts them by bytes.
BATCH_ROWS = 500


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share, from `spark.checkpoint.dir`.

    Only a session in local mode may leave it unset; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="checkpoint-")
        root = _local_roots[context.applicationId]
    return root.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def name(column: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{column.replace('`', '``')}`")


def crc_of(key: Column) -> Column:
    """CRC-32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def text_hash(text: str) -> Column:
    """Tells texts of one id apart; a null text counts as empty."""
    return F.xxhash64(F.coalesce(name(text), F.lit("")))


def rows_of(docs: DataFrame, chosen: DataFrame, how: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of `docs` whose id and text are (`left_semi`) or are not (`left_anti`) in
    `chosen`, which has doc_id and text_hash. Columns stay as they are; null ids are equal."""
    ids = chosen.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    return docs.join(ids, name(key).eqNullSafe(F.col("__id")) & (text_hash(text) == F.col("__hash")), how)


def draw_rows(rows: DataFrame, label: str, limit: int, *identity: str) -> DataFrame:
    """At most `limit` rows of each label, by a hash of the columns `identity`.

    Labels are few, as a model has a column for each: their counts come to the
    driver. Rows whose hash is too high to be among the drawn go before anything moves.
    """
    counts = rows.groupBy(label).count().filter(F.col(label).isNotNull()).collect()
    if not counts:
        return rows.limit(0)
    shares = [x for r in counts for x in (F.lit(r[label]), F.lit(min(1.0, 3 * limit / r["count"])))]
    place = F.pmod(F.xxhash64(*identity), F.lit(1 << 30))
    near = rows.filter(place < F.create_map(*shares)[F.col(label)] * (1 << 30))
    order = Window.partitionBy(label).orderBy(place, *identity)
    return near.withColumn("__nth", F.row_number().over(order)).filter(F.col("__nth") <= limit).drop("__nth")
