"""A corpus laid out by buckets of its ids: a change rewrites only the buckets it touches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from ..schemas import ARTICLE_SCHEMA

_BUCKET = "__bucket"


class BucketStore:
    """Articles below one path, in Parquet folders by a hash of the id, for a single writer.

    Which buckets a change touches is known from its ids alone, so only those folders
    are read, joined and written; the others keep their files. Spark stages the new
    folders and puts each in place when the job commits. A job that fails before
    leaves all as it was; one that fails while folders are put in place is run again,
    which gives the same result, as changes replace rows by id.

    `buckets` and `files` (per bucket) are fixed for a store: a bucket should be a few
    times what one task holds. Touched bucket numbers, at most `buckets`, reach the driver.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType = ARTICLE_SCHEMA,
        key: str = "id",
        buckets: int = 256,
        files: int = 1,
    ) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema, self.buckets, self.files = schema, buckets, files

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _all(self) -> DataFrame:
        # Markers of buckets that hold nothing have a null key.
        layout = T.StructType([*[T.StructField(f.name, f.dataType) for f in self.schema], T.StructField(_BUCKET, T.IntegerType())])
        return self.spark.read.schema(layout).parquet(self.path).filter(F.col(self.key).isNotNull())

    def read(self) -> DataFrame:
        return self._all().drop(_BUCKET)

    def _write(self, rows: DataFrame, touched: Sequence[int], mode: str) -> None:
        placed = merge.align_schema(rows, self.schema).select(*self.schema.fieldNames())
        placed = placed.withColumn(_BUCKET, self._bucket(F.col(self.key)))
        # A bucket whose last row goes must be written too, or its old files would stay.
        marks = self.spark.range(1).select(F.explode(F.array(*[F.lit(b) for b in touched])).alias(_BUCKET)) if touched else None
        if marks is not None:
            placed = placed.unionByName(marks, allowMissingColumns=True)
        salt = F.pmod(F.xxhash64(F.lit(1), F.col(self.key)), F.lit(self.files))
        (
            placed.repartition(max(1, len(touched) or self.buckets) * self.files, F.col(_BUCKET), salt)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_BUCKET)
            .parquet(self.path)
        )

    def create(self, articles: DataFrame) -> None:
        """Lay out a new store; each key is expected once."""
        self._write(articles.filter(F.col(self.key).isNotNull()), [], "errorifexists")

    def _change(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> list[int]:
        """Rewrite the buckets of `keys` to what `change` makes of their rows; returns the buckets."""
        found = keys.filter(F.col(self.key).isNotNull()).select(self._bucket(F.col(self.key)).alias("b")).distinct()
        touched = sorted(r["b"] for r in found.collect())
        if touched:
            held = self._all().filter(F.col(_BUCKET).isin(*touched)).drop(_BUCKET)
            self._write(change(held), touched, "overwrite")
        return touched

    def upsert(self, batch: DataFrame, order: Sequence[str] = ("inserted_at",)) -> list[int]:
        """Save the batch: its rows replace those of the same key. Rows without a key are not saved."""
        usable = batch.filter(F.col(self.key).isNotNull())
        return self._change(usable, lambda held: merge.upsert(held, usable, self.key, order))

    def update_fields(self, batch: DataFrame, fields: Sequence[str], order: Sequence[str] | None = None) -> list[int]:
        """Overwrite `fields` of articles the store has, as `merge.update_fields` does."""
        return self._change(batch, lambda held: merge.update_fields(held, batch, fields, self.key, order))

    def delete(self, ids: DataFrame) -> list[int]:
        return self._change(ids, lambda held: merge.delete_by_id(held, ids, self.key))
