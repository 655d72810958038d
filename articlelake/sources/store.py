"""A corpus kept as Parquet folders.

A version is a list of folders. New articles are added as one more folder;
changes to existing ones write a whole new folder. A folder that is being read
is never written to, and a version exists only once its log entry does, so a
failed job leaves the previous version in place.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import align_schema
from ..schemas import ARTICLE_SCHEMA

_LOG = "version bigint, folders array<string>"


def _call(folder: str) -> str:
    """The name under which a folder was added."""
    return folder.rpartition("~")[0] or folder


class ArticleStore:
    """Versioned corpus below one path, for a single writer."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType = ARTICLE_SCHEMA
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def _latest(self) -> tuple[int, list[str]]:
        try:
            log = self.spark.read.schema(_LOG).json(f"{self.path}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, []
        row = log.agg(F.max_by(F.struct("*"), "version").alias("v")).first()
        return (row["v"]["version"], list(row["v"]["folders"])) if row["v"] else (0, [])

    @property
    def version(self) -> int:
        return self._latest()[0]

    def read(self, without: str | None = None) -> DataFrame:
        """All articles of the current version, optionally without one folder."""
        folders = [f for f in self._latest()[1] if _call(f) != without]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _publish(self, version: int, folders: list[str]) -> None:
        entry = self.spark.createDataFrame([(version, folders)], _LOG)
        entry.coalesce(1).write.mode("append").json(f"{self.path}/versions")

    def append(self, articles: DataFrame, folder: str | None = None) -> int:
        """Add articles known to be new.

        A name makes the call repeatable: a second one of the same name takes the
        place of the first. Published folders are never written to; the new rows
        get a folder of their own, and the next version names it instead.
        """
        version, folders = self._latest()
        name = folder or "added"
        fresh = f"{name}~{uuid.uuid4().hex}"
        rows = align_schema(articles, self.schema).select(*self.schema.fieldNames())
        rows.write.mode("errorifexists").parquet(f"{self.path}/{fresh}")
        left = folders if folder is None else [f for f in folders if _call(f) != folder]
        self._publish(version + 1, [*left, fresh])
        return version + 1

    def replace(self, articles: DataFrame) -> int:
        """Make `articles`, usually derived from `read()`, the whole corpus."""
        version, _ = self._latest()
        folder = f"whole-{version + 1}-{uuid.uuid4().hex}"
        rows = align_schema(articles, self.schema).select(*self.schema.fieldNames())
        rows.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        self._publish(version + 1, [folder])
        return version + 1
