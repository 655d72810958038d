"""Lines that repeat across documents, against levelled sorted runs of line hashes.

Documents come in batches of ascending id. A run is a table of line digests in
order, each with the id of the document that had it first. Every batch looks up
its digests in all runs; what it finds there belongs to an earlier document, and
the rest, each with the smallest id of the batch, is the batch's own run. When a
level holds `fan` runs they are merged into one run of the next level, so a
digest is rewritten once per level and a lookup reads few runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.functions.binding import let
from articlelake.llm.common import BLANKS, name, written

SHORTEST = 10
BATCHES = 4
FAN = 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _low(text: Column) -> Column:
    """A-Z in lower case; texts of one byte per character have the fast way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


class LineRuns:
    """Runs by level; each is a table (line, owner) in files sorted by `line`."""

    def __init__(self, fan: int = FAN) -> None:
        self.fan = fan
        self.levels: list[list[DataFrame]] = []

    def _add(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(written(run.sortWithinPartitions("line"), f"run-{level}"))
        if len(self.levels[level]) == self.fan:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self._add(level + 1, merged.repartition("line"))

    def admit(self, batch: DataFrame) -> DataFrame:
        """Take the lines of a batch, (line, first, last) with the smallest and the
        greatest id that has it. Returns (line, owner) of those that repeat: had by
        an earlier batch, whose id is the owner, or by several ids of this one."""
        runs = [run for level in self.levels for run in level]
        if runs:
            known = reduce(DataFrame.unionByName, runs).withColumnRenamed("owner", "earlier")
            batch = batch.join(known, "line", "left")
            batch = written(batch, "batch")
        else:
            batch = written(batch.withColumn("earlier", F.lit(None).cast(dict(batch.dtypes)["first"])), "batch")
        self._add(0, batch.filter("earlier IS NULL").select("line", F.col("first").alias("owner")))
        several = ~F.col("first").eqNullSafe(F.col("last"))
        owner = F.coalesce("earlier", "first").alias("owner")
        return batch.filter(F.col("earlier").isNotNull() | several).select("line", owner)


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    batches: int = BATCHES,
    fan: int = FAN,
) -> DataFrame:
    """One row per document: doc_id, text, n_lines, n_dropped.

    Texts are split at line feeds; a null or empty text is one empty line. A
    line's key is the line without white space at both ends, A-Z in lower case.
    Keys of `shortest` characters or more that are in two documents or more lose
    all their lines but those of the smallest id that has them. Ids are numbers;
    rows of equal id count as one document, and a null id is smaller than none:
    lines it shares with others are dropped from it. The other lines stay in
    order. An empty table gives an empty result; other columns are not looked at.
    """
    base = docs.select(name(key).alias("doc_id"), F.coalesce(name(text), F.lit("")).alias("text"))
    base = base.withColumn("print", F.xxhash64("text"))
    keys = F.transform(F.split(_low(F.col("text")), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    lines = base.select("doc_id", "print", F.posexplode(keys).alias("at", "key"))
    lines = lines.filter(F.char_length("key") >= shortest)
    lines = written(lines.select("doc_id", "print", "at", F.unhex(F.md5("key")).alias("line")), "lines")

    # Batches end at quantiles of the ids; any ends give the same result. Null ids are in the last.
    parts = [k / batches for k in range(1, batches)]
    ends = lines.agg(F.percentile_approx("doc_id", parts, 1000)).first()[0] if parts else None
    number = reduce(lambda n, end: n + (F.col("doc_id") > end).cast("int"), ends or [], F.lit(0))
    lines = lines.withColumn("batch", F.coalesce(number, F.lit(len(ends or []))))
    runs, repeats = LineRuns(fan), []
    greatest = F.when(F.count("doc_id") == F.count(F.lit(1)), F.max("doc_id")).alias("last")
    for k in range(len(ends or []) + 1):
        own = lines.filter(F.col("batch") == k).groupBy("line").agg(F.min("doc_id").alias("first"), greatest)
        repeats.append(runs.admit(own).withColumn("batch", F.lit(k)))
    lost = lines.join(reduce(DataFrame.unionByName, repeats), ["batch", "line"])
    lost = lost.filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
    lost = lost.groupBy(F.col("doc_id").alias("d"), F.col("print").alias("p")).agg(F.collect_set("at").alias("lost"))

    rows = base.join(lost, base["doc_id"].eqNullSafe(lost["d"]) & (base["print"] == lost["p"]), "left")

    def kept(parts: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("lost"))
        return F.array_join(F.transform(left, lambda at: parts[at]), "\n")

    return rows.select(
        "doc_id",
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(let(F.split("text", "\n", -1), kept)).alias("text"),
        (F.char_length("text") - F.char_length(F.replace(F.col("text"), F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), marked AS (
  SELECT *, length(key) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS lost FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
