"""Mixing sources to target weights by a low-discrepancy schedule.

The documents of a source, in an order drawn by a keyed hash, form one stream of
words that is cut into blocks of equal size. Slot i of the schedule gets the
point frac(i * golden ratio), which the cumulative target shares map to a
source; the r-th slot of a source takes the r-th block of its stream, and starts
over when the stream ends. So at every length the mix so far is within a few
blocks of the target shares.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm.common import WORD, name, text_hash, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 2048
SEED = "mix"

_TURN = 1 << 32
#: The odd number nearest to 2^32 / golden ratio.
_STEP = 2654435769
_CELL = 1 << 16


@dataclass
class Mix:
    """`docs`: every row with its place in its source's stream; `sources`: sizes
    and targets; `schedule`: which words of which stream each slot takes;
    `pieces`: which words of which document each slot takes."""

    docs: DataFrame
    sources: DataFrame
    schedule: DataFrame
    pieces: DataFrame

    def documents(self) -> DataFrame:
        """One row per document with the words that the mix takes from it."""
        taken = self.pieces.groupBy("sid", "bucket", "row").agg(F.sum("words").alias("taken"))
        return (
            self.docs.join(taken, ["sid", "bucket", "row"], "left")
            .join(self.sources.select("sid", "source_size", "target"), "sid")
            .select(
                "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
            )
        )


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Add `sid` and `target` to one row per source: (source, source_size).

    Sources by code point, null last, get the weights in turn. Together they
    share `share` of all sizes by weight; none gets more than `repeats` times its
    size, and what that leaves over is shared by weight among the others. With
    the sources ordered by size over weight, those up to some place are at their
    limit and one level serves all others, so one pass over the sources, which
    are one row each, finds it.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("sid", F.row_number().over(everything)).withColumn("weight", w)
    ranked = ranked.withColumn("most", F.col("source_size") * repeats)
    ranked = ranked.withColumn("ratio", F.col("most") / F.col("weight"))
    order = Window.orderBy("ratio", "sid")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        ranked.withColumn("place", F.row_number().over(order))
        .withColumn("left", F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(onward))
    )
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("place"))
    ranked = ranked.withColumn("level", F.min_by("level", fits).over(whole))
    return ranked.select(
        "source",
        "sid",
        "source_size",
        F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def _schedule(sources: DataFrame, block: int) -> DataFrame:
    """One row per slot: (slot, sid, rank, block, from, to), `from` and `to` in its stream."""
    spark = sources.sparkSession
    per_source = sources.filter("source_size > 0").select(
        "sid",
        "source_size",
        F.floor(F.col("target") + 0.5).alias("goal"),
        F.ceil(F.col("source_size") / block).alias("blocks"),
    )
    rounds = F.floor(F.col("goal") / F.col("source_size"))
    rest = F.col("goal") - rounds * F.col("source_size")
    per_source = per_source.withColumn("slots", (rounds * F.col("blocks") + F.ceil(rest / block)).cast("long"))
    order = Window.orderBy("sid")
    share = F.sum("slots").over(order.rowsBetween(Window.unboundedPreceding, 0))
    per_source = per_source.withColumn("high", share).withColumn("low", F.col("high") - F.col("slots"))
    per_source = written(per_source, "sources")
    count = per_source.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    if count >= _TURN // 2:
        raise ValueError(f"{count} slots: give a larger block size")

    # The shares as ranges of a circle of 2^32 points, cut into cells to be joined by equality.
    edge = lambda c: F.floor(F.col(c).cast("double") / max(count, 1) * _TURN)
    ranges = per_source.select("sid", edge("low").alias("low"), edge("high").alias("high")).filter("high > low")
    cells = ranges.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / _CELL), F.floor((F.col("high") - 1) / _CELL)))
    )
    points = spark.range(count).select(F.col("id").alias("slot"), ((F.col("id") * _STEP) % _TURN).alias("point"))
    drawn = points.withColumn("cell", F.floor(F.col("point") / _CELL)).join(cells, "cell")
    drawn = drawn.filter("point >= low AND point < high").select("slot", "sid")

    # Rank the slots of each source by stretches, so that no source is one task.
    stretch = max(1, math.isqrt(count))
    drawn = drawn.withColumn("stretch", F.floor(F.col("slot") / stretch))
    counts = drawn.groupBy("sid", "stretch").agg(F.count(F.lit(1)).alias("here"))
    up_to = Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("here").over(up_to), F.lit(0)))
    within = Window.partitionBy("sid", "stretch").orderBy("slot")
    ranked = (
        drawn.withColumn("nth", F.row_number().over(within) - 1)
        .join(counts.select("sid", "stretch", "before"), ["sid", "stretch"])
        .select("slot", "sid", (F.col("before") + F.col("nth")).alias("rank"))
    )
    # The points give each source its number of slots but for a few: those beyond fall away, missing ones follow.
    had = counts.groupBy("sid").agg(F.sum("here").alias("had"))
    missing = (
        per_source.join(had, "sid", "left")
        .withColumn("had", F.coalesce("had", F.lit(0)))
        .filter("slots > had")
        .select("sid", F.explode(F.expr("sequence(had, slots - 1)")).alias("rank"))
        .select((F.lit(count) + F.col("rank")).alias("slot"), "sid", "rank")
    )
    slots = ranked.unionByName(missing).join(per_source, "sid").filter("rank < slots")
    turn = F.floor(F.col("rank") / F.col("blocks"))
    place = F.col("rank") - turn * F.col("blocks")
    end = F.least((place + 1) * block, F.col("source_size"), F.col("goal") - turn * F.col("source_size"))
    return slots.select("slot", "sid", "rank", place.alias("block"), (place * block).alias("from"), end.alias("to"))


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS,
    seed: str = SEED,
) -> Mix:
    """Mix all rows of `docs`.

    Words are runs between white space; a null text has none. A null source is a
    source of its own. Documents of equal id are told apart by size, and rows
    alike in both are interchangeable. Documents without words are in the result
    and give none. Null ids count as the text 'null' where the order is drawn.
    Reruns give the same mix; an empty table gives an empty one.
    """
    sized = docs.select(
        name(key).alias("doc_id"),
        name(source).alias("source"),
        F.coalesce(F.regexp_count(name(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        text_hash(text).alias("text_hash"),
    )
    drawn = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}")))
    sized = written(sized.withColumn("draw", drawn), "sizes")

    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    totals = written(totals, "totals")
    sources = written(targets(totals.drop("rows"), weights, share, repeats), "targets")

    # Two levels of running sums: over buckets of a source, and within a bucket.
    rows = totals.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    digits = max(1, math.ceil(math.log(max(rows, 1), 16) / 2))
    sized = sized.join(sources.select("source", "sid"), sized["source"].eqNullSafe(sources["source"]))
    sized = sized.select("doc_id", "text_hash", "sid", "size", "draw", F.substring("draw", 1, digits).alias("bucket"))
    sums = sized.groupBy("sid", "bucket").agg(F.sum("size").alias("sum"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("sid", "bucket").orderBy("draw", "size", "text_hash")
    above = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.withColumn("row", F.row_number().over(within))
        .withColumn("inner", F.coalesce(F.sum("size").over(above), F.lit(0)))
        .join(sums, ["sid", "bucket"])
        .select("doc_id", "text_hash", "sid", "bucket", "row", "size", (F.col("before") + F.col("inner")).alias("at"))
    )
    placed = written(placed, "places")

    words = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    block = max(block_words, math.ceil(words / (_TURN // 4)))
    schedule = _schedule(sources, block)
    parts = placed.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)))
    )
    start, stop = F.greatest("at", "from"), F.least(F.col("at") + F.col("size"), F.col("to"))
    pieces = (
        parts.join(schedule, ["sid", "block"])
        .filter(stop > start)
        .select("slot", "sid", "bucket", "row", "doc_id", (start - F.col("at")).alias("offset"), (stop - start).alias("words"))
    )
    return Mix(placed, sources, schedule, pieces)


def mixed_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """Rows of `docs` as often as the mix takes them, columns as they are.

    A document is taken whole each time a slot of the schedule takes its first
    word, so a source is at most one document over its target. Rows alike in id,
    text and source share their times, rounded up.
    """
    plan = mix(docs, key, text, source, **how)
    begun = plan.pieces.filter("offset = 0").groupBy("sid", "bucket", "row").agg(F.count(F.lit(1)).alias("times"))
    placed = plan.docs.filter("size > 0").join(begun, ["sid", "bucket", "row"], "left")
    placed = placed.join(plan.sources.select("sid", "source"), "sid")
    times = F.ceil(F.avg(F.coalesce("times", F.lit(0)))).cast("int")
    taken = placed.groupBy("doc_id", "text_hash", "source").agg(times.alias("__times"))
    taken = written(taken.filter("__times > 0"), "taken").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("source").alias("__source"), "__times"
    )
    same = (
        name(key).eqNullSafe(F.col("__id"))
        & (text_hash(text) == F.col("__hash"))
        & name(source).eqNullSafe(F.col("__source"))
    )
    rows = docs.join(taken, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return rows.select(*[name(c) for c in docs.columns])


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':mix') AS draw
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM totals
), weighed AS (
  SELECT source, source_size, CASE turn WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM ranked
), levels AS (
  SELECT *, row_number() OVER o AS place, 2 * source_size / CAST(weight AS DOUBLE) AS ratio,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
          - coalesce(CAST(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
         / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed WINDOW o AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE), sid)
), goals AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size, weight * (SELECT arg_min(level, place) FROM levels WHERE level <= ratio)) AS target
  FROM levels
), placed AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS goal,
         coalesce(CAST(sum(size) OVER (PARTITION BY s.source ORDER BY draw, size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS begin_at
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CASE WHEN source_size = 0 THEN 0
            ELSE CAST((goal // source_size) * size + greatest(0, least(size, goal % source_size - begin_at)) AS BIGINT) END AS taken
FROM placed
"""
