"""Replies found by what they quote, and conversations without the quotes.

Lines are parsed for their quote marks; lines of one level in a row are a
passage. Every quoted passage and each of its lines is looked up, by a hash of
its normalised text, among the unquoted passages and lines of earlier messages
of the conversation. Of the messages quoted at the lowest level, that with most
characters quoted is the one replied to. Replies lead back to the first message of a thread; threads follow
each other by their first message, and messages of a thread by turn, so every
reply comes after what it replies to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from articlelake.functions.binding import let
from articlelake.llm.common import WHITE, name, text_hash, written

#: Turns of one conversation that are looked through together.
REACH = 1024

_MARKS = r"^[ \t>]*>"


def _passages(text: Column) -> Column:
    """Runs of lines of one quote level: (level, raw, lines), `lines` without marks and normalised."""

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        bare = F.substring(line, F.length(marks) + 1, F.length(line))
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            line.alias("raw"),
            F.lower(F.trim(F.regexp_replace(bare, WHITE, " "))).alias("line"),
        )

    def cut(lines: Column) -> Column:
        fresh = lambda i: (i == 0) | (lines[i]["level"] != lines[F.greatest(i - 1, F.lit(0))]["level"])
        starts = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), fresh)
        return let(starts, lambda begins: F.transform(begins, lambda a, k: run(lines, begins, a, k)))

    def run(lines: Column, begins: Column, a: Column, k: Column) -> Column:
        end = F.coalesce(F.get(begins, k + 1), F.size(lines))
        part = F.slice(lines, a + 1, end - a)
        return F.struct(lines[a]["level"].alias("level"), part["raw"].alias("raw"), part["line"].alias("lines"))

    return let(F.transform(F.split(text, "\n", -1), parsed), cut)


def _keys(lines: Column) -> Column:
    """Hash and length of a passage (line -1) and, if it has several lines, of each of them; empty ones have none."""
    whole = F.trim(F.array_join(F.filter(lines, lambda x: x != ""), " "))
    none = F.array().cast("array<struct<line:int,text:string>>")
    each = F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("text")))
    texts = F.concat(F.array(F.struct(F.lit(-1).alias("line"), whole.alias("text"))), F.when(F.size(lines) > 1, each).otherwise(none))
    filled = F.filter(texts, lambda x: x["text"] != "")
    return F.transform(
        filled, lambda x: F.struct(x["line"].alias("line"), F.unhex(F.md5(x["text"])).alias("key"), F.length(x["text"]).alias("size"))
    )


def _left(passage: Column, found: Column) -> Column:
    """Raw lines of a passage without those found; none if all of it was found. `found` has line numbers, -1 for all."""
    places = F.sequence(F.lit(0), F.size(passage["raw"]) - 1)
    filled = F.filter(places, lambda i: passage["lines"][i] != "")
    whole = F.array_contains(found, -1) | (F.size(F.array_except(filled, found)) == 0)
    some = F.transform(F.array_except(places, found), lambda i: passage["raw"][i])
    return F.when(F.coalesce(F.size(found), F.lit(0)) <= 0, passage["raw"]).when(whole, F.array().cast("array<string>")).otherwise(some)


def _latest(quoted: DataFrame, original: DataFrame) -> DataFrame:
    """For each quoted (conv, key, turn, ...) the latest earlier turn that has the key, as `to`.

    Both are ordered together within stretches of turns, and what stretches
    before had is carried over, so no key of a conversation is one task.
    """
    stretch = F.floor(F.col("turn") / REACH)
    both = quoted.withColumn("had", F.lit(None).cast("long")).withColumn("stretch", stretch)
    had = original.withColumn("had", F.col("turn")).withColumn("stretch", stretch)
    both = both.unionByName(had, allowMissingColumns=True)
    tops = both.groupBy("conv", "key", "stretch").agg(F.max("had").alias("top"))
    before = Window.partitionBy("conv", "key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("conv", "key", "stretch", F.max("top").over(before).alias("carried"))
    here = Window.partitionBy("conv", "key", "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("near", F.max("had").over(here)).filter("had IS NULL")
    same = [F.col("q.key") == F.col("t.key"), F.col("q.stretch") == F.col("t.stretch"), F.col("q.conv").eqNullSafe(F.col("t.conv"))]
    found = both.alias("q").join(tops.alias("t"), same[0] & same[1] & same[2])
    return found.select("q.*", F.coalesce("near", "carried").alias("to")).drop("had", "near", "stretch").filter("to IS NOT NULL")


def _threads(replies: DataFrame) -> DataFrame:
    """(conv, turn, to) -> (conv, turn, thread, depth), by doubling the distance looked back."""
    jumps = written(replies.select("conv", "turn", "to", F.lit(1).cast("long").alias("depth")), "jumps")
    while True:
        onward = jumps.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("to").alias("far"), F.col("depth").alias("more"))
        joined = jumps.join(onward, F.col("conv").eqNullSafe(F.col("c")) & (F.col("to") == F.col("t")), "left")
        moved = joined.select(
            "conv", "turn", F.coalesce("far", "to").alias("to"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("far").isNotNull().alias("moved"),
        )
        moved = written(moved, "jumps")
        jumps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return jumps.withColumnRenamed("to", "thread")


def reply_order(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per message: conv_id, turn, role, body, reply_to, thread, depth, position, n_quotes, n_linked.

    `body` is the text without what was found of its quotes in earlier messages: a whole
    passage, if it or all its lines that are not empty were found, or else only the lines found. A quoted line
    found nowhere stays, as do lines that introduce a quote. `n_linked` counts passages
    of which anything was found. Very long texts are parsed in their row. `reply_to` is the turn of the message
    replied to, null for one that quotes none; `thread` and `depth` say where
    following replies back ends and after how many steps; `position` counts a
    conversation's messages from 0 by thread and turn. A null text has a null
    body and no quotes. Null conversations are one; a message without a turn
    quotes nothing, is not quoted, and comes last. Messages of equal turn share
    thread and depth. Where as much of two messages is quoted the later counts. An empty table gives an empty result; other columns are not
    looked at.
    """
    rows = messages.select(
        name(conv).alias("conv"), name(turn).cast("long").alias("turn"), name(role).alias("role"),
        name(text).alias("text"), text_hash(text).alias("hash"),
    )
    parts = rows.select("conv", "turn", "hash", F.posexplode(_passages(F.col("text"))).alias("nth", "x"))
    parts = parts.filter("turn IS NOT NULL").select("conv", "turn", "hash", "nth", "x.level", _keys(F.col("x.lines")).alias("keys"))
    keyed = written(parts.select("conv", "turn", "hash", "nth", "level", F.explode("keys").alias("k")).select("*", "k.*").drop("k"), "keys")
    quoted = keyed.filter("level > 0").select("conv", "turn", "hash", "nth", "line", "level", "key", "size").distinct()
    original = keyed.filter("level = 0").select("conv", "turn", "key").distinct()
    found = written(_latest(quoted, original), "found")

    once = found.drop("line").distinct()  # a line that repeats in a passage counts once
    weight = once.groupBy("conv", "turn", "to").agg(F.min("level").alias("level"), F.sum("size").alias("size"))
    replies = weight.groupBy("conv", "turn").agg(F.max(F.struct(-F.col("level"), "size", "to")).alias("best"))
    replies = written(replies.select("conv", "turn", F.col("best.to").alias("to")), "replies")
    threads = _threads(replies).select(F.col("conv").alias("c1"), F.col("turn").alias("t1"), "thread", "depth")
    replies = replies.select(F.col("conv").alias("c2"), F.col("turn").alias("t2"), F.col("to").alias("reply_to"))
    lines = found.groupBy("conv", "turn", "hash", "nth").agg(F.collect_set("line").alias("lines"))
    linked = lines.groupBy(F.col("conv").alias("c3"), F.col("turn").alias("t3"), F.col("hash").alias("h3")).agg(
        F.map_from_entries(F.collect_list(F.struct("nth", "lines"))).alias("linked")
    )

    def at(c: str, t: str) -> Column:
        return F.col("conv").eqNullSafe(F.col(c)) & (F.col("turn") == F.col(t))

    joined = (
        rows.join(linked, at("c3", "t3") & (F.col("hash") == F.col("h3")), "left")
        .join(replies, at("c2", "t2"), "left")
        .join(threads, at("c1", "t1"), "left")
    )
    passages = _passages(F.col("text"))

    def body(all_: Column) -> Column:
        left = F.transform(all_, lambda x, i: _left(x, F.try_element_at(F.col("linked"), i)))
        return F.array_join(F.flatten(left), "\n")

    quotes = F.size(F.filter(passages, lambda x: x["level"] > 0))
    done = joined.select(
        F.col("conv").alias("conv_id"), "turn", "role",
        F.when(F.col("linked").isNull(), F.col("text")).otherwise(let(passages, body)).alias("body"), "reply_to",
        F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.when(F.col("text").isNull(), 0).otherwise(quotes).cast("long").alias("n_quotes"),
        F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"),
    )
    return _positions(done)


def _positions(rows: DataFrame) -> DataFrame:
    """Number the messages of each conversation, by ranges of all messages in order."""
    order = [F.col("conv_id"), F.col("thread").asc_nulls_last(), F.col("turn"), F.col("body")]
    lined = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    lined = written(lined.withColumn("id", F.monotonically_increasing_id()), "ordered")
    part, low = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    sizes = lined.groupBy(part.alias("part")).agg((F.max(low) + 1).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    bases = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    placed = lined.withColumn("part", part).join(bases, "part").withColumn("place", F.col("base") + low)
    firsts = placed.groupBy(F.col("conv_id").alias("c")).agg(F.min("place").alias("first"))
    joined = placed.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")))
    return joined.select(
        "conv_id", "turn", "role", "body", "reply_to", "thread", "depth", (F.col("place") - F.col("first")).alias("position"),
        "n_quotes", "n_linked",
    )
