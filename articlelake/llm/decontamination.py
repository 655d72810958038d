"""Benchmark passages in a corpus, by a positional inverted index.

Windows of ten words of the benchmark are looked up as phrases. A window is
represented by its rarest words, by the number of documents that hold them; only
these words' postings, (term, document, positions), are stored. A position less
the word's offset in the window is where the window would begin, so intersecting
the lists so adjusted leaves few places, and those are compared word by word.
A window with a word that no document holds is never looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm.common import name, rows_of, small_batches, written
from articlelake.llm.words import ALPHANUMERIC, LOWER, buffer_of, hashes, mix, slices, spans

WINDOW = 10
#: Words whose lists are intersected before a place is compared as a whole.
RAREST = 3
#: Bits of the filter in front of the postings. Its size is fixed, and a word let
#: through by chance meets no window.
FILTER_BITS = 1 << 23

_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffer_of(texts)
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, ALPHANUMERIC)
    return hashes(data, starts, ends), bounds


def _fold(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One hash for each run of words."""
    value = lengths.astype(np.uint64)
    for k in range(int(lengths.max()) if len(lengths) else 0):
        here = k < lengths
        word = words[np.minimum(starts + k, len(words) - 1)]
        value = np.where(here, value * _FOLD + word, value)
    return mix(value).view(np.int64)


def windows(items: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """All windows of the items: (item_id, item, at, window, terms). `item` numbers the
    rows, `at` is a window's first word. Fewer words than `size`, but not none, are
    one window; a null text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in slices(batch, "text"):
                words, bounds = _words(some.column("text"))
                have = np.diff(bounds)
                count = np.maximum(have - size + 1, (have > 0).astype(np.int64))
                owner = np.repeat(np.arange(len(have)), count)
                starts = bounds[:-1][owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
                lengths = np.minimum(have, size)[owner]
                at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
                terms = pa.array(words[at].view(np.int64)) if len(at) else pa.array([], pa.int64())
                limits = pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32))
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": some.column("item_id").take(pa.array(owner)),
                        "item": pa.array(owner + number),
                        "at": pa.array((starts - bounds[:-1][owner]).astype(np.int32)),
                        "window": pa.array(_fold(words, starts, lengths)),
                        "terms": pa.ListArray.from_arrays(limits, terms),
                    }
                )
                number += some.num_rows

    rows = items.select(name(key).alias("item_id"), name(text).alias("text"))
    kind = dict(rows.dtypes)["item_id"]
    return rows.mapInArrow(run, f"item_id {kind}, item long, at int, window long, terms array<long>")


def _filter_of(terms: DataFrame) -> np.ndarray:
    """The bits of `terms` in a filter of fixed size."""
    bit = F.pmod(F.col("term"), F.lit(FILTER_BITS)) + 1  # Spark's bitmaps begin at 1
    maps = terms.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in maps.collect():  # 4,096 bytes for each of a fixed number of buckets
        out[(row["bucket"] - 1) * 4096 : row["bucket"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return out


def _passing(words: np.ndarray, bits: np.ndarray) -> np.ndarray:
    bit = np.mod(words.view(np.int64), FILTER_BITS)
    return np.flatnonzero(bits[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)


def _frequencies(bits: Broadcast):
    """(term, documents) of each slice of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                words, bounds = _words(some.column("text"))
                at = _passing(words, bits.value)
                owner = np.searchsorted(bounds, at, "right").astype(np.uint64)
                pairs = words[at] + mix(owner)  # distinct in (word, text), but for a chance that only ranks words
                _, first = np.unique(pairs, return_index=True)
                terms, count = np.unique(words[at][first], return_counts=True)
                yield pa.RecordBatch.from_pydict({"term": pa.array(terms.view(np.int64)), "documents": pa.array(count)})

    return run


def _postings(bits: Broadcast):
    """Postings of the wanted terms, and under a null term the words of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                words, bounds = _words(some.column("text"))
                at = _passing(words, bits.value)
                owner = np.searchsorted(bounds, at, "right") - 1
                order = np.lexsort((at, words[at], owner))
                at, owner, terms = at[order], owner[order], words[at][order]
                new = np.ones(len(at), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])
                heads = np.flatnonzero(new)
                limits = np.append(heads, len(at)).astype(np.int32)
                places = pa.ListArray.from_arrays(pa.array(limits), pa.array((at - bounds[owner]).astype(np.int32)))
                n = some.num_rows
                yield pa.RecordBatch.from_pydict(
                    {
                        "term": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(terms[heads].view(np.int64))]),
                        "doc_id": some.column("doc_id").take(pa.array(np.append(np.arange(n), owner[heads]))),
                        "print": some.column("print").take(pa.array(np.append(np.arange(n), owner[heads]))),
                        "n_words": pa.concat_arrays([pa.array(np.diff(bounds)), pa.nulls(len(heads), pa.int64())]),
                        "positions": pa.concat_arrays([pa.nulls(n, places.type), places]),
                    }
                )

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the places whole: words hit, and the windows found, of each text."""
    for batch in batches:
        for some in slices(batch, "text"):
            words, bounds = _words(some.column("text"))
            places = some.column("places")
            owner = np.repeat(np.arange(some.num_rows), np.diff(places.offsets.to_numpy()))
            flat = places.flatten()
            start, length, window = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            inside = (start >= 0) & (start + length <= np.diff(bounds)[owner])
            owner, start, length, window = (x[inside] for x in (owner, start, length, window))
            same = _fold(words, bounds[owner] + start, length) == window
            owner, start, length, window = (x[same] for x in (owner, start, length, window))
            cover = np.zeros(len(words) + 1, np.int64)
            np.add.at(cover, bounds[owner] + start, 1)
            np.add.at(cover, bounds[owner] + start + length, -1)
            hit = np.append(0, np.cumsum(np.cumsum(cover[:-1]) > 0))
            ends = np.searchsorted(owner, np.arange(1, some.num_rows))
            found = [np.unique(x).tolist() for x in np.split(window, ends)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": some.column("doc_id"),
                    "print": some.column("print"),
                    "n_hit": pa.array(hit[bounds[1:]] - hit[bounds[:-1]]),
                    "windows": pa.array(found, pa.list_(pa.int64())),
                }
            )


class PositionalIndex:
    """Postings of the rarest words of all windows in all documents.

    `windows`: distinct windows whose words all occur, with their anchors (term,
    offset); `postings`: (term, doc_id, print, positions); `lengths`: (doc_id,
    print, n_words), one row per document. Documents of equal id are told apart
    by `print`, a hash of the text.
    """

    def __init__(self, docs: DataFrame, items: DataFrame, rarest: int = RAREST) -> None:
        spark = docs.sparkSession
        small_batches(spark)
        self.docs, self.items, self.rarest = docs, items, rarest
        distinct = items.groupBy("window").agg(F.first("terms").alias("terms"))
        terms = distinct.select(F.explode("terms").alias("term")).distinct()
        bits = spark.sparkContext.broadcast(_filter_of(terms))
        counts = docs.select("text").mapInArrow(_frequencies(bits), "term long, documents long")
        counts = counts.groupBy("term").agg(F.sum("documents").alias("documents"))
        counts = written(counts.join(terms, "term", "left_semi"), "frequencies")

        each = distinct.select("window", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
        each = each.join(counts, "term", "left")
        ranked = each.groupBy("window", "length").agg(
            F.array_sort(F.collect_list(F.struct("documents", "term", "offset"))).alias("all")
        )
        # One place for each of the rarest distinct words.
        ranked = ranked.filter(~F.exists("all", lambda x: x["documents"].isNull()))
        one_each = F.filter("all", lambda x, i: (i == 0) | (x["term"] != F.col("all")[F.greatest(i - 1, F.lit(0))]["term"]))
        ranked = ranked.select("window", "length", F.slice(one_each, 1, rarest).alias("anchors"))
        self.windows = written(ranked, "windows")

        anchors = self.windows.select(F.explode("anchors.term").alias("term")).distinct()
        bits = spark.sparkContext.broadcast(_filter_of(anchors))
        kind = dict(docs.dtypes)["doc_id"]
        stored = docs.mapInArrow(
            _postings(bits), f"term long, doc_id {kind}, print long, n_words long, positions array<int>"
        )
        stored = written(stored, "postings")
        self.postings = stored.filter("term IS NOT NULL").select("term", "doc_id", "print", "positions")
        self.lengths = stored.filter("term IS NULL").select("doc_id", "print", "n_words")

    def places(self) -> DataFrame:
        """Where all anchors of a window agree: (doc_id, print, window, length, start).

        Lists are adjusted to where the item, not each window, would begin, as
        windows of an item share their anchors.
        """
        anchored = self.items.select("item", "at", "window").join(self.windows, "window")
        offsets = F.transform("anchors", lambda a: a["offset"] + F.col("at"))
        anchored = anchored.select("item", "at", "window", "length", offsets.alias("offsets"), "anchors.term")
        fewest = anchored.groupBy("item").agg(F.min(F.size("offsets")).alias("fewest"))
        points = anchored.select("item", F.explode(F.arrays_zip("offsets", "term")).alias("x")).select("item", "x.*").distinct()
        points = points.join(fewest, "item").select("item", "fewest", "term", F.col("offsets").alias("offset"))
        adjusted = (
            self.postings.join(points, "term")
            .select("doc_id", "print", "item", "fewest", F.explode("positions").alias("found"), "offset")
            .withColumn("start", F.col("found") - F.col("offset"))
        )
        met = adjusted.groupBy("doc_id", "print", "item", "fewest", "start").agg(F.collect_set("offset").alias("met"))
        met = met.filter(F.size("met") >= F.col("fewest")).withColumn("rarest", F.explode("met"))
        anchored = anchored.drop("term").withColumn("rarest", F.col("offsets")[0])
        agreed = met.join(anchored, ["item", "rarest"]).filter(F.size(F.array_except("offsets", "met")) == 0)
        return agreed.select("doc_id", "print", "window", "length", (F.col("start") + F.col("at")).alias("start"))

    def phrases(self) -> DataFrame:
        """Documents with windows word by word: (doc_id, print, n_hit, windows)."""
        places = self.places().groupBy("doc_id", "print").agg(
            F.collect_set(F.struct("start", "length", "window")).alias("places")
        )
        here = self.docs.join(
            places.select(F.col("doc_id").alias("d"), F.col("print").alias("p"), "places"),
            F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p")),
        ).select("doc_id", "print", "text", "places")
        kind = dict(self.docs.dtypes)["doc_id"]
        found = here.mapInArrow(_compare, f"doc_id {kind}, print long, n_hit long, windows array<long>")
        return found.filter("n_hit > 0").dropDuplicates(["doc_id", "print"])

    def proximity(self, slop: int = 5) -> DataFrame:
        """Windows whose anchors all lie within the window's length and `slop` words
        of each other, in any order: (doc_id, print, window, around)."""
        anchors = self.windows.select(
            "window", "length", F.size("anchors").alias("need"), F.posexplode("anchors.term").alias("nth", "term")
        )
        near = (
            self.postings.join(anchors, "term")
            .select("doc_id", "print", "window", "length", "need", "nth", F.explode("positions").alias("at"))
            .withColumn("reach", F.col("length") + slop)
        )
        # Stretches of `reach` words, each also seen by the one before it, catch every near meeting.
        cell = F.floor(F.col("at") / F.col("reach"))
        spread = near.withColumn("cell", F.explode(F.array(cell, cell - 1)))
        met = spread.groupBy("doc_id", "print", "window", "reach", "need", "cell").agg(
            F.collect_list(F.struct("at", "nth")).alias("seen")
        )
        # Some place from which all anchors lie within reach.
        full = F.exists(
            "seen",
            lambda x: F.size(
                F.array_distinct(
                    F.transform(
                        F.filter("seen", lambda y: (y["at"] >= x["at"]) & (y["at"] < x["at"] + F.col("reach"))),
                        lambda y: y["nth"],
                    )
                )
            )
            == F.col("need"),
        )
        return met.filter(full).groupBy("doc_id", "print", "window").agg(F.min(F.col("cell") * F.col("reach")).alias("around"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    rarest: int = RAREST,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, text_hash.

    Words are runs of ASCII letters and digits and of all that is not ASCII, A-Z
    in lower case. A word inside any occurrence of a window is hit. A null or
    empty text has no words, and an item without words is in no document. Items
    of equal id are one item; a null item id is counted but not named. Rows of
    equal id and text get equal results. Without documents or items the result
    is empty or clean. Other columns are not looked at.
    """
    base = docs.select(name(key).alias("doc_id"), F.coalesce(name(text), F.lit("")).alias("text"))
    base = base.withColumn("print", F.xxhash64("text"))
    looked_up = written(windows(items, item_key, item_text, size), "items")
    index = PositionalIndex(base, looked_up, rarest)
    found = written(index.phrases(), "phrases")
    of = looked_up.select("window", "item_id").distinct()
    named = (
        found.select("doc_id", "print", "n_hit", F.explode("windows").alias("window"))
        .join(of, "window")
        .select("doc_id", "print", "n_hit", F.col("item_id").cast("string").alias("item"))
        .groupBy(F.col("doc_id").alias("d"), F.col("print").alias("p"))
        .agg(
            F.max("n_hit").alias("n_hit"),
            F.array_sort(F.collect_set("item")).alias("items"),
            F.max(F.col("item").isNull().cast("int")).alias("unnamed"),
        )
        .select("d", "p", "n_hit", (F.size("items") + F.col("unnamed")).alias("n_items"), F.array_join("items", ",").alias("items"))
    )
    rows = index.lengths
    joined = rows.join(named, rows["doc_id"].eqNullSafe(named["d"]) & (rows["print"] == named["p"]), "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.col("print").alias("text_hash"),
    )


def keep_clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of `docs` in which no window of the items occurs, columns as they are.

    A null or empty text has no words and stays, as does everything where there are no items. Rows of equal id and
    text stay or go together; null ids are equal. Whole texts are searched, however long.
    """
    found = decontaminate(docs, items, key, text, **how).filter("contaminated").select("doc_id", "text_hash").distinct()
    return rows_of(docs, written(found, "contaminated"), "left_anti", key, text)

