"""Near duplicates: banded MinHash signatures, verified in sequence.

Documents with equal sets of shingles are one class, and only classes are
compared. Signatures are cut into bands; classes that agree in a band share a
bucket. Pairs of a bucket are not all compared: in a first round every class
meets the most central member of its buckets, and what is linked is merged; in
the second only members of a bucket that are still in different components meet,
in a large bucket only those that share one of their rarest shingles, as sets
similar enough must. As links within a component change nothing, no link between
components is lost.

A pair is compared batch by batch of its signatures and dropped once the chance
that its similarity reaches the threshold, given the matches so far and a
uniform prior, is below `miss`. What survives is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm.common import name, rows_of, small_batches, text_hash, written
from articlelake.llm.components import contract
from articlelake.llm.words import BETWEEN_BLANKS, LOWER, buffer_of, hashes, mix, shingles, slices, spans

SHINGLE = 5
PERCENT = 85
#: With 24 bands of 6 a pair at the threshold shares no band with probability 1.2e-5.
ROWS = 6
BANDS = 24
BATCH = 24
MISS = 1e-6

#: Buckets of more members meet through their sets' rarest shingles instead of one by one.
SMALL = 32

#: Shingles whose signatures are worked on at once.
_STRIP = 1 << 15


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    data, offsets = buffer_of(texts)
    data = LOWER[data]
    starts, ends, bounds = spans(data, offsets, BETWEEN_BLANKS)
    values, limits = shingles(hashes(data, starts, ends), bounds, size)
    return [np.unique(values[a:b]) for a, b in zip(limits[:-1], limits[1:], strict=True)]


def _node(values: np.ndarray) -> bytes | None:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)


def _minima(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash values, one row per set that is not empty."""
    out = np.empty((len(sets), count), np.uint32)
    factors, at = _multipliers(count), 0
    while at < len(sets):
        to, held = at, 0
        while to < len(sets) and (to == at or held + len(sets[to]) <= _STRIP):
            held += len(sets[to])
            to += 1
        values = np.concatenate(sets[at:to])
        begins = np.cumsum([0, *map(len, sets[at : to - 1])])
        for k in range(count):
            high = (values * factors[k] >> np.uint64(32)).astype(np.uint32)
            out[at:to, k] = np.minimum.reduceat(high, begins)
        at = to
    return out


def _sign(size: int, count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                sets = _sets(some.column("text"), size)
                filled = [s for s in sets if len(s)]
                minima = iter(_minima(filled, count))
                signatures = [next(minima).tobytes() if len(s) else None for s in sets]
                columns = {
                    "doc_id": some.column("doc_id"),
                    "print": some.column("print"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "node": pa.array([_node(s) for s in sets], pa.binary()),
                    "signature": pa.array(signatures, pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _whole(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                sets = _sets(some.column("text"), size)
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": pa.array([_node(s) for s in sets], pa.binary()),
                        "set": pa.array([s.tobytes() for s in sets], pa.binary()),
                    }
                )

    return run


def fewest_matches(batch: int, count: int, percent: int, miss: float) -> list[int]:
    """For each number of compared values, the fewest matches that keep a pair.

    With a uniform prior and m matches of h, the chance that the similarity is t
    or more is that of at most m successes in h + 1 draws of chance t.
    """
    t, least = percent / 100, []
    for h in range(batch, count + 1, batch):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += comb(h + 1, m) * t**m * (1 - t) ** (h + 1 - m)
        least.append(m)
    return least


def _prune(batch: int, count: int, percent: int, miss: float):
    least = fewest_matches(batch, count, percent, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            left, right = (_matrix(rows.column(c), count) for c in ("sa", "sb"))
            alive, matches = np.arange(rows.num_rows), np.zeros(rows.num_rows, np.int64)
            for k, enough in enumerate(least):
                part = slice(k * batch, (k + 1) * batch)
                matches[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= enough]
            yield rows.select(["a", "b"]).take(pa.array(alive))

    return run


def _matrix(column: pa.Array, count: int) -> np.ndarray:
    data, offsets = buffer_of_binary(column)
    return data[offsets[0] :].view("<u4").reshape(len(column), count)


def buffer_of_binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            good = []
            for i, (x, y) in enumerate(zip(rows.column("xa"), rows.column("xb"), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    good.append(i)
            yield rows.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return run


def _sided(table: DataFrame, side: str, *columns: str) -> DataFrame:
    return table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c[0] if c != 'set' else 'x'}{side}") for c in columns])


def _apart(rows: DataFrame, key: str, holds) -> DataFrame:
    """Pairs (a, b) of nodes that share `key` but not `label`, for which `holds`.

    Of a key's largest label no two nodes are looked at, so what it costs is the
    number of nodes outside that label times the number of all.
    """
    here = rows.groupBy(key, "label").agg(F.count(F.lit(1)).alias("n"))
    largest = here.groupBy(key).agg(F.max(F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels"))
    rows = rows.join(largest.filter("labels > 1").select(key, F.col("most.label").alias("most")), key)
    few = rows.filter("label <> most").drop("most")
    few = few.select(key, *[F.col(c).alias(f"{c}_x") for c in few.columns if c != key])
    order = (F.col("label") == F.col("most")) | (F.col("node_x") < F.col("node"))
    apart = few.join(rows, key).filter((F.col("label_x") != F.col("label")) & order & holds)
    return apart.select(F.least("node_x", "node").alias("a"), F.greatest("node_x", "node").alias("b"))


def _prefixes(rows: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each set, (node, label, size, token, at): two sets
    similar enough have one in common among so many, in any order that all share."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, values in enumerate(batch.column("set")):
                values = np.frombuffer(values.as_buffer(), np.int64)
                one = [pa.array([batch.column(c)[i].as_py()] * len(values), pa.binary()) for c in ("node", "label")]
                yield pa.RecordBatch.from_arrays([*one, pa.array(values)], ["node", "label", "token"])

    each = written(rows.select("node", "label", "set").mapInArrow(tokens, "node binary, label binary, token long"), "tokens")
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("sets"))
    ordered = each.join(often, "token").groupBy("node", "label")
    ordered = ordered.agg(F.array_sort(F.collect_list(F.struct("sets", "token"))).alias("all"))
    size = F.size("all")
    first = F.slice("all", 1, (F.floor(size * (100 - percent) / 100) + 1).cast("int"))
    chosen = ordered.select("node", "label", size.alias("size"), F.posexplode(first).alias("at", "x"))
    return written(chosen.select("node", "label", "size", "at", F.col("x.token").alias("token")), "prefixes")


def near_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    rows: int = ROWS,
    bands: int = BANDS,
    batch: int = BATCH,
    miss: float = MISS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_hash.

    Words are runs between white space, A-Z in lower case; a set holds the
    distinct runs of `size` words, or the whole sequence where there are fewer.
    Documents are linked when 100 * common >= percent * all, and component_id is
    the smallest id reachable. A document without words, or a null text, has an
    empty set and is linked with nothing, not even with another such. Null ids
    are greater than all others. Rows of equal id are documents of their own
    that share an id. Other columns are not looked at; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    count = rows * bands
    base = docs.select(name(key).alias("doc_id"), F.coalesce(name(text), F.lit("")).alias("text"))
    base = base.withColumn("print", F.xxhash64("text"))
    kind = dict(base.dtypes)["doc_id"]
    signed = base.mapInArrow(
        _sign(size, count), f"doc_id {kind}, print long, n_shingles long, node binary, signature binary"
    )
    signed = written(signed, "signatures")
    classes = (
        signed.filter("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.max("n_shingles").alias("n_shingles"),
            F.min(F.struct("doc_id", "print")).alias("first"),
            F.min("signature").alias("signature"),
        )
    )
    classes = written(classes, "classes")

    width = 4 * rows
    band = [F.xxhash64(F.substring("signature", k * width + 1, width), F.lit(k)) for k in range(bands)]
    banded = classes.select("node", F.explode(F.array(*band)).alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = written(banded.join(shared, "band"), "buckets")

    # The member that meets most others is the one to compare with.
    central = shared.groupBy("node").agg(F.sum("members").alias("meets"))
    central = shared.join(central, "node")
    leaders = central.groupBy("band").agg(F.max(F.struct("meets", "node")).alias("lead"))
    met = central.join(leaders, "band").select("node", "lead", F.col("lead.node").alias("leader")).filter("node <> leader")
    met = met.groupBy("node").agg(F.max("lead").alias("lead")).select("node", F.col("lead.node").alias("leader"))
    pairs = met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()

    wanted = shared.select("node").distinct().join(classes, "node").select("first.*")
    there = [base["doc_id"].eqNullSafe(wanted["doc_id"]), base["print"] == wanted["print"]]
    sets = base.join(wanted, there[0] & there[1], "left_semi").select("text")
    sets = sets.mapInArrow(_whole(size), "node binary, set binary").dropDuplicates(["node"])
    sets = written(sets, "sets")

    def links(pairs: DataFrame) -> DataFrame:
        sided = pairs.join(_sided(classes, "a", "signature", "n_shingles"), "a")
        sided = sided.join(_sided(classes, "b", "signature", "n_shingles"), "b")
        near = sided.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b", "sa", "sb")
        near = written(near.mapInArrow(_prune(batch, count, percent, miss), "a binary, b binary"), "survivors")
        full = near.join(_sided(sets, "a", "set"), "a").join(_sided(sets, "b", "set"), "b")
        return written(full.select("a", "b", "xa", "xb").mapInArrow(_confirm(percent), "a binary, b binary"), "links")

    labels = contract(links(pairs))

    # Members of a bucket that are in different components still have to meet.
    open_ = shared.join(labels, "node", "left").select(
        "band", "members", "node", F.coalesce("label", "node").alias("label")
    )
    kinds = open_.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = written(open_.join(kinds.filter("low <> high").select("band"), "band"), "open")
    pairs = _apart(open_.filter(F.col("members") <= SMALL), "band", F.lit(True))
    crowded = open_.filter(F.col("members") > SMALL).select("node", "label").distinct()
    prefixes = _prefixes(crowded.join(sets, "node"), percent)
    # A shared shingle at places i and j leaves room for so much in common; the first one shared leaves enough.
    room = F.least(F.col("size_x") - F.col("at_x"), F.col("size") - F.col("at"))
    pairs = pairs.union(_apart(prefixes, "token", room * (100 + percent) >= percent * (F.col("size_x") + F.col("size"))))
    pairs = pairs.distinct()
    late = links(pairs)
    if not late.isEmpty():
        own = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        other = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        between = late.join(own, "a", "left").join(other, "b", "left")
        merged = contract(between.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        merged = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
        moved = labels.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        fresh = merged.select(F.col("label").alias("node"), F.col("to").alias("label"))
        labels = written(moved.union(fresh.join(labels, "node", "left_anti")), "labels")

    found = signed.select("doc_id", "n_shingles", "node", "print").join(labels, "node", "left")
    found = found.withColumn("label", F.coalesce("label", "node"))
    least = found.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    found = found.join(least, "label", "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        F.col("print").alias("text_hash"),
    )


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of `docs` that stay: of every group the one of the smallest id; rows alike in id and text become one."""
    kept = near_groups(docs, key, text, **how).filter("kept").select("doc_id", "text_hash")
    kept = written(kept.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows")), "kept")
    rows = rows_of(docs, kept, "left_semi", key, text)
    if kept.filter("rows > 1").isEmpty():
        return rows
    once = rows.withColumn("__hash", text_hash(text))
    return once.dropDuplicates([key, "__hash"]).drop("__hash")
