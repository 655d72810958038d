"""Hard negatives by a secondary sort of scored pairs.

Pairs are packed into keys (anchor, falling score, positive first, id), dealt by
anchor and sorted within partitions. One pass over the sorted stream opens a
window at each of an anchor's first positives and hands every following negative
to the windows it lies in, so an anchor's pairs are never held together.

Scores are made block against block. A first pass finds every anchor's positives.
They say which scores its windows can hold, so the second pass hands over only
the negatives of a slice that may be among the first of a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm import vectors as V
from articlelake.llm.common import name, written

#: Anchors of a block.
ANCHORS = 512

SQL = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * c::DOUBLE) FOR c IN embedding] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor, c.vec_id AS other, a.label = c.label AS same,
         list_inner_product(a.x, c.x)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor, other AS positive, score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) AS nth FROM pairs WHERE same)
  WHERE nth <= 5),
ranked AS (
  SELECT p.anchor, p.positive, n.other AS negative, p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.other) AS nth
  FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor AS anchor_id, positive AS positive_id, nth::INTEGER AS rank, negative AS negative_id,
       positive_score, negative_score
FROM ranked WHERE nth <= 10"""

_PAIR = "anchor long, anchor_id long, positive boolean, score long, other long, row long"
_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _by_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Iterator[dict]]]:
    """The left block and its right blocks, for each left block and slice that follow each other."""
    rows = (r for b in batches for r in zip(*(b.column(c) for c in ("no", "slice", "a", "b")), strict=True))
    at, left, rest = None, None, []
    for no, slice_, a, b in rows:
        if at != (no.as_py(), slice_.as_py()):
            if at is not None:
                yield left, rest
            at, left, rest = (no.as_py(), slice_.as_py()), V.unpack(a.as_py()), []
        rest.append(b.as_py())
    if at is not None:
        yield left, rest


def _score(left: dict, right: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All scores of a block pair, whether labels are the same, and whether the pair is a row with itself."""
    scores = V.products(left["x"].astype(np.int64), right["x"].astype(np.int64))
    return scores, left["label"][:, None] == right["label"], left["row"][:, None] == right["row"]


def _highest(scores: np.ndarray, wanted: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's `count` highest wanted scores; of equal ones the first columns."""
    low = np.iinfo(np.int64).min if scores.dtype == np.int64 else -np.inf
    masked = np.where(wanted, scores, low)
    if masked.shape[1] > count:
        bound = np.partition(masked, masked.shape[1] - count, 1)[:, masked.shape[1] - count]
        wanted = wanted & (masked >= bound[:, None])
    who, where = np.nonzero(wanted)
    kept = V.first_of_each(who, count, -scores[who, where], where)
    return who[kept], where[kept]


def _pairs_batch(left: dict, right: dict, who: np.ndarray, scores: np.ndarray, where: np.ndarray, positive: bool) -> dict:
    return {
        "anchor": left["row"][who], "anchor_id": left["id"][who], "positive": np.full(len(who), positive),
        "score": scores[who, where].astype(np.int64), "other": right["id"][where], "null": right["null"][where],
        "row": right["row"][where],
    }


def _emit(found: list[dict], kept: np.ndarray | None = None) -> pa.RecordBatch:
    arrays = {c: np.concatenate([f[c] for f in found]) for c in found[0]}
    if kept is not None:
        arrays = {c: v[kept] for c, v in arrays.items()}
    null = arrays.pop("null")
    return pa.RecordBatch.from_pydict({c: pa.array(v, mask=null if c == "other" else None) for c, v in arrays.items()})


def _first(found: list[dict], count: int, *groups: str) -> np.ndarray:
    """Which of the found rows are among the first of their groups."""
    arrays = {c: np.concatenate([f[c] for f in found]) for c in found[0]}
    group = np.unique(np.stack([arrays[g] for g in groups], 1), axis=0, return_inverse=True)[1].reshape(-1)
    return V.first_of_each(group, count, -arrays["score"], arrays["null"], arrays["other"], arrays["row"])


def _positives(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    for left, rest in _by_slice(batches):
        found = []
        for data in rest:
            right = V.unpack(data)
            scores, same, own = _score(left, right)
            found.append(_pairs_batch(left, right, *_at(scores, *_highest(scores, same & ~own, count)), True))
        yield _emit(found, _first(found, count, "anchor"))


def _at(scores, who, where):
    return who, scores, where


def _negatives(batches: Iterator[pa.RecordBatch], low: int, high: int, count: int) -> Iterator[pa.RecordBatch]:
    """Per slice, the negatives that are among the first `count` of one of their anchor's windows there."""
    for left, rest in _by_slice(batches):
        found = []
        goals = left["goals"]
        for data in rest:
            right = V.unpack(data)
            scores, same, _ = _score(left, right)
            for nth in range(goals.shape[1]):
                # A window of a positive score p holds low * p to high * p percent; it is empty below zero.
                goal = goals[:, nth, None]
                first, last = -(-low * goal // 100), high * goal // 100
                in_window = ~same & (scores >= first) & (scores <= last) & left["has"][:, nth, None]
                pairs = _pairs_batch(left, right, *_at(scores, *_highest(scores, in_window, count)), False)
                found.append(pairs | {"nth": np.full(len(pairs["row"]), nth)})
        kept = _first(found, count, "anchor", "nth")
        keys = np.concatenate([np.stack([f["anchor"], f["row"]], 1) for f in found])[kept]
        once = kept[np.unique(keys, axis=0, return_index=True)[1]]
        yield _emit([{c: v for c, v in f.items() if c != "nth"} for f in found], once)


def _ordered_bytes(value: Column) -> Column:
    """A long as eight bytes that sort like it."""
    return F.unhex(F.lpad(F.hex(value.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def packed(pairs: DataFrame) -> DataFrame:
    """(anchor, anchor_id, key) with keys that sort by anchor, falling score, positives first, id, null ids last."""
    flag = F.when(F.col("positive"), F.lit(0)).otherwise(F.lit(2)) + F.col("other").isNull().cast("int")
    key = F.concat(
        _ordered_bytes(F.col("anchor")), _ordered_bytes(-F.col("score")), F.unhex(F.lpad(F.hex(flag), 2, "0")),
        _ordered_bytes(F.coalesce("other", F.lit(0))),
    )
    return pairs.select("anchor", "anchor_id", key.alias("key"))


def _stream(batches: Iterator[pa.RecordBatch], low: int, high: int, positives: int, count: int) -> Iterator[pa.RecordBatch]:
    """Open a window at each positive and hand negatives to the open ones; only windows are held."""
    at, windows, opened = None, [], 0
    for batch in batches:
        out: list[tuple] = []
        for anchor, key in zip(batch.column("anchor_id").to_pylist(), batch.column("key").to_pylist(), strict=True):
            if key[:8] != at:
                at, windows, opened = key[:8], [], 0
            score = -(int.from_bytes(key[8:16], "big") - (1 << 63))
            other = None if key[16] & 1 else int.from_bytes(key[17:25], "big") - (1 << 63)
            if key[16] < 2:
                opened += 1
                if opened <= positives:
                    windows.append([other, score, 0])
                continue
            for window in windows:
                if window[2] < count and low * window[1] <= 100 * score <= high * window[1]:
                    window[2] += 1
                    out.append((anchor, window[0], window[2], other, window[1], score))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def relabelled(key: Column, label: Column, every: int = 7, labels: int = 10) -> Column:
    """The next label where the id is divisible by `every`: labels that contradict their vectors."""
    return F.when(key % every == 0, (label + 1) % labels).otherwise(label)


def hard_negatives(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of vectors whose entries count as floor(256 * c). Anchors
    are rows whose id is divisible by `every`. For each of an anchor's first `positives`
    other rows of its label, the result has the first `negatives` rows of another label
    whose score is `low` to `high` percent of the positive's, which must be below it. Higher scores come first, equal
    ones by id, a null id last. Rows with a null label or vector, or with null, NaN or
    infinite entries, take no part. Rows of one id are rows of their own, as anchors too. Of vectors of different
    length the shorter counts as ending in zeros. An anchor without a positive, and a
    window without a negative, give no rows; an empty table gives none. Scores end at the
    largest long. Other columns are not looked at.
    """
    if not 0 <= low <= high < 100:
        raise ValueError("a window lies below its positive: 0 <= low <= high < 100")
    label = name("label") if label is None else label
    found = V.whole_rows(rows.filter(label.isNotNull()), key, vector, label=label.cast("long"))
    blocks = V.in_blocks(found, dict)
    anchors = found.filter(F.col("id") % every == 0)
    pairs = V.beside(V.in_blocks(anchors, dict, ANCHORS), blocks)
    near = pairs.mapInArrow(lambda batches: _positives(batches, positives), _PAIR)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("other"), "row")
    opening = written(near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives), "positives")

    goals = opening.groupBy("anchor").agg(F.sort_array(F.collect_list("score")).alias("goals"))  # at most `positives`
    aimed = anchors.join(goals, anchors["row"] == goals["anchor"]).select("row", "id", "x", "label", "goals")

    def with_goals(block: dict) -> dict:
        listed = block.pop("goals")
        full = np.zeros((len(listed), positives), np.int64)
        for at, own in enumerate(listed):
            full[at, : len(own)] = own
        has = np.arange(positives) < np.array([len(own) for own in listed])[:, None]
        return block | {"goals": full, "has": has}

    pairs = V.beside(V.in_blocks(written(aimed, "anchors"), with_goals, ANCHORS), blocks)
    far = pairs.mapInArrow(lambda batches: _negatives(batches, low, high, negatives), _PAIR)
    keyed = packed(opening.drop("nth").unionByName(far))
    # DataFrame form of repartitionAndSortWithinPartitions: the sort is part of the exchange's reader and spills.
    dealt = keyed.repartition("anchor").sortWithinPartitions("key")
    return dealt.mapInArrow(lambda batches: _stream(batches, low, high, positives, negatives), _FOUND)
