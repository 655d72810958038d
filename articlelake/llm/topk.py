"""Exact search for the highest inner products, by reading sorted lists without random access.

A block of candidates keeps one list per dimension: its entries from the highest
to the lowest, each with the candidate's place. A query reads the lists of its
positive entries from the top and those of its negative ones from the bottom, all
to the same depth. What it has read bounds every candidate's score from below and
above. Candidates whose upper bound is under the k-th best lower bound cannot
qualify; when few others are left the reading stops and their scores are resolved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from articlelake.llm import vectors as V

#: Queries of a block.
QUERIES = 512
#: Parts of the lists that are read before bounds are compared again.
DEPTHS = (0.125, 0.25, 0.375, 0.5, 0.75, 1.0)
#: Reading stops when no more than this many candidates a wanted result are left.
LEFT = 8

SQL = """WITH v AS (
  SELECT vec_id, [floor(256 * c::DOUBLE) FOR c IN embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
ranked AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id) AS nth
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, nth::INTEGER AS rank, vec_id, score FROM ranked WHERE nth <= 5"""


def sorted_lists(block: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Candidates as one falling list of (value, place) per dimension."""
    x = block.pop("x").T
    place = np.argsort(~x, axis=1, kind="stable").astype(np.int32)
    return block | {"place": place, "value": np.take_along_axis(x, place, 1)}


def finalists(q: np.ndarray, own: np.ndarray, lists: dict[str, np.ndarray], k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, place) of all candidates that may be among the k best of a query.

    `floor` holds a score that k candidates of each query are known to reach;
    a query's own row (`own`, -1 for none) is no candidate.
    """
    place, value = lists["place"], lists["value"].astype(np.float64)
    width, count = place.shape
    signed = np.hstack([np.maximum(q, 0), np.minimum(q, 0)]).astype(np.float64)
    most, least = np.empty((2 * width, count)), np.empty((2 * width, count))
    mine = np.flatnonzero(own >= 0)
    alive = np.ones((len(q), count), bool)
    for part in DEPTHS:
        depth = max(1, int(np.ceil(part * count)))
        back = count - depth
        # Unread entries lie between the last one read and the far end of the list.
        most[:width], least[:width] = value[:, depth - 1 : depth], value[:, -1:]
        most[width:], least[width:] = value[:, back : back + 1], value[:, :1]
        for bound in (most, least):
            np.put_along_axis(bound[:width], place[:, :depth], value[:, :depth], 1)
            np.put_along_axis(bound[width:], place[:, back:], value[:, back:], 1)
        upper = signed @ most
        lower = upper.copy() if depth == count else signed @ least
        upper[mine, own[mine]] = lower[mine, own[mine]] = -np.inf
        if count > k:
            floor = np.maximum(floor, np.partition(lower, count - k, 1)[:, count - k])
        alive = upper >= floor[:, None]
        alive[mine, own[mine]] = False
        if np.count_nonzero(alive) <= LEFT * k * len(q):
            break
    return np.nonzero(alive)


def _all_but_own(own: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(np.arange(count) != own[:, None])


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The k best of each query among the blocks of a slice; their k-th score carries over from block to block."""
    at, queries, best = None, {}, {}

    def results() -> pa.RecordBatch:
        ids = queries["id"][best["query"]]
        arrays = {
            "query": pa.array(queries["row"][best["query"]]), "query_id": pa.array(ids), "score": pa.array(best["score"]),
            "vec_id": pa.array(best["id"], mask=best["null"]), "row": pa.array(best["row"]),
        }
        return pa.RecordBatch.from_pydict(arrays)

    for batch in batches:
        for no, slice_, a, b in zip(*(batch.column(c) for c in ("no", "slice", "a", "b")), strict=True):
            if at != (no.as_py(), slice_.as_py()):
                if at is not None:
                    yield results()
                at, queries = (no.as_py(), slice_.as_py()), V.unpack(a.as_py())
                none = np.zeros(0, np.int64)
                best = {"query": none, "score": none, "id": none, "null": none.astype(bool), "row": none}
            best = _better(queries, V.unpack(b.as_py()), best, k)
    if at is not None:
        yield results()


def _better(queries: dict, lists: dict, best: dict, k: int) -> dict:
    count = len(lists["row"])
    order = np.argsort(lists["row"])
    found = np.minimum(np.searchsorted(lists["row"], queries["row"], sorter=order), count - 1)
    own = np.where(lists["row"][order[found]] == queries["row"], order[found], -1)
    x = np.empty_like(lists["value"])
    np.put_along_axis(x, lists["place"], lists["value"], 1)
    q, x = V.same_width(queries["x"].astype(np.int64), x.T)
    held = np.bincount(best["query"], minlength=len(q))
    floor = np.full(len(q), -np.inf)
    np.minimum.at(lowest := np.full(len(q), np.inf), best["query"], best["score"])
    floor[held >= k] = lowest[held >= k]
    if V.exact_in_doubles(q, x):
        lists = {c: lists[c][: q.shape[1]] for c in ("place", "value")} | {c: lists[c] for c in ("id", "null", "row")}
        who, where = finalists(q, own, lists, k, floor)
    else:  # Bounds would not be exact: every candidate is resolved.
        who, where = _all_but_own(own, count)
    pieces = range(0, len(who), 1 << 17)
    scores = [V.paired_products(q[who[i : i + (1 << 17)]], x[where[i : i + (1 << 17)]]) for i in pieces]
    fresh = {"query": who, "score": np.concatenate([np.zeros(0, np.int64), *scores])}
    fresh |= {c: lists[c][where] for c in ("id", "null", "row")}
    both = {c: np.concatenate([best[c], fresh[c]]) for c in best}
    kept = V.first_of_each(both["query"], k, -both["score"], both["null"], both["id"], both["row"])
    return {c: v[kept] for c, v in both.items()}


def exact_top_k(rows: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with other rows.

    Entries count as floor(256 * c). Queries are the rows whose id is divisible by
    `every`; candidates are all rows but the query's own. Equal scores are ordered by id,
    a null id last. Rows whose vector is null or holds null, NaN or infinite entries take
    no part. Of vectors of different length the shorter counts as ending in zeros. Rows of
    one id are rows of their own, as queries and as candidates. Fewer candidates than k give
    fewer results, an empty table or one row gives none. Scores end at the largest long. Other columns are not looked at.
    """
    spark = rows.sparkSession
    found = V.whole_rows(rows, key, vector)
    lists = V.in_blocks(found, sorted_lists)
    queries = V.in_blocks(found.filter(F.col("id") % every == 0), dict, QUERIES)
    V.batches_by_bytes(spark)
    schema = "query long, query_id long, score long, vec_id long, row long"
    near = V.beside(queries, lists).mapInArrow(lambda batches: _search(batches, k), schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
