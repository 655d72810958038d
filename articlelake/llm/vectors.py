"""Vectors as whole numbers, packed into blocks of rows, and blocks beside each other."""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articlelake.llm.common import name, written

#: Rows of a block, and bytes of an Arrow batch that carries blocks.
BLOCK = 4096
BATCH_BYTES = 16 << 20

_MOST = (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))


def whole_numbers(vector: Column) -> Column:
    """floor(256 * c) of every entry; beyond a long it is the nearest long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * 256))


def whole_rows(rows: DataFrame, key: str, vector: str, **more: Column) -> DataFrame:
    """(row, id, x, ...) of rows with a usable vector, written; `row` tells rows of one id apart."""
    kept = rows.filter(usable(name(vector)))
    columns = [c.alias(k) for k, c in more.items()]
    kept = kept.select(name(key).cast("long").alias("id"), whole_numbers(name(vector)).alias("x"), *columns)
    return written(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")


def batches_by_bytes(spark: SparkSession) -> None:
    """Blocks are large rows: bound Arrow batches by their bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as rows of longs; shorter lists end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    full = np.zeros((len(sizes), width), np.int64)
    full[np.arange(width) < sizes[:, None]] = values
    return full


def narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    fits = (t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return x.astype(next(fits))


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data), allow_pickle=False) as arrays:
        return dict(arrays)


def in_blocks(rows: DataFrame, make: Callable[[dict], dict], size: int = BLOCK) -> DataFrame:
    """Rows (row, id, x, ...) as (no, block), each block about `size` rows in id order, nulls last.

    `make` turns the arrays of a block (id, null, row, x and further columns) into what is kept.
    """
    batches_by_bytes(rows.sparkSession)
    parts = max(1, math.ceil(rows.count() / size))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, size):
            arrays = {"x": narrow(matrix(table.column("x")))}
            for column in table.column_names:
                if column not in ("x", "id"):
                    arrays[column] = table.column(column).to_numpy()
            ids = table.column("id")
            arrays |= {"id": ids.fill_null(0).to_numpy(), "null": ids.is_null().to_numpy()}
            order = np.lexsort((arrays["row"], arrays["id"], arrays["null"]))
            block = pack(make({k: v[order] for k, v in arrays.items()}))
            yield pa.RecordBatch.from_pydict({"block": [block]}, schema=pa.schema({"block": pa.binary()}))

    blocks = rows.repartition(parts).mapInArrow(build, "block binary")
    return written(blocks.withColumn("no", F.monotonically_increasing_id()), "blocks")


def _gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        while sum(b.num_rows for b in held) >= 2 * size:
            table = pa.Table.from_batches(held)
            yield table.slice(0, size)
            held = table.slice(size).to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every block of `left` beside every block of `right`: (no, slice, a, b).

    The right blocks are dealt into slices, about four times as many as the root of
    their number, and the left ones go to every slice. All rows of one left block
    and one slice follow each other in one task.
    """
    blocks = right.count()
    slices = max(1, min(blocks, math.ceil(4 * math.sqrt(blocks))))
    dealt = right.select(F.pmod(F.shiftright("no", 33), F.lit(slices)).cast("int").alias("slice"), F.col("block").alias("b"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    copied = left.select(everywhere, "no", F.col("block").alias("a"))
    copied, dealt = (df.repartition(3 * slices, "slice") for df in (copied, dealt))
    return copied.hint("merge").join(dealt.hint("merge"), "slice").select("no", "slice", "a", "b")


def exact_in_doubles(q: np.ndarray, x: np.ndarray) -> bool:
    """Whether inner products of rows of `q` and `x` are exact in doubles, sums on the way included."""
    largest = [int(max(-int(v.min()), int(v.max()), 1)) if v.size else 1 for v in (q, x)]
    return largest[0] * largest[1] * max(1, q.shape[1]) < 1 << 52


def same_width(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Missing entries at the end count as zero and so need no place."""
    width = min(q.shape[1], x.shape[1])
    return q[:, :width], x[:, :width]


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows of `q` and `x`: exact doubles, or longs that end at the largest."""
    q, x = same_width(q, x)
    if exact_in_doubles(q, x):
        return q.astype(np.float64) @ x.astype(np.float64).T
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -_MOST, _MOST).astype(np.int64)


def paired_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner product of each row of `q` with the same row of `x`, as longs that end at the largest."""
    q, x = same_width(q, x)
    if exact_in_doubles(q, x):
        return np.einsum("ij,ij->i", q.astype(np.float64), x.astype(np.float64)).astype(np.int64)
    exact = (q.astype(object) * x.astype(object)).sum(1)
    return np.clip(exact, -_MOST, _MOST).astype(np.int64)


def first_of_each(group: np.ndarray, count: int, *order: np.ndarray) -> np.ndarray:
    """Positions of the first `count` of each group, by the keys `order`, most important first."""
    by = np.lexsort((*reversed(order), group))
    sorted_ = group[by]
    starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(by) else np.zeros(0, np.int64)
    nth = np.arange(len(by)) - np.repeat(starts, np.diff(np.append(starts, len(by))))
    return by[nth < count]
