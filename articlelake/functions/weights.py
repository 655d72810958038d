"""Words of blocks of articles, counted and weighed over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of a block held before they are counted together; a block of more is counted in parts.
HELD_WORDS = 2_000_000

#: Rows of a batch of counted words.
COUNTS_AT_ONCE = 50_000

COUNTED = "block long, token string, n long"
_COUNTED = pa.schema([("block", pa.int64()), ("token", pa.string()), ("n", pa.int64())])

_VECTOR = pa.map_(pa.string(), pa.float32())


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words in order; then of each text's distinct words the text, the word and its occurrences."""
    lists = pc.split_pattern(texts, " ")
    words, parents = lists.flatten(), pc.list_parent_indices(lists)
    some = pc.not_equal(words, "")
    coded = words.filter(some).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    each = max(len(order), 1)
    pairs = parents.filter(some).to_numpy().astype(np.int64) * each + rank[coded.indices.to_numpy()]
    pairs, n = np.unique(pairs, return_counts=True)
    return coded.dictionary.take(pa.array(order)), pairs // each, pairs % each, n


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return ((a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`(block, token, n)`: in how many texts of a block a word is; rows are `(block, texts)`, and a word may come again."""
    block, held, size = None, [], 0

    def counted() -> Iterator[pa.RecordBatch]:
        coded = pa.concat_arrays([words for words, _ in held]).dictionary_encode()
        n = np.bincount(coded.indices.to_numpy(), np.concatenate([n for _, n in held]), len(coded.dictionary)).astype(np.int64)
        for at in range(0, len(n), COUNTS_AT_ONCE):
            some = n[at : at + COUNTS_AT_ONCE]
            yield pa.record_batch([np.full(len(some), block), coded.dictionary.slice(at, len(some)), some], schema=_COUNTED)

    for batch in batches:
        blocks = batch.column(0).to_numpy()
        for a, b in _runs(blocks):
            if held and (blocks[a] != block or size > HELD_WORDS):
                yield from counted()
                held, size = [], 0
            block = blocks[a]
            words, _, of, _ = _words(batch.column(1).slice(a, b - a).flatten())
            held.append((words, np.bincount(of, minlength=len(words))))
            size += len(words)
    if held:
        yield from counted()


def _vectors(lists: pa.Array, known: pa.Array, known_idf: np.ndarray, rare: float) -> pa.Array:
    texts = lists.flatten()
    words, text, of, n = _words(texts)
    at = pc.index_in(words, value_set=known).to_numpy(zero_copy_only=False)
    idf = np.full(len(words), rare)
    found = ~np.isnan(at) if at.dtype.kind == "f" else np.ones(len(at), bool)
    idf[found] = known_idf[at[found].astype(np.int64)]

    def ends(sizes: np.ndarray) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())

    values = pa.array((n * idf[of]).astype(np.float32))
    maps = pa.MapArray.from_arrays(ends(np.bincount(text, minlength=len(texts))), words.take(pa.array(of)), values)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    return pa.ListArray.from_arrays(ends(sizes), maps)


@F.arrow_udf(T.ArrayType(T.MapType(T.StringType(), T.FloatType())))
def _weigh(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    block, tokens, idfs, known = None, [], [], None
    for of, token, idf, lists, rare in batches:
        done = []
        for a, b in _runs(of.to_numpy()):
            if of[a].as_py() != block:
                block, tokens, idfs, known = of[a].as_py(), [], [], None
            if entries := b - a - token.slice(a, b - a).null_count:
                tokens.append(token.slice(a, entries))
                idfs.append(idf.slice(a, entries).to_numpy())
            if entries < b - a and known is None:
                known = pa.concat_arrays([pa.array([], pa.string()), *tokens]), np.concatenate([np.empty(0), *idfs])
            none = pa.array([], pa.string()), np.empty(0)
            done.append(_vectors(lists.slice(a, b - a), *(known or none), rare[a].as_py()))
        yield pa.concat_arrays(done) if done else pa.array([], pa.list_(_VECTOR))


#: Vectors of an article's texts, whose words lie between spaces: `(block, token, idf, texts, rare)`. In a partition, rows
#: with the tokens of a block come before its articles, whose token is null; a word without such a row weighs `rare`.
weigh = _weigh.asNondeterministic()  # called once per row, in this order
