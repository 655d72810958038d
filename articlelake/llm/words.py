"""Words of whole Arrow batches as arrays of byte spans and 64-bit hashes.

Texts stay in their Arrow buffer. A word is a run of bytes that a table of 256
entries marks; as every byte of a non-ASCII character is at least 0x80, byte
runs and character runs are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked on in slices of about this many bytes.
SLICE_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: A second hash, where words have to be told apart for sure.
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_powers: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Marks words that end at white space.
BETWEEN_BLANKS = np.ones(256, dtype=bool)
BETWEEN_BLANKS[[32, 9, 10, 11, 12, 13]] = False

#: Marks words of lower-case letters, digits and all that is not ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[ord("0") : ord("9") + 1] = True
ALPHANUMERIC[ord("a") : ord("z") + 1] = True
ALPHANUMERIC[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a slice hold about `limit` bytes, one row at least."""
    _, offsets = buffer_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def spans(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and per text the index of its first word."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = marks[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # texts that hold anything
    first[edges] = inside[edges]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power(base: np.uint64, size: int) -> np.ndarray:
    if len(_powers.get(int(base), ())) < size:
        steps = np.full(max(size, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[int(base)] = np.cumprod(steps)
    return _powers[int(base)][:size]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """A 64-bit hash of every span, by differences of one running sum per slice."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        begin = int(starts[at])
        to = max(int(np.searchsorted(ends, begin + SLICE_BYTES, "right")), at + 1)
        part = data[begin : int(ends[to - 1])]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(base, len(part)), out=total[1:])
        a, b = starts[at:to] - begin, ends[at:to] - begin
        own = (total[b] - total[a]) * _power(inverse, len(part))[a]
        out[at:to] = mix(own + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        at = to
    return out


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words of each text, and the bounds of the texts.

    A text with fewer words, but not none, has one: the whole sequence.
    """
    counts = np.diff(bounds)
    out = np.maximum(counts - size + 1, (counts > 0).astype(np.int64))
    limits = np.concatenate(([0], np.cumsum(out)))
    total = int(limits[-1])
    if not total:
        return np.zeros(0, np.uint64), limits
    text = np.repeat(np.arange(len(counts)), out)
    at = bounds[:-1][text] + np.arange(total) - limits[:-1][text]
    value = np.zeros(total, np.uint64)
    end = bounds[1:][text]
    for k in range(size):
        where = at + k
        here = where < end
        value = value * _BASE + np.where(here, words[np.minimum(where, len(words) - 1)], np.uint64(k))
    return mix(value), limits
