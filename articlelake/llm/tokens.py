"""Token ids in word-aligned binary blocks, written and read by Spark.

Ids are packed by a selector-and-payload scheme: the low four bits of every
64-bit word say how many ids the other sixty hold and how wide each is. An id
that sixty bits cannot hold goes to a list of escapes, and the word holds its
place there. Every 4,096 ids begin a new word, whose number is stored, so any
stretch can be decoded on its own and all words of one selector at once.

A file is Parquet with one row per block of whole documents:

    part, seq     place of the block in ascending id order
    before        ids of this part in front of the block
    doc_ids, at   the documents and where each begins in the block
    payload       b"S8B1", four uint32: ids, stretches, words, escapes;
                  then uint32 per stretch: its first word; uint64 words; uint64 escapes
"""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from articlelake.llm.common import fresh_folder, name, small_batches
from articlelake.llm.words import BETWEEN_BLANKS, LOWER, SECOND, buffer_of, hashes, mix, slices, spans

#: Ids per word of 60 bits for selectors 1 to 14; selector 15 is an escape.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ESCAPE = 15
STRETCH = 4096
BLOCK_IDS = 1 << 16
SLICE_BYTES = 2 << 20
END_ID = 2
MAGIC = b"S8B1"
#: Word pieces remembered by a worker before it starts anew.
REMEMBERED = 1_500_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_SMALL = _LETTER & (np.arange(256) >= ord("a"))
#: Small letters from ß to ÿ, which the tokenizer's normaliser leaves as they are.
_ACCENTED = "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
#: By length, the bits of eight bytes that belong to a span.
_HELD = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Never join a letter's piece.
_MARK = np.zeros(256, bool)
_MARK[list(b'.,;:!?|"#')] = True
FILE_SCHEMA = "part int, seq int, before long, doc_ids array<long>, at array<long>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """Encode unsigned 64-bit ids as one block."""
    return pack_blocks(ids, np.array([0, len(ids)]))[0]


def pack_blocks(ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Encode several blocks, ids[bounds[i]:bounds[i + 1]] each, all stretches side by side."""
    ids, n = np.asarray(ids, np.uint64), int(bounds[-1])
    stretches = -(-np.diff(bounds) // STRETCH)
    block = np.repeat(np.arange(len(stretches)), stretches)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    starts = (bounds[:-1][block] + nth * STRETCH).astype(np.int32)
    ends = np.minimum(starts + STRETCH, bounds[1:][block]).astype(np.int32)
    left = np.repeat(ends, ends - starts) - np.arange(n, dtype=np.int32)  # a word ends with its stretch
    values, escaped = ids, np.flatnonzero(ids >> np.uint64(60))
    if len(escaped):
        near = np.full(n, n, np.int32)
        near[escaped] = escaped
        left = np.minimum(left, np.minimum.accumulate(near[::-1])[::-1] - np.arange(n, dtype=np.int32))
        values = ids.copy()
        values[escaped] = np.arange(len(escaped)) - np.searchsorted(escaped, bounds)[np.searchsorted(bounds, escaped, "right") - 1]
    count, selector = np.ones(n, np.int32), np.full(n, len(COUNTS), np.uint8)
    largest = values.astype(np.uint32) if n and values.max() < 1 << 32 else values.copy()
    for c in range(2, COUNTS[0] + 1):  # largest[i] becomes that of ids i to i + c - 1
        np.maximum(largest[: n - c + 1], largest[1 : n - c + 2], out=largest[: n - c + 1])
        if c in COUNTS:
            fits = (largest < min(1 << (60 // c), 1 << 31)) & (left >= c)
            if not fits.any():
                break
            np.putmask(count, fits, c)
            np.putmask(selector, fits, COUNTS.index(c) + 1)
    selector[escaped], count[escaped] = ESCAPE, 1
    then, at, stop, heads = np.arange(n, dtype=np.int32) + count, starts, ends, []
    while len(at):
        heads.append(at)
        at = then[at]
        more = at < stop
        at, stop = at[more], stop[more]
    heads = np.sort(np.concatenate([np.zeros(0, np.int32), *heads]))
    chosen = selector[heads]
    words = chosen.astype(np.uint64)
    for s in np.flatnonzero(np.bincount(chosen)):
        here = np.flatnonzero(chosen == s)
        c = 1 if s == ESCAPE else COUNTS[s - 1]
        from_, word = heads[here], words[here]
        for k in range(c):
            word |= values[from_ + k] << np.uint64(4 + k * (60 // c))
        words[here] = word
    cuts, firsts = np.searchsorted(heads, bounds), np.searchsorted(heads, starts)
    out, rows = [], np.cumsum([0, *stretches])
    extra = np.searchsorted(escaped, bounds)
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        escapes = ids[escaped[extra[i] : extra[i + 1]]]
        own = firsts[rows[i] : rows[i + 1]] - a
        head = MAGIC + struct.pack("<4I", bounds[i + 1] - bounds[i], len(own), b - a, len(escapes))
        out.append(head + own.astype("<u4").tobytes() + words[a:b].astype("<u8").tobytes() + escapes.astype("<u8").tobytes())
    return out


def unpack(payload: bytes, stretch: int | None = None) -> np.ndarray:
    """Decode a block, or only one of its stretches of 4,096 ids."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block of packed ids")
    n, stretches, size, extra = struct.unpack_from("<4I", payload, 4)
    firsts = np.frombuffer(payload, "<u4", stretches, 20)
    words = np.frombuffer(payload, "<u8", size, 20 + 4 * stretches)
    escapes = np.frombuffer(payload, "<u8", extra, 20 + 4 * stretches + 8 * size)
    if stretch is not None:
        words = words[firsts[stretch] : firsts[stretch + 1] if stretch + 1 < stretches else size]
        n = min(STRETCH, n - stretch * STRETCH)
    selector = (words & np.uint64(15)).astype(np.int64)
    sizes = np.array([0, *COUNTS, 1], np.int64)
    counts = sizes[selector]
    starts = np.cumsum(counts) - counts
    out = np.empty(n, np.uint64)
    for s in np.unique(selector):
        here = np.flatnonzero(selector == s)
        c = int(sizes[s])
        width = 60 // c
        for k in range(c):
            value = words[here] >> np.uint64(4 + k * width) & np.uint64((1 << width) - 1)
            out[starts[here] + k] = escapes[value.astype(np.int64)] if s == ESCAPE else value
    return out


def _lower_ascii(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Lower-case the words that are pure ASCII. The tokenizer composes characters before it
    lower-cases, and some small letters have composed forms that their capitals have not."""
    high = np.flatnonzero(data >= 0x80)
    out = LOWER[data]
    if len(high):
        held = np.searchsorted(starts, high, "right") - 1  # all such bytes are within words
        held = held[np.append(True, held[1:] != held[:-1])]
        lengths = ends[held] - starts[held]
        shift = starts[held] - (np.cumsum(lengths) - lengths)
        at = np.repeat(shift, lengths) + np.arange(int(lengths.sum()))
        out[at] = data[at]
    return out


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of some spans in a row, and the spans there."""
    lengths = ends - starts
    to = np.cumsum(lengths)
    at = np.repeat(starts - (to - lengths), lengths) + np.arange(int(lengths.sum()))
    return data[at], to - lengths, to


def _plain_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the marks at the end of each span begin, and whether all before them, which is
    something, are letters of the first 256 characters."""
    core, at = ends.copy(), np.arange(len(ends))
    while len(at):
        at = at[core[at] > starts[at]]
        at = at[_MARK[data[core[at] - 1]]]
        core[at] -= 1
    # From À to ÿ the first byte is C3; × and ÷ are no letters.
    lead = data == 0xC3
    good = _LETTER[data] | lead
    good[1:] |= lead[:-1] & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return core, (core > starts) & ~_any_not(good, starts, core)


def _any_not(good: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each span holds a byte that is not good."""
    bad = np.append(0, np.cumsum(~good, dtype=np.int32))
    return bad[ends] > bad[starts]


#: Longer pieces are hashed by `hashes`, whose tables take 67 MB of each worker.
_WIDE = 256


def _keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every span: of up to 256 bytes from those, eight as one number, else as `hashes` has them."""
    room = np.append(data, np.zeros(16, np.uint8))
    eight = np.ndarray(len(data) + 9, "<u8", room, 0, (1,))  # the eight bytes from each place on
    size = ends - starts
    low = eight[starts] & _HELD[np.minimum(size, 8)]
    high = eight[np.minimum(starts + 8, len(data))] & _HELD[np.clip(size - 8, 0, 8)]
    first = mix(mix(low) + high * SECOND + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    second = mix(high + np.uint64(0x632BE59BD9B4E019)) + low * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64)
    at, more = 16, np.flatnonzero((size > 16) & (size <= _WIDE))
    while len(more):
        part = eight[starts[more] + at] & _HELD[np.minimum(size[more] - at, 8)]
        first[more], second[more] = mix(first[more] + part * SECOND), mix(second[more] ^ part)
        at, more = at + 8, more[size[more] > at + 8]
    wide = np.flatnonzero(size > _WIDE)
    if len(wide):
        part = _gathered(data, starts[wide], ends[wide])
        first[wide], second[wide] = hashes(*part), hashes(*part, SECOND)
    return first, second


def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Encoder:
    """`encode` of the tokenizers library, remembering the pieces between blanks.

    For a tokenizer that cuts texts at white space and normalises by character,
    as this one does, the ids of a text are those of its pieces in a row.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.letters = self._for_letters()
        self.accented = self._for_accented()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self._forget()

    def _for_letters(self):
        """The same model for words of a to z, without the steps that leave those as they are."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        letters, normal, cut = string.ascii_lowercase, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is not None and normal.normalize_str(letters) != letters:
            return self.tokenizer
        if cut is None or [piece for piece, _ in cut.pre_tokenize_str(letters)] != [letters]:
            return self.tokenizer
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = WhitespaceSplit()
        return bare

    def _for_accented(self):
        """The same for words of a to z and ß to ÿ, with the step that writes bytes as characters."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        letters, normal, cut = string.ascii_lowercase + _ACCENTED, self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        if normal is not None and normal.normalize_str(letters) != letters:
            return self.tokenizer
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        pieces = [piece for piece, _ in bare.pre_tokenizer.pre_tokenize_str(letters)]
        if cut is None or [piece for piece, _ in cut.pre_tokenize_str(letters)] != pieces:
            return self.tokenizer
        return bare

    def _forget(self) -> None:
        self.count, self.start, self.length = 0, np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0
        # Pieces seen, by hash in order, with their place among the kept; by place, a second hash.
        self.seen, self.found, self.proof = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(1 << 16, np.uint64)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return _ids(self.tokenizer, texts)

    def _keep(self, ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Keep runs of ids; returns their places."""
        at, to = self.count, self.count + len(starts)
        while to > len(self.start):
            self.start, self.length = np.append(self.start, self.start), np.append(self.length, self.length)
            self.proof = np.append(self.proof, self.proof)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, self.flat)
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[at:to], self.length[at:to] = starts + self.used, lengths
        self.used, self.count = self.used + len(ids), to
        return np.arange(at, to)

    def _encoded(self, pieces: list[str], joined=None) -> np.ndarray:
        """Places of pieces that the tokenizer encodes; words of letters many at once, by `joined`."""
        places = [np.zeros(0, np.int32)]
        for at in range(0, len(pieces), 1000):
            some = pieces[at : at + 1000]
            if joined is not None:
                # The last id of a word of letters is one that ends words.
                ids = np.array(_ids(joined, [" ".join(some)])[0], np.int64)
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) == len(some):
                    starts = np.append(0, ends[:-1])
                    places.append(self._keep(ids, starts, ends - starts))
                    continue
            lists = self._plain(some)
            lengths = np.array([len(x) for x in lists], np.int64)
            ids = np.array([i for x in lists for i in x], np.uint32)
            places.append(self._keep(ids, np.cumsum(lengths) - lengths, lengths))
        return np.concatenate(places)

    def _remember(self, values: np.ndarray, proof: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(values)
        at = np.searchsorted(self.seen, values[order])
        self.seen = np.insert(self.seen, at, values[order])
        self.found = np.insert(self.found, at, places[order])
        self.proof[places] = proof

    def _places(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray | None:
        """Where the ids of each span are kept, those of new pieces too; None if two pieces have one hash.

        Of a plain word the marks after it, which the tokenizer makes a piece of their
        own, are learnt apart.
        """
        keys, second = _keys(data, starts, ends)
        which, values = pd.factorize(keys)
        first = np.empty(len(values), np.int64)
        first[which] = np.arange(len(which))  # any of a piece's places will do
        proof = second[first]
        order, at = np.argsort(values), np.empty(len(values), np.int64)
        at[order] = np.searchsorted(self.seen, values[order])
        known = np.zeros(len(values), bool)
        inside = at < len(self.seen)
        known[inside] = self.seen[at[inside]] == values[inside]
        places = np.empty(len(values), np.int32)
        places[known] = self.found[at[known]]
        if (second != proof[which]).any() or (self.proof[places[known]] != proof[known]).any():
            return None
        new = np.flatnonzero(~known)
        if len(new):
            new = new[np.argsort(first[new])]  # spans in the order of the data
            data, begin, end = _gathered(data, starts[first[new]], ends[first[new]])
            core, plain = _plain_words(data, begin, end)
            marked = plain & (core < end)
            small = plain & ~_any_not(_SMALL[data], begin, end)
            # Of À to ÿ the small letters' second byte is 9F at least; the first is C3.
            accented = plain & ~marked & ~small & ~_any_not(_SMALL[data] | (data >= 0x9F), begin, end)
            rest = plain & ~marked & ~small & ~accented
            raw = data.tobytes()
            kinds = ((small, self.letters), (accented, self.accented), (rest, self.tokenizer), (~plain, None))
            for kind, joined in kinds:
                here = new[kind]
                pieces = [raw[a:b].decode() for a, b in zip(begin[kind].tolist(), end[kind].tolist(), strict=True)]
                places[here] = self._encoded(pieces, joined)
            here = new[~marked]
            self._remember(values[here], proof[here], places[here])
            if marked.any():
                words = self._places(*_gathered(data, begin[marked], core[marked]))
                marks = self._places(*_gathered(data, core[marked], end[marked]))
                if words is None or marks is None:
                    return None
                both = np.stack([words, marks])
                lengths = self.length[both].sum(axis=0, dtype=np.int64)
                here = new[marked]
                places[here] = self._keep(self._ids_at(both.T.ravel()), np.cumsum(lengths) - lengths, lengths)
                self._remember(values[here], proof[here], places[here])
        return places[which]

    def _ids_at(self, places: np.ndarray) -> np.ndarray:
        lengths = self.length[places]
        shift = (self.start[places] - (np.cumsum(lengths, dtype=np.int64) - lengths)).astype(np.int32)
        return self.flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()), dtype=np.int32)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the bounds between the texts."""
        data, offsets = buffer_of(texts)
        starts, ends, bounds = spans(data, offsets, BETWEEN_BLANKS)
        if b"<|" not in data.tobytes():  # special tokens are known by their case
            data = _lower_ascii(data, starts, ends)
        if self.count > REMEMBERED:
            self._forget()
        places = self._places(data, starts, ends)
        if places is None:
            lists = self._plain(texts.fill_null("").to_pylist())
            limits = np.cumsum([0, *map(len, lists)])
            return np.array([i for x in lists for i in x], np.uint32), limits
        limits = np.append(0, np.cumsum(self.length[places], dtype=np.int64))
        return self._ids_at(places), limits[bounds]


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_encoders: dict[str, Encoder] = {}


def _encoder(path: Callable[[], str] | str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = path() if callable(path) else path
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_KINDS = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("before", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("at", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def _blocks(path, end_id: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, before, held = TaskContext.get().partitionId(), 0, 0, 0
        keys: list = []
        sizes: list[int] = []
        rest: list[np.ndarray] = []
        closed: list[tuple] = []
        encoder = _encoder(path)

        def close() -> None:
            nonlocal seq, before, held
            at = (np.cumsum(sizes) - sizes).tolist()
            closed.append((part, seq, before, list(keys), at, held))
            seq, before, held = seq + 1, before + held, 0
            keys.clear()
            sizes.clear()

        def packed() -> pa.RecordBatch:
            """The blocks that are full; ids of one that is not stay."""
            ids = np.concatenate(rest)
            bounds = np.cumsum([0, *(row[-1] for row in closed)])
            rest[:] = [ids[bounds[-1] :]]
            rows = [(*row[:-1], data) for row, data in zip(closed, pack_blocks(ids[: bounds[-1]], bounds), strict=True)]
            closed.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*rows, strict=True), _KINDS.types, strict=True)], schema=_KINDS
            )

        for batch in batches:
            for some in slices(batch, "text", SLICE_BYTES):
                flat, limits = encoder.encode(some.column("text"))
                rest.append(np.insert(flat, limits[1:], np.uint32(end_id)))
                for doc, size in zip(some.column("doc_id").to_pylist(), (np.diff(limits) + 1).tolist(), strict=True):
                    keys.append(doc)
                    sizes.append(size)
                    held += size
                    if held >= block_ids:
                        close()
                if closed:
                    yield packed()
        if keys:
            close()
            yield packed()

    return run


def write_ids(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: Callable[[], str] | str = word_tokenizer,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    folder: str | None = None,
) -> str:
    """Encode every whole text in ascending order of id and write the blocks; returns the folder.

    A null text counts as empty, which is the end id alone. Rows of equal id
    follow each other by text; null ids come last. `path` is the tokenizer's
    file, or a function that finds it on the machine that encodes. An empty
    table leaves a folder without blocks. A text is never cut: a very long one makes its block
    longer. Other columns are not looked at.
    """
    small_batches(docs.sparkSession)
    folder = folder or fresh_folder(docs.sparkSession, "token-ids")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    rows = docs.select(name(key).cast("long").alias("doc_id"), F.coalesce(name(text), F.lit("")).alias("text"))
    ranges = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)
    ranges.mapInArrow(_blocks(path, end_id, block_ids), FILE_SCHEMA).write.parquet(folder)
    return folder


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"]).astype("<u4")
            ends = [*row["at"][1:], len(ids)]
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(row["at"], ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["part"]] * len(sums), pa.int32()),
                    pa.array([row["before"] + a for a in row["at"]], pa.int64()),
                    pa.array([b - a for a, b in zip(row["at"], ends, strict=True)], pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "part", "local", "n_tokens", "ids_crc32"],
            )


def read_back(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32.

    A folder without blocks gives no rows; repeated and null ids have a row each time they were written.
    """
    stored = spark.read.schema(FILE_SCHEMA).parquet(folder)
    # One row per part of the files: where each begins in the whole.
    sizes = stored.select("part", (F.col("before") + _n_ids(F.col("payload"))).alias("end"))
    sizes = sizes.groupBy("part").agg(F.max("end").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    found = stored.mapInArrow(_checks, "doc_id long, part int, local long, n_tokens long, ids_crc32 long")
    return found.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def _n_ids(payload):
    """The id count in a block's head, four bytes, low byte first."""
    digits = F.hex(F.substring(payload, 5, 4))
    pairs = [F.substring(digits, k, 2) for k in (7, 5, 3, 1)]
    return F.conv(F.concat(*pairs), 16, 10).cast("long")


def decode(spark: SparkSession, folder: str) -> DataFrame:
    """The ids themselves: (doc_id, ids), in no order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"]).astype(np.int64)
                lists = pa.ListArray.from_arrays(pa.array([*row["at"], len(ids)], pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), lists], ["doc_id", "ids"])

    stored = spark.read.schema(FILE_SCHEMA).parquet(folder)
    return stored.select("doc_ids", "at", "payload").mapInArrow(run, "doc_id long, ids array<long>")
