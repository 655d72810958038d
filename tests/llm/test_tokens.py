"""Packed ids: round trips, and the tokenizer's own result."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from articlelake.llm import tokens


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**64 - 1)), max_size=300))
def test_round_trip(values):
    ids = np.array(values, np.uint64)
    assert (tokens.unpack(tokens.pack(ids)) == ids).all()


@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 4097, 20000])
def test_stretches(n):
    ids = np.random.default_rng(n).integers(0, 50000, n).astype(np.uint64)
    ids[::7] = 1
    payload = tokens.pack(ids)
    assert (tokens.unpack(payload) == ids).all()
    for k in range(-(-n // tokens.STRETCH)):
        assert (tokens.unpack(payload, k) == ids[k * tokens.STRETCH : (k + 1) * tokens.STRETCH]).all()
    bounds = np.array([0, n // 3, n // 3, n])
    for payload, a, b in zip(tokens.pack_blocks(ids, bounds), bounds, bounds[1:], strict=False):
        assert (tokens.unpack(payload) == ids[a:b]).all()


def test_documents(spark, odd, odd_rows, none):
    tokenizer = Tokenizer.from_file(tokens.word_tokenizer())
    order = sorted(odd_rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for row in order:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2]
        want.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    folder = tokens.write_ids(odd, block_ids=500)
    got = sorted((tuple(r) for r in tokens.read_back(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    lists = sorted((r["doc_id"] is None, r["doc_id"] or 0, list(r["ids"])) for r in tokens.decode(spark, folder).collect())
    assert sum(len(x[2]) for x in lists) == start
    assert tokens.read_back(spark, tokens.write_ids(none)).isEmpty()


def test_pieces_of_one_hash(monkeypatch, docs):
    texts = [r["text"] for r in docs.limit(20).collect()]
    import pyarrow as pa

    encoder = tokens.Encoder(tokens.word_tokenizer())
    plain, limits = encoder.encode(pa.array(texts))
    monkeypatch.setattr(tokens, "hashes", lambda d, s, e, *base: (e - s if not base else s).astype(np.uint64))
    again, same = encoder.encode(pa.array(texts))
    assert (plain == again).all() and (limits == same).all()


@pytest.mark.parametrize("beside", ["", "<|"])
def test_capitals_with_marks(beside):
    """Some small letters compose with a mark that their capitals do not compose with."""
    import unicodedata

    import pyarrow as pa

    marks = [chr(c) for c in range(0x300, 0x370) if unicodedata.combining(chr(c))]
    words = [f"{start}{chr(c)}{mark}{end}" for c in range(65, 91) for mark in marks for start, end in (("", ""), ("A", "B."))]
    texts = [f"Plain {w} WORDS {w}" for w in words] + [beside]
    ids, limits = tokens.Encoder(tokens.word_tokenizer()).encode(pa.array(texts))
    library = Tokenizer.from_file(tokens.word_tokenizer())
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(limits, limits[1:], strict=False)] == want


def test_remembered_pieces_are_small():
    """A worker keeps no texts of the pieces that it has met."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    texts = ["".join(chr(97 + c) for c in row) + "." for row in rng.integers(0, 26, (40_000, 9))]
    encoder = tokens.Encoder(tokens.word_tokenizer())
    batches = [pa.array([" ".join(texts[i : i + 2000])]) for i in range(0, len(texts), 2000)]
    encoder.encode(pa.array(["warm up"]))
    tracemalloc.start()
    for batch in batches:
        encoder.encode(batch)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 200 * len(texts)


def test_marks_and_letters_apart():
    import pyarrow as pa

    texts = ["Élan élan× naïve, word. word.. WORD ... #a a# \"#", "÷ ×, ÿ. ç.C Ã, x", None, "word, ... élan. <|endoftext|>."]
    ids, limits = tokens.Encoder(tokens.word_tokenizer()).encode(pa.array(texts))
    library = Tokenizer.from_file(tokens.word_tokenizer())
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(limits, limits[1:], strict=False)] == want


def test_small_accented_letters_take_the_short_way(monkeypatch):
    """Words of a to z and ß to ÿ have the library's ids without its regular expression and normaliser."""
    import pyarrow as pa

    letters = [chr(c) for c in [*range(97, 123), *range(0xDF, 0x100)] if c != 0xF7]
    rng = np.random.default_rng(2)
    words = [*letters, *["".join(rng.choice(letters, n)) for n in rng.integers(1, 24, 3000)], "".join(letters)]
    encoder = tokens.Encoder(tokens.word_tokenizer())
    whole, ids_of = [], tokens._ids
    monkeypatch.setattr(tokens, "_ids", lambda t, texts: (whole.extend(texts) if t is encoder.tokenizer else None, ids_of(t, texts))[1])
    ids, _ = encoder.encode(pa.array([" ".join(words)]))
    assert ids.tolist() == Tokenizer.from_file(tokens.word_tokenizer()).encode(" ".join(words), add_special_tokens=False).ids
    assert whole == []


def test_short_pieces_need_no_powers(monkeypatch):
    """Pieces of up to 256 bytes are told apart by their bytes; no table of powers, 67 MB in each worker, is made."""
    import pyarrow as pa

    from articlelake.llm import words

    monkeypatch.setattr(words, "_powers", {})
    encoder = tokens.Encoder(tokens.word_tokenizer())
    texts = ["a ab abcdefgh abcdefghi abcdefghijklmnop bcdefghijklmnop \0 \0\0 a\0 a\0\0 abcdefgh\0 \0a", None, "", "a"]
    library = Tokenizer.from_file(tokens.word_tokenizer())
    ends = ["x" * n + c for n in (15, 16, 17, 23, 24, 25, 31, 32, 33, 255) for c in "ab\0"]
    texts.append(" ".join(["abcdefghijklmnopq abcdefghijklmnopq\0 abcdefghijklmnop\0", *ends]))
    for some in (texts, [*texts, " ".join(end * n for n in (256, 300) for end in "xy")]):
        ids, limits = encoder.encode(pa.array(some))
        want = [library.encode(t or "", add_special_tokens=False).ids for t in some]
        assert [ids[a:b].tolist() for a, b in zip(limits, limits[1:], strict=False)] == want
        assert bool(words._powers) == (some is not texts)


def test_keys_of_all_pieces_alike(monkeypatch, docs):
    import pyarrow as pa

    texts = [r["text"] for r in docs.limit(20).collect()]
    plain, limits = tokens.Encoder(tokens.word_tokenizer()).encode(pa.array(texts))
    monkeypatch.setattr(tokens, "_keys", lambda d, s, e: ((e - s).astype(np.uint64), s.astype(np.uint64)))
    again, same = tokens.Encoder(tokens.word_tokenizer()).encode(pa.array(texts))
    assert (plain == again).all() and (limits == same).all()
