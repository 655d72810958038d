"""Code points of whole Arrow slices, with tables for case, letters and scripts."""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pyarrow as pa

#: First code points of the ranges of scripts, in order; fixed values of the
#: Unicode block list. A range lasts until the next begins.
SCRIPT_RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"),
    (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"),
    (0x1CC0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"),
    (0x2C80, "other"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x2E80, "han"), (0x3040, "kana"),
    (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x31F0, "kana"), (0x3200, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB10, "other"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"),
    (0xFF65, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x20000, "han"), (0x32000, "other"),
)
SCRIPTS = tuple(sorted({script for _, script in SCRIPT_RANGES}))


@functools.cache
def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


@functools.cache
def lower() -> np.ndarray:
    """Lower case, where that is one code point."""
    out = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for c in np.flatnonzero(letters()):
        small = chr(c).lower()
        if len(small) == 1:
            out[c] = ord(small)
    return out


@functools.cache
def scripts() -> np.ndarray:
    """Number of a code point's script in SCRIPTS."""
    firsts = np.array([first for first, _ in SCRIPT_RANGES])
    numbers = np.array([SCRIPTS.index(script) for _, script in SCRIPT_RANGES], np.uint8)
    return np.repeat(numbers, np.diff(np.append(firsts, sys.maxunicode + 1)))


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts with a line feed after each, and the bounds between them. Null counts as empty."""
    values = [t or "" for t in texts.to_pylist()]
    bounds = np.cumsum([0, *(len(t) + 1 for t in values)])
    joined = "\n".join([*values, ""]) if values else ""
    # Arrow texts hold no lone surrogates, so each code point is one number.
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), bounds
