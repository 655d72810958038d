"""Text cleaning and tokenizing.

Everything is a built-in expression except the NFKD step, which Spark lacks:
that one runs as an Arrow function, and rows of plain ASCII send it a null.
"""

from __future__ import annotations

import functools
import operator
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .binding import arrow_function

# The dash code points that count as "-".
DASHES = (
    "\u002d\u058a\u05be\u2010\u2011\u2012\u2013\u2014\u2015\u2e3a\u2e3b\ufe58\ufe63\uff0d"
)

# Java's Unicode white space lacks the four separators U+001C..U+001F.
_RARE_SPACE = r"[\x1c-\x1f]"
# Without these, some steps of cutting a text into words change nothing.
_RARE_MARKS = "'\u2019{\u201c\"()"
_MARKS = r"[,.\"'/\\:-]"


@arrow_function(T.StringType())
def _nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKD", t), na_action="ignore")


@arrow_function(T.ArrayType(T.StringType()))
def _nfkd_all(lists: pd.Series) -> pd.Series:
    def one(texts):
        return [t if t is None else unicodedata.normalize("NFKD", t) for t in texts]

    return lists.map(one, na_action="ignore")


_WIDE = r"[^\x00-\x7F]"


def _flat(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def _one_line(text: Column) -> Column:
    return F.translate(text, "\n" + DASHES, " " + "-" * len(DASHES))


def clean_text(text: Column) -> Column:
    """Compatibility form, one line, plain dashes."""
    wide = text.rlike(_WIDE)
    normal = _nfkd(F.when(wide, text))
    return F.when(wide, _one_line(normal)).otherwise(_flat(text))


def clean_texts(texts: Column) -> Column:
    """`clean_text` for each string of an array column."""
    wide = F.exists(texts, lambda t: t.rlike(_WIDE))
    normal = _nfkd_all(F.when(wide, texts))
    return F.when(wide, F.transform(normal, _one_line)).otherwise(
        F.transform(texts, _flat)
    )


def tokenize(text: Column) -> Column:
    """Lower-case words of cleaned text; empty strings may remain between spaces."""
    return F.split(spaced_words(text), " ")


def spaced_words(text: Column) -> Column:
    """The words of `tokenize` as one string, in which they lie between spaces."""
    usual = _spaced_words(text, r"\s", r"\S")
    exact = _spaced_words(text, r"[\s\x1c-\x1f]", r"[^\s\x1c-\x1f]")
    plain = _spaced_words(text, r"\s")
    marked = functools.reduce(operator.or_, [F.contains(text, F.lit(m)) for m in _RARE_MARKS])
    return F.when(text.rlike(_RARE_SPACE), exact).when(marked, usual).otherwise(plain)


def _spaced_words(text: Column, space: str, ink: str | None = None) -> Column:
    """Without `ink`, `text` has nothing of `_RARE_MARKS`, and the steps that would find nothing are left out."""
    if ink is not None:
        text = F.regexp_replace(text, f"(?U)['\u2019]{ink}*", "")
    # The look-behind tries each run of marks once, so long rules stay linear.
    edge = f"(?U){space}{_MARKS}+|{_MARKS}(?<!{_MARKS}{{2}}){_MARKS}*+{space}"
    text = F.regexp_replace(text, edge, " ")
    if ink is not None:
        text = F.regexp_replace(text, r"(?d)\{.*\}", "")
        text = F.regexp_replace(text, "[\u201c\"()]", " ")
    text = F.regexp_replace(text, f"(?U){space}[^a-zA-Z]*{space}", " ")
    return F.lower(text)
