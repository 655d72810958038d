"""Keyword ranking inside one row.

A document's words are all in its own row, so counting them needs no shuffle:
sort the words, read the run lengths, and keep the longest runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let


def without_words(tokens: Column, words: Sequence[str]) -> Column:
    """Tokens that are neither empty nor in `words`, tested by one hash set."""
    excluded = ["", *sorted(set(words) - {""})]
    return F.filter(tokens, lambda t: ~t.isin(excluded))


def frequent_tokens(
    tokens: Column, k: int | None = 10, min_count: int = 3
) -> Column:
    """The `k` most frequent tokens seen at least `min_count` times, best first.

    Ties go to the token that appears first. Elements are
    `struct<token, n, seen>`, `seen` being the first position. Empty for null.
    """
    reach = min_count - 1

    def ranked(words: Column, ordered: Column) -> Column:
        def at(position: Column) -> Column:
            return F.get(ordered, position)

        def opens_run(token: Column, i: Column) -> Column:
            fresh = (i == 0) | (at(i - 1) != token)
            return F.when(fresh & (at(i + reach) == token), i)

        def closes_run(token: Column, i: Column) -> Column:
            done = F.coalesce(at(i + 1) != token, F.lit(True))
            return F.when(done & (i >= reach) & (at(i - reach) == token), i)

        def positions(test) -> Column:
            return F.filter(F.transform(ordered, test), lambda i: i.isNotNull())

        def joined(first: Column) -> Column:
            # Frequent tokens in order of appearance, then by name like the runs are.
            frequent = F.array_intersect(words, F.transform(first, at))
            by_name = F.sort_array(
                F.transform(
                    frequent, lambda t, i: F.struct(t.alias("token"), i.alias("seen"))
                )
            )
            lengths = F.zip_with(first, positions(closes_run), lambda a, b: a - b - 1)
            return F.zip_with(
                lengths,
                by_name,
                lambda less, t: F.struct(
                    less.alias("less"), t["seen"].alias("seen"), t["token"].alias("token")
                ),
            )

        return F.sort_array(let(positions(opens_run), joined))

    best = let(tokens, lambda w: let(F.sort_array(w), lambda s: ranked(w, s)))
    if k is not None:
        best = F.slice(best, 1, k)
    result = F.transform(
        best,
        lambda r: F.struct(
            r["token"].alias("token"), (-r["less"]).alias("n"), r["seen"].alias("seen")
        ),
    )
    empty = F.array().cast("array<struct<token:string,n:int,seen:int>>")
    return F.coalesce(result, empty)
