"""A user's own model as a weigher of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Token weights of each of several texts.
Model = Callable[[Sequence[str]], Sequence[Mapping[str, float]]]


#: Texts shown to a model at once where they come in lists.
TEXTS_AT_ONCE = 1000


class ModelWeigher:
    """A column of texts, or by `of_lists` one of lists of texts, to their vectors."""

    def __init__(self, load: Callable[[], Model]) -> None:
        @F.pandas_udf("map<string,float>")
        def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for texts in batches:
                yield pd.Series(_weighed(model, texts.tolist()), index=texts.index, dtype="object")

        @F.pandas_udf("array<map<string,float>>")
        def weigh_lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = load()
            for lists in batches:
                flat = [t for texts in lists if texts is not None for t in texts]
                found = (v for at in range(0, len(flat), TEXTS_AT_ONCE) for v in _weighed(model, flat[at : at + TEXTS_AT_ONCE]))
                rows = [None if texts is None else list(islice(found, len(texts))) for texts in lists]
                yield pd.Series(rows, index=lists.index, dtype="object")

        self.weigh, self.weigh_lists = weigh, weigh_lists.asNondeterministic()  # called once per row

    def __call__(self, text: Column) -> Column:
        return self.weigh(text)

    def of_lists(self, texts: Column) -> Column:
        return self.weigh_lists(texts)


def _weighed(model: Model, texts: Sequence[str | None]) -> list[dict[str, float] | None]:
    given = [t is not None and t == t for t in texts]
    vectors = iter(model([t for t, g in zip(texts, given, strict=True) if g]))
    return [{str(t): float(w) for t, w in next(vectors).items()} if g else None for g in given]


def model_weigher(load: Callable[[], Model]) -> ModelWeigher:
    """Weigher for `sparse_embed` that runs a model over Arrow batches of texts.

    `load` runs once in every task, before its first batch, and is where a model is
    read from files. A null text has a null vector and is not shown to the model.
    """
    return ModelWeigher(load)
