"""Naming an intermediate value inside one expression."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once however often it is used.

    Spark shares repeated sub-expressions between columns but not inside the
    body of an array function, where most of the page rules live.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def built_once(build: Callable[..., Column]) -> Callable[..., Column]:
    """Keep the expression that `build` makes of column names: writing a long one down takes a while."""
    return functools.cache(build)


def computed_once(value: Column) -> Column:
    """`value`, which Spark copies neither into filters nor into the expressions that use it.

    An expression that depends on the row's place stays where it was written.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def arrow_function(returns: T.DataType) -> Callable:
    """A pandas UDF that Spark calls once per row, where it was written.

    Plain UDFs are pushed into filters and copied into every expression that
    uses their result; each copy would run the function over the pages again.
    """

    def wrap(function: Callable) -> Callable:
        return F.pandas_udf(returns)(function).asNondeterministic()

    return wrap
