"""Presence checks and changes to a stored corpus, as joins.

The stored side may be any size, so it is never collected or broadcast and,
when the batch is measured small, never shuffled either.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import article_id
from ..session import broadcast_if_bounded, fits_broadcast, scratch_dir


# ------------------------------------------------------------------------ presence


def already_stored(batch: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Batch rows whose key is in the store."""
    return batch.join(_stored_keys(batch, store, key), key, "left_semi")


def not_stored(batch: DataFrame, store: DataFrame, key: str = "url") -> DataFrame:
    """Batch rows whose key is not in the store."""
    return batch.join(_stored_keys(batch, store, key), key, "left_anti")


def _stored_keys(batch: DataFrame, store: DataFrame, key: str) -> DataFrame:
    """The batch's keys that are in the store, found by looking at keys alone.

    Batch rows may carry whole pages, so they are kept out of the search. A
    small batch is sent to the store's key column, which is then read in place;
    what comes back is no longer than the batch. For a large one the keys of
    both sides are shuffled, and the rows themselves move only if the keys
    found are too many to broadcast.
    """
    keys, stored = batch.select(key), store.select(key)
    if fits_broadcast(keys):
        return F.broadcast(stored.join(F.broadcast(keys), key, "left_semi").distinct())
    return broadcast_if_bounded(stored.join(keys, key, "left_semi").distinct())


def new_articles(
    batch: DataFrame, store: DataFrame, order: Sequence[str] = ("inserted_at",)
) -> tuple[DataFrame, DataFrame]:
    """Rows of an import that are not stored yet, one per url, and its rejects."""
    rejected = batch.filter("url is null").withColumn("reason", F.lit("no url"))
    usable = latest_per_key(batch.filter("url is not null"), "url", order)
    return not_stored(usable, store), rejected


# --------------------------------------------------------------------------- saving


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last write per key: the row greatest in `order`.

    Spark keeps one row per key in each task before the shuffle, so a key that
    repeats endlessly costs no more than any other.
    """
    newest = W.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return (
        df.withColumn("__nth", F.row_number().over(newest))
        .filter("__nth = 1")
        .drop("__nth")
    )


def upsert(
    store: DataFrame,
    batch: DataFrame,
    key: str = "id",
    order: Sequence[str] = ("inserted_at",),
) -> DataFrame:
    """Store with each batch row saved over the row of the same key."""
    latest = latest_per_key(batch, key, order)
    kept = delete_by_id(store, batch, key)
    return kept.unionByName(latest, allowMissingColumns=True)


def last_written(
    batch: DataFrame, key: str, fields: Mapping[str, Column], order: Sequence[str]
) -> DataFrame:
    """`(key, fields...)` with each key's values from its row greatest in `order`.

    Values may be of any type, maps included: only `order` is compared. Combined in each task before the shuffle. Rows that are equal in
    `order` are told apart by a hash of their values, so a job gives the same result twice.
    """
    if not order:
        raise ValueError("say by `order` which of several rows of a key counts")
    hashed = {f: F.xxhash64(F.to_json(F.struct(c.alias("v")))) for f, c in fields.items()}
    by = F.struct(*[_nulls_first(c) for c in order], *hashed.values())
    values = F.struct(*[c.alias(f) for f, c in fields.items()])
    last = batch.groupBy(F.col(key)).agg(F.max_by(values, by).alias("__last"))
    return last.select(key, *[F.col("__last")[f].alias(f) for f in fields])


def _nulls_first(column: str) -> Column:
    """Null is the least value; structs that hold it compare as such."""
    return F.struct(F.col(column).isNotNull(), F.col(column))


def update_fields(
    store: DataFrame,
    batch: DataFrame,
    fields: Sequence[str],
    key: str = "id",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Store with only `fields` taken from the batch row of the same key.

    A null in the batch is a value. Keys the store lacks are ignored. `order` names the
    batch's columns by which the last of several rows of a key is known; without it
    a batch with a repeated key is an error, raised where the repeat is met.
    """
    if order is None:
        fresh = batch.groupBy(F.col(key)).agg(
            F.count(F.lit(1)).alias("__times"), F.first(F.struct(*fields)).alias("__new")
        )
        complaint = F.concat(F.lit("no order for the rows of key "), F.col(key).cast("string"))
        once = F.when(F.col("__times") > 1, F.raise_error(complaint).cast("boolean")).otherwise(True)
        fresh = fresh.select(key, "__new", once.alias("__hit"))
    else:
        last = last_written(batch, key, {f: F.col(f) for f in fields}, order)
        fresh = last.select(key, F.struct(*fields).alias("__new"), F.lit(True).alias("__hit"))
    if fits_broadcast(batch.select(key, *fields)):
        fresh = F.broadcast(fresh)
    changes = {
        f: F.when(F.col("__hit"), F.col("__new")[f]).otherwise(F.col(f)) for f in fields
    }
    return store.join(fresh, key, "left").withColumns(changes).select(*store.columns)


def delete_by_id(store: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Store without the given keys.

    A long list of keys is first reduced to those the store has, by keys alone:
    for a batch of mostly new articles few remain, and the store stays in place.
    Keys may come of whole files that have to be read for them, and are looked at
    several times: each is worked out once and written.
    """
    keys = _written(ids.select(key), "keys")
    if fits_broadcast(keys):
        gone = F.broadcast(keys)
    else:
        held = store.select(key).join(keys, key, "left_semi").distinct()
        gone = broadcast_if_bounded(_written(held, "held"))
    return store.join(gone, key, "left_anti")


def _written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rekey(store: DataFrame, order: Sequence[str] = ("inserted_at",)) -> DataFrame:
    """Give every article the md5 of its url as id.

    A moved article replaces whatever holds its new id, and never vanishes
    because its old id happened to be another's new one.
    """
    wanted = article_id(F.col("url"))
    moving = F.col("url").isNotNull() & ~F.col("id").eqNullSafe(wanted)
    moved = store.filter(moving).withColumn("__old", F.col("id")).withColumn("id", wanted)
    moved = latest_per_key(moved, "id", [*order, "__old"]).drop("__old")
    kept = store.filter(~moving)
    landed = store.filter(moving).select(wanted.alias("id"))
    return delete_by_id(kept, landed).unionByName(moved)


def copy_fields(
    source: DataFrame,
    target: DataFrame,
    fields: Sequence[str],
    key: str = "url",
    order: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Carry `fields` to the target's rows of the same url; report urls it lacks.

    `order` as in `update_fields`.
    """
    absent = not_stored(source.select(key), target, key).distinct()
    return update_fields(target, source, fields, key, order), absent


# --------------------------------------------------------------------------- shape


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns and struct members `schema` has and `df` lacks, as nulls."""
    columns = []
    for field in schema:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            have = df.schema[field.name].dataType
            columns.append(
                _aligned(F.col(f"`{field.name}`"), have, field.dataType).alias(field.name)
            )
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.fieldNames()]
    return df.select(*columns, *extra)


def _aligned(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        inner = {f.name: f.dataType for f in have}
        members = [
            _aligned(value[f.name], inner[f.name], f.dataType).alias(f.name)
            if f.name in inner
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in want
        ]
        members += [value[n].alias(n) for n in inner if n not in want.fieldNames()]
        return F.when(value.isNotNull(), F.struct(*members))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(
            value, lambda v: _aligned(v, have.elementType, want.elementType)
        )
    return value.cast(want)
