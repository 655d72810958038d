"""Toxic texts by subword embeddings and a linear softmax, trained in numpy.

A text is the bag of the character n-grams of its words, word edges included,
hashed to buckets. The average of their embeddings goes through a linear softmax
over the two labels; embeddings and softmax are trained together on labelled
texts. As a misspelt word shares most n-grams with the word, it adds nearly the
same to the average though it was never seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm.chars import code_points, lower
from articlelake.llm.common import crc_of, draw_rows, name, small_batches, written
from articlelake.llm.words import slices

BUCKETS = 1 << 18
GRAMS = (4, 5, 6)
DIMENSIONS = 8
EPOCHS = 80
RATE = 0.1
#: Averages are small numbers; this factor in front of the softmax keeps steps alike in size.
SCALE = 200.0
MOMENTUM = 0.9
SEED = 7
#: Texts learnt from for each label, at most; a longer text than this many bytes is not learnt from.
SAMPLE_ROWS = 1000
SAMPLE_BYTES = 20_000

_BLANKS = np.array([32, 9, 10, 11, 12, 13], np.uint32)


@dataclass
class ToxicityModel:
    """`embeddings`: a row per bucket; `weights`: a column per label; `bias`: per label."""

    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def folded(self) -> tuple[np.ndarray, float]:
        """The difference of the two logits is linear in the average: one number per bucket, and a constant."""
        tilt = SCALE * (self.weights[:, 1] - self.weights[:, 0])
        return self.embeddings @ tilt, float(self.bias[1] - self.bias[0])


def _grams(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per n the buckets of all n-grams and the numbers of their texts.

    Words stand between white space; an n-gram may hold the blanks before and
    after its word, and two characters of the word at least.
    """
    points, bounds = code_points(texts)
    small = lower()[points]
    blank = np.isin(small, _BLANKS)
    small = np.where(blank, np.uint32(32), small).astype(np.uint64)
    inside = ~blank
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))
    out = []
    for n in GRAMS:
        size = max(len(points) - n + 1, 0)
        good = np.ones(size, bool)
        for k in range(1, n - 1):
            good &= inside[k : k + size]
        at = np.flatnonzero(good)
        key = np.full(len(at), n, np.uint64)
        for k in range(n):
            key = (key + small[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out.append(((key >> np.uint64(46)).astype(np.int32), owner[at + 1]))
    return out


def train(texts: list[str | None], labels: np.ndarray) -> ToxicityModel:
    """Train embeddings and softmax together by full-batch steps with momentum; both labels weigh the same."""
    rng = np.random.default_rng(SEED)
    embeddings = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    weights = rng.normal(0, 1, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if not len(texts) or not 0 < labels.sum() < len(labels):
        return ToxicityModel(embeddings, weights, bias)
    # Each distinct (text, bucket) with its share of the text's n-grams.
    keys, times = [], []
    for at in range(0, len(texts), 100):
        parts = _grams(pa.array(texts[at : at + 100], pa.string()))
        some, n = np.unique(np.concatenate([(t + at).astype(np.int64) * BUCKETS + g for g, t in parts]), return_counts=True)
        keys.append(some)
        times.append(n)
    keys, times = np.concatenate(keys), np.concatenate(times)
    text = (keys // BUCKETS).astype(np.int32)
    used, gram = np.unique(keys % BUCKETS, return_inverse=True)
    gram = gram.astype(np.int32)
    share = (SCALE * times / np.bincount(text, times, len(texts))[text]).astype(np.float32)
    own = rng.normal(0, 0.01, (len(used), DIMENSIONS)).astype(np.float32)
    y = labels.astype(np.float32)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum()).astype(np.float32)
    moving = [np.zeros_like(x) for x in (own, weights, bias)]
    for _ in range(EPOCHS):
        # Averages enter the softmax linearly, so its logits need one number per bucket.
        tilt = weights[:, 1] - weights[:, 0]
        gap = np.bincount(text, share * (own @ tilt)[gram], len(texts)) + bias[1] - bias[0]
        wrong = ((1 / (1 + np.exp(-np.clip(gap, -500, 500))) - y) * weight).astype(np.float32)  # of label 1; of label 0 its negative
        per_gram = np.bincount(gram, share * wrong[text], len(used)).astype(np.float32)
        pull = own.T @ per_gram
        slopes = (
            per_gram[:, None] * tilt[None],
            np.stack([-pull, pull], axis=1),
            np.array([-wrong.sum(), wrong.sum()], np.float32),
        )
        for value, slope, move in zip((own, weights, bias), slopes, moving, strict=True):
            move *= MOMENTUM
            move -= RATE * slope
            value += move
    embeddings[used] = own
    return ToxicityModel(embeddings, weights, bias)


def learn(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most `rows` labelled texts of each label, drawn by a hash of their ids."""
    marks = labels.select(name(key).alias("doc_id"), name(label).cast("int").alias("label")).filter("label IN (0, 1)")
    texts = docs.select(name(key).alias("doc_id"), name(text).alias("text")).filter(F.octet_length("text") <= SAMPLE_BYTES)
    # Texts too long leave gaps, so more ids than rows are drawn before texts are joined.
    # They are 4 * `rows` at most, few enough to go to every task.
    drawn = draw_rows(marks.distinct(), "label", 2 * rows, "doc_id")
    found = draw_rows(written(texts.join(F.broadcast(drawn), "doc_id"), "sample"), "label", rows, "doc_id", "text")
    sample = found.select("label", "text", "doc_id").orderBy("doc_id", "label", "text").toArrow()
    return train(sample.column("text").to_pylist(), sample.column("label").to_numpy())


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, score, predicted.

    A null or empty text, or one whose words are single characters, has no
    n-grams and scores what the bias alone gives, but at most just below one
    half. Rows alike are scored alike; other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(name(key).alias("doc_id"), name(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    shared = spark.sparkContext.broadcast(tuple(model.folded()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, constant = shared.value
        for batch in batches:
            for some in slices(batch, "text"):
                total, n = np.zeros(some.num_rows), np.zeros(some.num_rows)
                for grams, texts in _grams(some.column("text")):
                    total += np.bincount(texts, each[grams], some.num_rows)
                    n += np.bincount(texts, minlength=some.num_rows)
                best = np.where(n > 0, total / np.maximum(n, 1) + constant, min(constant, -1e-6))
                chance = 1 / (1 + np.exp(-np.clip(best, -500, 500)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": some.column("doc_id"),
                        "score": pa.array(chance),
                        "predicted": pa.array((chance >= 0.5).astype(np.int32)),
                    }
                )

    return rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def held_out(key: Column) -> Column:
    """Rows never learnt from: those whose id, as text, has CRC-32 0 modulo 5."""
    return crc_of(key) % 5 == 0


def train_and_score(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """Learn from labelled rows that are not held out, and score all:
    doc_id, held_out, score, predicted. Without both labels every score is one half or just below.

    One row per row, repeated ones and null ids included; a null text counts as empty and
    has a score too. Whole texts are scored. Other columns are not looked at; an empty table
    gives an empty result.
    """
    model = learn(docs, labels.filter(~held_out(name(key))), key, text, label)
    found = score(docs, model, key, text)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
