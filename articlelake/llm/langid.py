"""Language of texts and of spans within them.

A word is a run of letters. Its script leaves the languages seen in that script
as candidates; each candidate's score is the log probability of the word's
trigrams, edges included, under that language. Viterbi then labels the words of
a text, paying a penalty for every switch, so one odd word changes nothing and a
passage in another language becomes a span. A text has the language of most of
its letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from articlelake.llm.chars import SCRIPTS, code_points, letters, lower, scripts
from articlelake.llm.common import crc_of, draw_rows, name, small_batches
from articlelake.llm.words import SLICE_BYTES, slices

BUCKETS = 1 << 17
#: Labelled texts learnt from for each language, at most; a longer text than this many bytes is not learnt from.
SAMPLE_ROWS = 1500
SAMPLE_BYTES = 50_000
#: Added to every trigram's count.
SMOOTH = 0.1
SWITCH = 8.0
#: Share of a language's letters from which it is a candidate for a script.
USED = 0.01
UNKNOWN = "und"
#: Share of letters that a text's language must have for `keep_known`.
LEAST_SHARE = 0.5

#: Words labelled as one stretch; stretches of a text are then joined.
_STRETCH = 256
_FAR = -1e4


@dataclass
class LanguageModel:
    """`scores`: log probabilities, a row per trigram bucket and a column per
    language; `uses`: whether a language (column) uses a script (row)."""

    languages: list[str]
    scores: np.ndarray
    uses: np.ndarray


@dataclass
class _Words:
    """Letter runs of a slice: characters [starts, ends), text numbers, scripts, trigrams of their letters."""

    starts: np.ndarray
    ends: np.ndarray
    owner: np.ndarray
    script: np.ndarray
    buckets: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray


def _words(texts: pa.Array) -> _Words:
    points, bounds = code_points(texts)
    is_letter = letters()[points]
    small = np.where(is_letter, lower()[points], np.uint32(32)).astype(np.uint64)
    before = is_letter[:-1] if len(points) else is_letter
    starts = np.flatnonzero(is_letter & ~np.append(False, before)[: len(points)])
    ends = np.flatnonzero(is_letter[:-1] & ~is_letter[1:]) + 1 if len(points) else starts
    at = np.flatnonzero(is_letter)
    left = np.where(at > 0, small[np.maximum(at - 1, 0)], 32)
    key = left * np.uint64(0x9E3779B97F4A7C15) + small[at] * np.uint64(0xC2B2AE3D27D4EB4F)
    key = (key + small[at + 1]) * np.uint64(0xBF58476D1CE4E5B9)  # a line feed ends every text
    return _Words(
        starts,
        ends,
        np.searchsorted(bounds, starts, "right") - 1,
        scripts()[points[starts]],
        (key >> np.uint64(47)).astype(np.int64),
        ends - starts,
        bounds,
    )


def learn(docs: DataFrame, key: str, text: str, lang: str, rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from at most `rows` labelled texts of each language, drawn by a hash of their ids."""
    small_batches(docs.sparkSession)
    usable = docs.select(name(key).alias("doc_id"), name(lang).cast("string").alias("lang"), name(text).alias("text"))
    usable = usable.filter(F.col("lang").isNotNull() & (F.octet_length("text") <= SAMPLE_BYTES))
    sample = draw_rows(usable, "lang", rows, "doc_id", "text").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text"):
                words = _words(some.column("text"))
                names, which = np.unique(some.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
                own = np.repeat(which[words.owner], words.sizes)
                parts = (
                    ("trigram", own * BUCKETS + words.buckets, BUCKETS),
                    ("script", np.repeat(which[words.owner] * len(SCRIPTS) + words.script, words.sizes), len(SCRIPTS)),
                )
                for kind, values, base in parts:
                    found, n = np.unique(values, return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "kind": pa.array([kind] * len(found), pa.string()),
                            "lang": pa.array(names[found // base].tolist(), pa.string()),
                            "value": pa.array(found % base),
                            "n": pa.array(n),
                        }
                    )

    counted = sample.mapInArrow(count, "kind string, lang string, value long, n long")
    # At most one row for each language and bucket or script.
    table = counted.groupBy("kind", "lang", "value").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(table["lang"].unique())
    column = {language: k for k, language in enumerate(languages)}
    counts = {"trigram": np.zeros((BUCKETS, len(languages))), "script": np.zeros((len(SCRIPTS), len(languages)))}
    for kind, part in table.groupby("kind"):
        counts[kind][part["value"].to_numpy(), part["lang"].map(column).to_numpy()] = part["n"].to_numpy()
    totals = counts["trigram"].sum(axis=0)
    scores = np.log((counts["trigram"] + SMOOTH) / (totals + SMOOTH * BUCKETS))
    uses = counts["script"] >= USED * np.maximum(counts["script"].sum(axis=0), 1)
    return LanguageModel(languages, scores.astype(np.float32), uses)


def _word_scores(words: _Words, model: LanguageModel) -> np.ndarray:
    """Log probability of each word in each language; other languages than the script's are far below."""
    if not len(words.starts):
        return np.zeros((0, len(model.languages)), np.float32)
    firsts = np.cumsum(words.sizes) - words.sizes
    scores = np.add.reduceat(model.scores[words.buckets], firsts, axis=0)
    fits = model.uses[words.script]
    fits |= ~fits.any(axis=1, keepdims=True)
    return np.where(fits, scores, scores + np.float32(_FAR))


def best_labels(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """Viterbi labels of the words of several texts, [bounds[i], bounds[i + 1]) being those of text i.

    Texts are cut into stretches, which advance together, word by word, for
    every label that the word before the stretch may have; the stretches of a
    text are then chained. So a long text takes no more steps than a short one.
    """
    count, langs = scores.shape
    if not count:
        return np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    parts = -(-sizes // _STRETCH)
    owner = np.repeat(np.arange(len(sizes)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = bounds[:-1][owner] + nth * _STRETCH
    lengths = np.minimum(bounds[1:][owner] - starts, _STRETCH)
    order = np.argsort(-lengths, kind="stable")
    owner, nth, starts, lengths = owner[order], nth[order], starts[order], lengths[order]

    best = np.empty((count, langs), np.int16 if langs <= 1 << 15 else np.int32)  # the label before a switch, by entry
    stays = np.empty((count, langs, langs), bool)
    value = np.where(np.eye(langs, dtype=bool), 0.0, -np.inf)[None].repeat(len(owner), axis=0)
    value[nth == 0] = 0.0
    active = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), "right")
    for t, n in enumerate(active):
        at, now = starts[:n] + t, value[:n]
        top = now.max(axis=2)
        best[at] = now.argmax(axis=2)
        keep = now >= top[:, :, None] - switch
        stays[at] = keep
        value[:n] = np.where(keep, now, top[:, :, None] - switch) + scores[at][:, None, :]

    # Chain the stretches of each text.
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    heads = np.cumsum(parts) - parts
    entry, leave = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    total = np.zeros((len(sizes), langs))
    came = np.zeros((len(order), langs), np.int64)
    for k in range(int(parts.max())):
        texts = np.flatnonzero(parts > k)
        own = place[heads[texts] + k]
        if k == 0:
            total[texts] = value[own, 0]
        else:
            sums = total[texts][:, :, None] + value[own]
            came[own] = sums.argmax(axis=1)
            total[texts] = sums.max(axis=1)
    last = total.argmax(axis=1)
    for k in range(int(parts.max()) - 1, -1, -1):
        texts = np.flatnonzero(parts > k)
        own = place[heads[texts] + k]
        leave[own] = last[texts]
        if k:
            entry[own] = came[own, last[texts]]
            last[texts] = entry[own]

    labels, state = np.empty(count, np.int64), leave
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = state[:n]
        stay = stays[at, entry[:n], state[:n]]
        state[:n] = np.where(stay, state[:n], best[at, entry[:n]])
    return labels


def _label(model, switch: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = model.value.languages
        limit = max(1 << 14, SLICE_BYTES * 16 // max(4, len(languages)) ** 2)
        for batch in batches:
            for some in slices(batch, "text", limit):
                words = _words(some.column("text"))
                n = some.num_rows
                if languages:
                    scores = _word_scores(words, model.value)
                    per_text = np.searchsorted(words.owner, np.arange(n + 1))
                    labels = best_labels(scores, per_text, switch)
                    weight = np.bincount(words.owner * len(languages) + labels, words.sizes, n * len(languages))
                    weight = weight.reshape(n, len(languages))
                else:
                    labels, weight = np.zeros(len(words.starts), np.int64), np.zeros((n, 1))
                total = weight.sum(axis=1)
                top = weight.argmax(axis=1)
                share = weight.max(axis=1) / np.maximum(total, 1)
                # A span ends with its text or where the label changes.
                new = np.ones(len(labels), bool)
                new[1:] = (labels[1:] != labels[:-1]) | (words.owner[1:] != words.owner[:-1])
                heads = np.flatnonzero(new) if languages else np.zeros(0, np.int64)
                tails = np.append(heads[1:], len(labels))[: len(heads)] - 1
                base = words.bounds[words.owner[heads]]
                struct = pa.StructArray.from_arrays(
                    [
                        pa.array([languages[k] for k in labels[heads]], pa.string()),
                        pa.array(words.starts[heads] - base, pa.int64()),
                        pa.array(words.ends[tails] - base, pa.int64()),
                    ],
                    ["lang", "start", "end"],
                )
                limits = np.searchsorted(words.owner[heads], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": some.column("doc_id"),
                        "lang_pred": pa.array(
                            [languages[k] if t else UNKNOWN for k, t in zip(top, total, strict=True)], pa.string()
                        ),
                        "score": pa.array(share),
                        "spans": pa.ListArray.from_arrays(pa.array(limits), struct),
                    }
                )

    return run


def identify(
    docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text", switch: float = SWITCH
) -> DataFrame:
    """One row per row of `docs`: doc_id, lang_pred, score, spans.

    `score` is the share of letters in the text's language; `spans` are runs of
    one language as character offsets. A null text, or one without letters, is
    `und` with score 0 and no spans; so is every text if nothing was learnt.
    Ties go to the language that sorts first. Repeated rows are labelled alike;
    other columns are not looked at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(name(key).alias("doc_id"), name(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    shared = spark.sparkContext.broadcast(model)
    schema = f"doc_id {kind}, lang_pred string, score double, spans array<struct<lang: string, start: long, end: long>>"
    return rows.mapInArrow(_label(shared, switch), schema)


def keep_known(
    docs: DataFrame, model: LanguageModel, text: str = "text", share: float = LEAST_SHARE, switch: float = SWITCH
) -> DataFrame:
    """The rows of `docs` with letters, of which one language has at least `share`; columns stay as they are.

    Null and empty texts have no letters and go. Every row is judged by itself and whole, so
    repeated rows and null ids need no rule; an empty table stays empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    label, place = _label(shared, switch), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = pa.array(range(batch.num_rows), pa.int64())
            texts = pa.RecordBatch.from_arrays([number, batch.column(place)], ["doc_id", "text"])
            parts = [part.select(["lang_pred", "score"]) for part in label(iter([texts]))]
            if parts:
                found = pa.Table.from_batches(parts).combine_chunks()
                known = pc.not_equal(found["lang_pred"], UNKNOWN)
                good = pc.and_(known, pc.greater_equal(found["score"], share)).combine_chunks()
                yield batch.filter(good)

    # By place, as names may hold dots.
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def held_out(key: Column) -> Column:
    """Rows never learnt from: those whose id, as text, has CRC-32 2 modulo 4."""
    return crc_of(key) % 4 == 2


def train_and_identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, and label all: doc_id, held_out, lang_pred, score, spans.

    One row per row, repeated ones and null ids included. A text that is null, empty or
    without letters is `und` with score 0 and no spans; so is every text if nothing
    could be learnt. Other columns are not looked at; an empty table gives an empty result.
    """
    model = learn(docs.filter(~held_out(name(key))), key, text, lang)
    found = identify(docs, model, key, text)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "spans")
