"""Exact, near and line duplicates, and benchmark passages, against plain versions."""

import hashlib
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from articlelake.llm import decontamination, exactdedup, linededup, neardup
from articlelake.llm.components import contract
from articlelake.llm.linededup import LineRuns


def test_exact_groups(odd, odd_rows, none):
    flat = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in odd_rows]
    groups = {}
    for row, text in zip(odd_rows, flat, strict=True):
        groups.setdefault(text, []).append(row[0])
    want = []
    for row, text in zip(odd_rows, flat, strict=True):
        ids = [i for i in groups[text] if i is not None]
        keep = min(ids) if ids else None
        want.append((row[0], keep, len(groups[text]), row[0] == keep, hashlib.sha256(text.encode()).hexdigest()))
    got = [tuple(r) for r in exactdedup.exact_groups(odd, runs=8, radix=2).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert exactdedup.exact_groups(none).isEmpty()


def test_near_groups(odd, odd_rows, none):
    rows = [(r[0], r[1]) for r in odd_rows]
    want = []
    for i, (size, least) in brute.near_components(rows).items():
        least = least if brute.shingles(rows[i][1]) else rows[i][0]
        want.append((rows[i][0], size, least, rows[i][0] == least))
    got = [tuple(r)[:4] for r in neardup.near_groups(odd).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert neardup.near_groups(none).isEmpty()
    kept = neardup.keep_one_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id < 4").collect()) == [1]


def test_crowded_buckets(spark, monkeypatch):
    """A large group of copies of one text, some too far from all others to be linked."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 6), replace=False):
            words[at] = f"new{k}x{at}"
        rows.append((k, " ".join(words)))
    monkeypatch.setattr(neardup, "SMALL", 4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.near_components(rows)
    assert got == want and 1 < len({c for _, c in want.values()}) < 150


def test_fewest_matches():
    least = neardup.fewest_matches(24, 144, 85, 1e-6)
    assert len(least) == 6 and least == sorted(least)
    rng = np.random.default_rng(0)
    drawn = rng.random((20000, 144)) < 0.85
    for k, enough in enumerate(least):
        assert (drawn[:, : 24 * (k + 1)].sum(axis=1) < enough).mean() < 1e-3


@pytest.mark.parametrize("size", [2, 40])
def test_contract(spark, size):
    chain = [(f"{(7 * i) % size:03d}", f"{(7 * i + 7) % size:03d}") for i in range(size - 1)] if size % 7 else []
    edges = spark.createDataFrame([*chain, ("x", "y"), ("y", "z"), ("q", "q")], "a string, b string")
    got = {r["node"]: r["label"] for r in contract(edges).collect()}
    assert got["x"] == got["y"] == got["z"] and "q" not in got
    assert len({got[a] for pair in chain for a in pair}) == 1
    assert contract(edges.limit(0)).isEmpty()


def _kept_lines(rows, shortest=10):
    def key(line):
        return brute.low(line.strip(" \t\n\x0b\f\r"))

    owners, many = {}, {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            many.setdefault(key(line), set()).add(doc)
    for k, ids in many.items():
        owners[k] = None if None in ids and len(ids) == 1 else min(i for i in ids if i is not None)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if len(key(x)) < shortest or len(many[key(x)]) < 2 or doc == owners[key(x)]]
        out.append((doc, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


def test_lines(spark, none):
    rows = [
        (5, "A common LINE here\nown line number five\nshort"),
        (2, "\t a common line HERE \r\nshort\n\na common line here"),
        (2, "ünïque line with Ä\na common line here"),
        (None, "a common line here\nanother\nown line number five"),
        (9, None),
        (10, ""),
        (11, "own line number five\nünïque line with ä\nÜNÏQUE LINE WITH Ä"),
        (11, "own line number five\nünïque line with ä\nÜNÏQUE LINE WITH Ä"),
        (12, "x" * 200_000 + "\n" + "x" * 200_000),
        (13, "x" * 200_000 + "\n" * 5000 + "end of it all"),
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit(1))
    want = sorted(_kept_lines(rows), key=str)
    for batches, fan in ((1, 2), (3, 2), (5, 3)):
        got = linededup.dedup_lines(table, batches=batches, fan=fan)
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert linededup.dedup_lines(none).isEmpty()


def test_runs_are_compacted(spark):
    runs = LineRuns(fan=2)
    for k in range(5):
        own = spark.createDataFrame([(f"own{k}", k, k), ("all", k, k)], "line string, first long, last long")
        repeated = {(r["line"], r["owner"]) for r in runs.admit(own).collect()}
        assert repeated == (set() if k == 0 else {("all", 0)})
    assert [len(level) for level in runs.levels] == [1, 0, 1]


def test_decontaminate(spark, sf, odd, odd_rows, none, docs):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    short = spark.createDataFrame([(901, "the"), (902, "of and"), (903, ""), (904, None), (905, "THE the"), (901, "zz")], items.schema)
    for table, rows in ((docs, [tuple(r)[:2] for r in docs.collect()]), (odd, [r[:2] for r in odd_rows])):
        every = items.union(short)
        plain = brute.hits(rows, [tuple(r) for r in every.collect()])
        want = []
        for i, (words, hit, found) in plain.items():
            digest = hashlib.sha256(",".join(found).encode()).hexdigest()
            want.append((rows[i][0], words, hit, len(found), digest, hit > 0))
        got = [tuple(r)[:6] for r in decontamination.decontaminate(table, every).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    clean = decontamination.keep_clean(odd, short)
    assert clean.columns == odd.columns and {r["doc_id"] for r in clean.collect()}.isdisjoint({7, 8})
    assert decontamination.decontaminate(none, items).isEmpty()
    assert not decontamination.decontaminate(odd, short.limit(0)).filter("contaminated").count()


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red green blue one two"), (2, "blue x red y green"), (3, "red " + "pad " * 40 + "green blue")], "doc_id long, text string")
    items = decontamination.windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    index = decontamination.PositionalIndex(docs.withColumn("print", F.xxhash64("text")), items.cache())
    assert {r["doc_id"] for r in index.phrases().collect()} == {1}
    assert {r["doc_id"] for r in index.proximity(slop=3).collect()} == {1, 2}
