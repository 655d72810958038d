"""Whitening, hard negatives and top-k search against plain versions and odd rows."""

import math

import numpy as np
import pytest

from articlelake.llm import negatives, topk, vectors, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, score string, `row` long, `a.b` int"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rng = np.random.default_rng(3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, rng.normal(0, 0.2, 6).tolist(), int(i % 3)) for i in range(0, 460, 10)]
    hot = [0.5, -0.25, 0.125, 0.0, -0.0, 0.3]
    rows += [(1000 + i, hot, i % 2) for i in range(60)]
    rows += [(50, hot, 1), (50, hot, 1), (100, hot, 0), (100, rows[3][1], 0), (None, hot, 1), (None, rows[1][1], 0)]
    rows += [(150, None, 1), (150, [0.1, None, 0.1, 0.1, 0.1, 0.1], 1), (200, [nan] * 6, 1), (200, [inf] + [0.0] * 5, 1)]
    rows += [(300, [], 1), (350, [0.25, -0.5], 2), (400, hot, None), (-50, hot, 2), (-100, rows[7][1], 1)]
    return [(*r, "s", 7, 3) for r in rows]


def _plain(rows, with_label=False):
    """(id, x, label) of the rows that take part, shorter vectors ending in zeros."""
    kept = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    if with_label:
        kept = [r for r in kept if r[2] is not None]
    width = max((len(r[1]) for r in kept), default=0)
    return [(r[0], [math.floor(256 * float(np.float32(c))) for c in r[1]] + [0] * (width - len(r[1])), r[2]) for r in kept]


def _order(score, key):
    return (-score, key is None, key or 0)


def _dot(a, b):
    return sum(p * q for p, q in zip(a, b, strict=True))


def test_top_k_of_odd_rows(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(vectors.in_blocks, "__defaults__", (16,))
    plain = _plain(odd_vectors)
    want = []
    for i, (key, x, _) in enumerate(plain):
        if key is None or key % 50:
            continue
        others = sorted(((_order(_dot(x, y), k), _dot(x, y), k) for j, (k, y, _) in enumerate(plain) if j != i), key=lambda t: t[0])[:5]
        want += [(key, n, k, s) for n, (_, s, k) in enumerate(others, 1)]
    got = topk.exact_top_k(spark.createDataFrame(odd_vectors, SCHEMA).repartition(5)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def _negatives(rows, every=100):
    plain = _plain(rows, True)
    out = []
    for i, (key, x, label) in enumerate(plain):
        if key is None or key % every:
            continue
        others = sorted(
            ((_order(_dot(x, y), k), _dot(x, y), k, lab == label) for j, (k, y, lab) in enumerate(plain) if j != i), key=lambda t: t[0]
        )
        for _, p, positive, _ in [o for o in others if o[3]][:5]:
            inside = [o for o in others if not o[3] and 30 * p <= 100 * o[1] <= 90 * p][:10]
            out += [(key, positive, n, k, p, s) for n, (_, s, k, _) in enumerate(inside, 1)]
    return out


def test_hard_negatives_of_odd_rows(spark, odd_vectors, monkeypatch):
    monkeypatch.setattr(vectors.in_blocks, "__defaults__", (16,))
    want = _negatives(odd_vectors)
    got = negatives.hard_negatives(spark.createDataFrame(odd_vectors, SCHEMA).repartition(5)).collect()
    assert want and sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_searches_of_large_numbers(spark):
    """Products beyond doubles and longs are exact, or end at the largest long."""
    rows = [(0, [1e15, 3.0, 1.0], 1), (1, [1e15, 2.0, -1.0], 1), (2, [1e15, 2.5, 1.0], 2), (50, [3e38, -3e38, 0.0], 1), (100, [0.0] * 3, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    x = {r[0]: [max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * c))) for c in r[1]] for r in rows}
    most = (1 << 63) - 1
    for r in topk.exact_top_k(frame).collect():
        assert r["score"] == max(-most, min(most, _dot(x[r["query_id"]], x[r["vec_id"]])))
    assert negatives.hard_negatives(frame).count() >= 0
    assert whitening.whiten(frame).count() > 0


def test_nothing_to_search(spark, table):
    none = spark.createDataFrame([], SCHEMA)
    for rows in (none, spark.createDataFrame([(50, [1.0], 1, "s", 7, 3)], SCHEMA), table.filter("vec_id % 50 <> 0")):
        assert topk.exact_top_k(rows).isEmpty() and negatives.hard_negatives(rows).isEmpty()
    with pytest.raises(ValueError):
        negatives.hard_negatives(none, high=100)


def _whitened(rows):
    plain = _plain(rows)
    fit = np.array(sorted({tuple(x) for _, x, _ in plain}), float)
    values, vectors_ = np.linalg.eigh(np.cov(fit.T, bias=True))
    return plain, fit, values[::-1], vectors_[:, ::-1]


def test_whitening(spark, table, odd_vectors):
    for frame in (table, spark.createDataFrame(odd_vectors, SCHEMA).repartition(4)):
        rows = [tuple(r) for r in frame.collect()]
        plain, fit, values, vectors_ = _whitened(rows)
        n, sums = len(fit), fit.sum(0)
        got = whitening.whiten(frame).collect()
        assert len(got) == 4 * len(plain) and {r["n"] for r in got} == {n}
        assert max(r["identity_error"] for r in got) < 1e-9
        deviation = {(k, sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))) for k, x, _ in plain}
        assert {(r["vec_id"], r["deviation"]) for r in got} == deviation
        for c in range(4):
            own = [r for r in got if r["component"] == c + 1]
            assert abs(own[0]["explained"] / (values[c] / values.sum()) - 1) < 1e-9
            white = sorted((str(k), v) for k, v in zip([p[0] for p in plain], np.array([p[1] for p in plain]) @ vectors_[:, c], strict=True))
            mean = sums @ vectors_[:, c] / n
            want = sorted((k, round(abs(v - mean) / values[c] ** 0.5, 6)) for k, v in white)
            assert sorted((str(r["vec_id"]), round(abs(r["whitened"]), 6)) for r in own) == want


def test_whitening_of_little(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5, 0.5])] * 9, [(1, [])] * 3, [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).isEmpty()
    line = whitening.whiten(spark.createDataFrame([(i, [0.25 * i, 0.5 * i, 1.0]) for i in range(9)], schema)).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 9


def test_singular_values_and_directions():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    cases = [rng.normal(size=(100, d)) for d in (1, 2, 3, 17, 80)]
    cases += [np.diag([1.0] * 10 + [0.5] * 30) @ turn, np.diag(1 + 1e-9 * rng.normal(size=40)) @ turn, np.eye(6)]
    cases += [rng.normal(size=(50, 2)) @ rng.normal(size=(2, 20)), rng.normal(size=(99, 30)) * np.logspace(0, -8, 30)]
    cases += [rng.integers(-2, 3, (30, d)).astype(float) for d in range(1, 12) for _ in range(9)]
    for a in cases:
        r = np.linalg.qr(a, mode="r")
        values, directions = whitening.principal(r, 4)
        want = np.linalg.svd(r, compute_uv=False) ** 2
        assert np.abs(values[: len(want)] - want).max() <= 1e-12 * want[0]
        assert np.linalg.norm(a.T @ (a @ directions) - directions * values[: directions.shape[1]], axis=0).max() <= 1e-11 * want[0]
        assert np.abs(directions.T @ directions - np.eye(directions.shape[1])).max() <= 1e-9


def test_finalists_hold_the_best():
    """Reading stops early, and every candidate that may qualify is left."""
    rng = np.random.default_rng(1)
    x = rng.integers(-40, 40, (900, 8))
    x[:300] = x[0]
    q = rng.integers(-40, 40, (20, 8))
    lists = topk.sorted_lists({"x": x.astype(np.int16)})
    who, where = topk.finalists(q, np.full(20, -1), lists, 5, np.full(20, -np.inf))
    assert len(who) < 20 * 900 / 2
    scores = q @ x.T
    for i in range(20):
        best = np.sort(scores[i])[-5]
        assert set(np.flatnonzero(scores[i] >= best)) <= set(where[who == i])
