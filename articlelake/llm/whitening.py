"""Whitening of embeddings from the singular values and vectors of their centred rows.

Rows are reduced in blocks to triangular factors, which meet in rounds of a tree.
The last factor is brought to bidiagonal form by reflections; shifted quotient-
difference steps (dqds) find its squared singular values to high relative
accuracy, and twisted factorisations their directions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articlelake.llm import vectors as V
from articlelake.llm.common import written

#: Rows of a block, and triangular factors that meet in one task.
ROWS, MEET = 4096, 16

_EPS = float(np.finfo(float).eps)
_TINY = 1e-290
_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


# ------------------------------------------------------------ one small matrix


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a and superdiagonal b of U'RV, and V, by Householder reflections."""
    work, size = r.astype(float).copy(), len(r)
    v = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            return None
        u = x.copy()
        u[0] += math.copysign(norm, x[0])
        return u / np.linalg.norm(u)

    for k in range(size):
        if (u := reflector(work[k:, k])) is not None:
            work[k:, k:] -= np.outer(2 * u, u @ work[k:, k:])
        if k + 1 < size and (u := reflector(work[k, k + 1 :])) is not None:
            work[k:, k + 1 :] -= np.outer(work[k:, k + 1 :] @ u, 2 * u)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ u, 2 * u)
    return np.diag(work).copy(), np.diag(work, 1).copy(), v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None if the shift was above the smallest value."""
    d, qs, es = q[0] - shift, [], []
    for i, off in enumerate(e):
        if d < 0:
            return None
        top = d + off
        ratio = q[i + 1] / top if top > 0 else 1.0
        qs.append(top)
        es.append(off * ratio)
        d = d * ratio - shift
    return None if d < 0 else ([*qs, d], es)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values, rising, of a bidiagonal matrix with squared diagonal q and superdiagonal e."""
    found, parts = [], [([float(x) for x in q], [float(x) for x in e], 0.0)]
    while parts:
        q, e, moved = parts.pop()
        while q:
            if len(q) == 1:
                found.append(moved + q[0])
                break
            if q[-1] > 1.5 * q[0]:  # Steps are fast when the small values are at the end.
                q, e = q[::-1], e[::-1]
            small = [off <= (_EPS * _EPS) * (moved + min(q[i], q[i + 1])) or off < _TINY for i, off in enumerate(e)]
            if small[-1]:
                found.append(moved + q.pop())
                e.pop()
                continue
            if any(small):
                cut = small.index(True)
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            # Smallest value of the last two by two: near the end value once its neighbour is small.
            a, b, c = q[-2], e[-1], q[-1]
            total = a + b + c
            root = math.sqrt(max(0.0, total * total - 4 * a * c))
            shift = 2 * a * c / (total + root) if total > 0 else 0.0
            for part in (1 - 1e-3 * min(1.0, b / c if c > 0 else 1.0), 0.75, 0.25, 0.0):
                if (moved_on := _step(q, e, shift * part)) is not None:
                    q, e = moved_on
                    moved += shift * part
                    break
    return np.sort(np.array(found))


class _Twisted:
    """Both triangular factorisations of B'B - value, and the vectors they give."""

    def __init__(self, q: np.ndarray, e: np.ndarray, value: float) -> None:
        self.size, self.down, self.up = len(q), [], []
        scale = max(float(q.max(initial=0)), float(e.max(initial=0)), _TINY)
        least = scale * 1e-200

        def whole(x: float) -> float:
            return x if abs(x) > least else math.copysign(least, x)

        link = [math.sqrt(x) for x in np.maximum(q[:-1] * e, 0)]  # Off-diagonal of B'B.
        # From the top: pivots of the stationary transform, kept as differences of quotients.
        s, self.pivots, stationary = -value, [], [-value]
        for i in range(self.size - 1):
            pivot = whole(s + float(q[i]))
            self.pivots.append(pivot)
            self.down.append(link[i] / pivot)
            s = float(e[i]) * (s / pivot) - value
            stationary.append(s)
        self.last = whole(s + float(q[-1]))
        # From the bottom: the progressive transform.
        p, progressive = float(q[-1]) - value, [float(q[-1]) - value]
        for i in range(self.size - 2, -1, -1):
            pivot = whole(float(e[i]) + p)
            self.up.append(link[i] / pivot)
            p = p * (float(q[i]) / pivot) - value
            progressive.append(p)
        self.up.reverse()
        progressive.reverse()
        self.gamma = np.array([s + p + value for s, p in zip(stationary, progressive, strict=True)])

    def vector(self, twist: int) -> np.ndarray:
        z = np.zeros(self.size)
        z[twist] = 1.0
        for i in range(twist - 1, -1, -1):
            z[i] = -self.down[i] * z[i + 1]
        for i in range(twist, self.size - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z

    def solve(self, y: np.ndarray) -> np.ndarray:
        """A step of inverse iteration by the factorisation from the top."""
        y = y.copy()
        for i in range(self.size - 1):
            y[i + 1] -= self.down[i] * y[i]
        y[-1] /= self.last
        for i in range(self.size - 2, -1, -1):
            y[i] = y[i] / self.pivots[i] - self.down[i] * y[i + 1]
        return y


def _direction(q: np.ndarray, e: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """Unit vector of one value, at right angles to those of values close to it."""
    twisted = _Twisted(q, e, value)
    for twist in np.argsort(np.abs(twisted.gamma), kind="stable"):
        z = twisted.vector(int(twist))
        z /= np.linalg.norm(z)
        if not near:
            return z
        basis = np.stack(near)
        for _ in range(3):
            z -= basis.T @ (basis @ z)
            if (left := np.linalg.norm(z)) < 1e-3:
                break
            z = twisted.solve(z / left)
            if not np.isfinite(z).all() or not (norm := np.linalg.norm(z)):
                break
            z /= norm
        else:
            z -= basis.T @ (basis @ z)
            z /= np.linalg.norm(z)
            return z - basis.T @ (basis @ z)
    # Equal values in one unreduced matrix differ by rounding only: any vector beside the others will do.
    rest = np.linalg.qr(np.vstack([np.stack(near), np.eye(len(q))]).T)[0]
    return rest[:, len(near)]


def principal(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of `r`, falling, and the right singular vectors of the first `count` as columns."""
    size = r.shape[1]
    scale = float(np.abs(r).max(initial=0))
    if size == 0 or scale == 0:
        return np.zeros(size), np.zeros((size, 0))
    a, b, v = bidiagonal(r / scale)
    largest = max(np.abs(a).max(), np.abs(b).max(initial=0))
    cuts = np.flatnonzero(np.abs(b) <= _EPS * largest * 1e-2) + 1
    bounds = [0, *cuts.tolist(), size]
    values = []
    for low, high in zip(bounds, bounds[1:], strict=False):
        q, e = a[low:high] ** 2, b[low : high - 1] ** 2
        values += [(float(x), low, high) for x in dqds(np.maximum(q, _TINY), e)]
    values.sort(key=lambda x: -x[0])
    vectors: list[np.ndarray] = []
    taken: list[tuple[float, int, np.ndarray]] = []
    for value, low, high in values[:count]:
        q, e = np.maximum(a[low:high] ** 2, _TINY), b[low : high - 1] ** 2
        near = [z for other, at, z in taken if at == low and other - value <= 1e-3 * max(other, _TINY)]
        z = _direction(q, e, value, near)
        taken.append((value, low, z))
        whole = np.zeros(size)
        # Off the diagonal B'B has the signs of a * b, which q and e do not know.
        signs = np.where(a[low : high - 1] * b[low : high - 1] < 0, -1.0, 1.0)
        whole[low:high] = z * np.cumprod(np.append(1.0, signs))
        out = v @ whole
        out *= math.copysign(1.0, out[np.argmax(np.abs(out))])
        vectors.append(out / np.linalg.norm(out))
    eigenvalues = np.array([x[0] for x in values]) * scale * scale
    return eigenvalues, np.stack(vectors, 1) if vectors else np.zeros((size, 0))


# -------------------------------------------------------------- all the rows


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: longs, or Python's whole numbers where those are too short."""
    most = n * int(max(-int(x.min()), int(x.max()), 1)) + max(map(abs, sums), default=0) if x.size else 0
    if most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _numerators(x, n, sums).astype(np.float64) / n


def _deviations(numerators: np.ndarray) -> list[int | None]:
    """Sums of squares, exactly; null beyond a long."""
    most = int(max(-int(numerators.min()), int(numerators.max()))) if numerators.size else 0
    if most * most * max(1, numerators.shape[1]) < 1 << 63:
        return (numerators.astype(np.int64) ** 2).sum(1).tolist()
    return [s if s < 1 << 63 else None for s in (numerators.astype(object) ** 2).sum(1).tolist()]


def _rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            piece = batch.slice(at, ROWS)
            yield piece, V.matrix(piece.column("x"), width)


def _sums(fit: DataFrame, width: int) -> list[int]:
    """Sum of every dimension, exactly: one row per dimension reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(width, np.int64), np.zeros(width, np.int64)
        for _, x in _rows(batches, width):
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_pydict({"dim": np.arange(width), "high": high, "low": low})

    parts = fit.mapInArrow(add, "dim long, high long, low long").groupBy("dim")
    found = parts.agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    by = {r["dim"]: (r["high"] << 32) + int(r["low"]) for r in found}
    return [by[i] for i in range(width)]


def triangular(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Triangular factor of the centred rows; in every round a task turns up to MEET factors into one."""
    width = len(sums)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for _, x in _rows(batches, width):
            factor = np.linalg.qr(np.vstack([factor, _centred(x, n, sums)]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_pydict({"factor": [factor.tobytes()]}, schema=pa.schema({"factor": pa.binary()}))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for batch in batches:
            for other in batch.column("factor"):
                other = np.frombuffer(other.as_py()).reshape(-1, width)
                factor = np.linalg.qr(np.vstack([factor, other]), mode="r")
        if len(factor):
            yield pa.RecordBatch.from_pydict({"factor": [factor.tobytes()]}, schema=pa.schema({"factor": pa.binary()}))

    factors = written(fit.mapInArrow(reduce, "factor binary"), "factors")
    while (count := factors.count()) > 1:
        factors = written(factors.repartition(math.ceil(count / MEET)).mapInArrow(meet, "factor binary"), "factors")
    return np.frombuffer(factors.first()["factor"]).reshape(-1, width)


def _identity_error(fit: DataFrame, n: int, sums: list[int], turn: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    width, count = turn.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, square = np.zeros(count), np.zeros((count, count))
        for _, x in _rows(batches, width):
            white = _centred(x, n, sums) @ turn
            total += white.sum(0)
            square += white.T @ white
        values = np.append(total, square.ravel())
        yield pa.RecordBatch.from_pydict({"at": np.arange(len(values)), "value": values})

    found = fit.mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(count + count * count)
    for r in found:
        values[r["at"]] = r["value"] / n
    mean = values[:count]
    return float(np.abs(values[count:].reshape(count, count) - np.outer(mean, mean) - np.eye(count)).max())


def whiten(rows: DataFrame, components: int = 4, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component.

    Entries count as x = floor(256 * c). The fit list is each distinct x vector once: n
    vectors with sums S. Components are unit eigenvectors of its covariance (divisor n), by
    falling eigenvalue, with their largest entry positive. `deviation` is the sum of
    (n * x - S)^2, null beyond a long; `whitened` is x - S / n on the component over the root
    of the eigenvalue e; `explained` is e over the trace; `identity_error` is the largest
    absolute entry of the whitened covariance minus the identity.

    Rows whose vector is null or holds null, NaN or infinite entries are left out. Vectors
    shorter than the longest count as ending in zeros. Repeated rows each get their own
    result. A null id stays null. Directions without variance (eigenvalue within rounding of
    zero) are no components, so a table with one distinct vector, or none, gives no rows. Other columns are not looked at.
    """
    spark = rows.sparkSession
    V.batches_by_bytes(spark)
    found = V.whole_rows(rows, key, vector).select("id", "x")
    least, width = found.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    empty = spark.createDataFrame([], _OUT)
    if not width:
        return empty
    if least < width:
        zeros = F.array_repeat(F.lit(0).cast("long"), width - F.size("x"))
        found = found.withColumn("x", F.concat("x", zeros))
    fit = written(found.select("x").distinct(), "fit")
    n = fit.count()
    sums = _sums(fit, width)
    values, directions = principal(triangular(fit, n, sums), components)
    held = values[: directions.shape[1]] > values[0] * width * _EPS * 4
    count = int(np.count_nonzero(held))
    if count == 0:
        return empty
    turn = directions[:, :count] / np.sqrt(values[:count] / n)
    explained = values[:count] / values.sum()
    error = _identity_error(fit, n, sums, turn)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, x in _rows(batches, width):
            numerators = _numerators(x, n, sums)
            rows = len(x)
            white = (numerators.astype(np.float64) / n) @ turn
            deviation = pa.array(_deviations(numerators), pa.int64())
            each = pa.array(np.repeat(np.arange(rows), count))
            columns = [
                piece.column("id").take(each), np.tile(np.arange(1, count + 1, dtype=np.int32), rows), np.full(rows * count, n),
                deviation.take(each), white.ravel(), np.tile(explained, rows), np.full(rows * count, error),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return found.mapInArrow(project, _OUT)
