"""Whitening of embeddings by a bidiagonal qd solver (operator 11).

Rows become whole numbers (``fixed``), so sums are exact and equal rows are equal.  The fit
list holds each distinct row once.  Four steps on Spark, each one pass over rows that are
dealt over many tasks:

1. sums per dimension, exact, one row a task;
2. blockwise QR: each task centres its rows block by block and keeps only the triangle R of
   what it has read; the triangles are stacked and reduced again, in groups, then all
   together.  Every step holds one block and one d x d triangle, whatever the number of
   rows, and a lost task is just run again;
3. the whitened rows' covariance, one k x k matrix a task, as the error that is returned;
4. the whitened rows.

What is solved on the driver is one d x d triangle.  Householder reflections from both sides
make it bidiagonal; ``dqds`` finds the squares of its singular values, which are the
eigenvalues of the rows' scatter matrix without the matrix being formed; a twisted
factorisation of each shifted bidiagonal product gives the singular vector, and the
reflections turn it back into a direction of the embeddings.  Vectors of nearly equal
values are made orthogonal one to the other.

Equal vectors are grouped by a hash aggregation with a map-side part, so a vector that
makes up a third of the table is one row a task.

Defined cases: null vectors and vectors with a null, not-a-number or infinite entry are
left out, as are empty ones and entries of 2^53 and more in whole numbers (no exact sum).
Vectors must have one length: those of the commonest length are used (ties: the
smaller), others are left out.  Null ids and repeated rows are whitened row by row and fitted once.
Components without variance (fewer distinct rows than dimensions, constant
dimensions) are not returned; one distinct row has none, and no rows give an empty table.
Equal eigenvalues may have any basis of their space.  ``deviation`` is null where it is beyond a
long.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..session import write_shared

SCALE, SHIFT = 64, 1_000_000
_LARGEST = float(1 << 53)
_BLOCK = 512     # rows per block: sums of so many numbers under 2^53 fit a long
_EPS = np.finfo(float).eps


def fixed(vector: Column) -> Column:
    """The whole-number vector, null if an entry is null, not finite or too large."""
    scaled = F.transform(vector, lambda c: c.cast("double") * SCALE)
    usable = F.forall(scaled, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < _LARGEST - 2 * SHIFT), F.lit(False)))
    return F.when(usable & (F.size(vector) > 0), F.transform(scaled, lambda c: F.floor(c) + SHIFT))


def usable_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that can be whitened."""
    return rows.select(F.col(id_col).alias("id"), fixed(F.col(vector_col)).alias("x")).filter("x is not null")


# --- passes over the rows ------------------------------------------------------------------

def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(at, _BLOCK)
            x = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, x.reshape(part.num_rows, d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """(rows, exact sums): one row a task reaches the driver, added up by Spark."""
    def add(batches):
        n, s = 0, [0] * d
        for _, x in _blocks(batches, d):
            n += len(x)
            s = [a + int(b) for a, b in zip(s, x.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "s": [str(v) for v in s]}])

    per_task = fit.select("x").mapInArrow(add, "n long, s array<string>")
    whole = per_task.select("n", F.posexplode("s").alias("dim", "v")).groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    s = {r.dim: int(r.v) for r in whole}
    return (whole[0].n, [s[i] for i in range(d)]) if whole else (0, [0] * d)


def _centred(x: np.ndarray, n: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S/n with one rounding: S = n * whole + rest."""
    return (x - whole).astype(float) - rest / n


def _triangle(parts: Iterator[np.ndarray]) -> np.ndarray | None:
    r = None
    for part in parts:
        r = np.linalg.qr(part if r is None else np.vstack([r, part]), mode="r")
    return r


def _qr(fit: DataFrame, d: int, n: int, sums: list[int], groups: int = 64) -> np.ndarray:
    """R of the centred rows."""
    whole, rest = np.array([s // n for s in sums]), np.array([float(s % n) for s in sums])

    def reduce(batches):
        r = _triangle(_centred(x, n, whole, rest) for _, x in _blocks(batches, d))
        if r is not None:
            yield pa.RecordBatch.from_pydict({"g": [TaskContext.get().partitionId() % groups], "r": [r.tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        r = _triangle(np.frombuffer(v, float).reshape(-1, d) for v in table.column("r").to_pylist())
        return pa.table({"g": pa.array([0], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    triangles = fit.select("x").mapInArrow(reduce, "g long, r binary")
    for _ in range(2):
        triangles = triangles.groupBy("g").applyInArrow(merge, "g long, r binary")
    r = np.frombuffer(triangles.first().r, float).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


# --- the solver ------------------------------------------------------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal a, superdiagonal b, V) with r = U B V' for some orthogonal U."""
    m, d = np.array(r, float), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0:
            return None
        w = x.copy()
        w[0] += math.copysign(norm, x[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        w = reflector(m[k:, k])
        if w is not None:
            m[k:, k:] -= 2 * np.outer(w, w @ m[k:, k:])
        if k + 2 < d:
            w = reflector(m[k, k + 1:])
            if w is not None:
                m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def dqds(a: np.ndarray, b: np.ndarray) -> list[float]:
    """Squares of the singular values of an unreduced upper bidiagonal matrix, by the
    differential quotient-difference algorithm with shifts, smallest first as they converge."""
    q, e = [x * x for x in a], [x * x for x in b]
    found, shifted = [], 0.0

    def sweep(s: float) -> tuple[list[float], list[float], float] | None:
        """One transform with shift s; None if the shift is beyond the smallest value."""
        qs, es, dd = [], [], q[0] - s
        least = dd
        for i in range(len(q) - 1):
            if dd < 0:
                return None
            x = dd + e[i]
            if x == 0.0:
                return None if s else (qs + [0.0] + q[i + 1:], es + [0.0] + e[i + 1:], 0.0)
            t = q[i + 1] / x
            qs.append(x)
            es.append(e[i] * t)
            dd = dd * t - s
            least = min(least, dd)
        return None if dd < 0 else (qs + [dd], es, least)

    least = min(q)
    for _ in range(100 * len(q) + 100):
        while len(q) > 1 and e[-1] <= _EPS * _EPS * max(shifted + q[-1], 1e-300) + _EPS * min(q[-1], q[-2]) * 1e-3:
            found.append(shifted + q.pop())
            e.pop()
            least = min(q)
        if len(q) == 1:
            return found + [shifted + q[0]]
        # the smaller eigenvalue of the last two rows is near the smallest of all
        half = (q[-2] + e[-1] - q[-1]) / 2
        corner = q[-1] * (q[-2] / (half + q[-1] + math.hypot(half, math.sqrt(e[-1] * q[-1])))) if q[-1] else 0.0
        for s in (min(corner, least) * (1 - 4 * _EPS), min(corner, least) * 0.5, least * 0.125, 0.0):
            if s and s < _EPS * 1e-2 * shifted:
                continue
            done = sweep(s)
            if done is not None:
                q, e, least = done
                shifted += s
                break
    raise ArithmeticError("dqds did not converge")


def twisted(a: np.ndarray, b: np.ndarray, value: float, apart: list[np.ndarray]) -> np.ndarray:
    """The right singular vector of the bidiagonal (a, b) for a squared singular value: B'B less
    the value is factored from the top and from the bottom, and the vector solves the
    product that is twisted where the two meet best.  ``apart``: vectors of nearly
    equal values to which it is made orthogonal."""
    n, tiny = len(a), np.finfo(float).tiny / _EPS
    dd = a * a
    low = b / a[:-1]
    safe = lambda x: x if x != 0.0 else tiny
    s, p, lp, um = np.empty(n), np.empty(n), np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        lp[i] = dd[i] * low[i] / safe(s[i] + dd[i])
        s[i + 1] = lp[i] * low[i] * s[i] - value
    p[-1] = dd[-1] - value
    for i in range(n - 2, -1, -1):
        t = dd[i] / safe(dd[i] * low[i] * low[i] + p[i + 1])
        um[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    best, most = None, -1.0
    for at in np.argsort(np.abs(s + p + value), kind="stable")[:8 if apart else 1]:
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -lp[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -um[i] * z[i]
        z /= np.abs(z).max()
        z /= np.linalg.norm(z)
        left = z
        for _ in range(2):
            for y in apart:
                left = left - (y @ left) * y
        if np.linalg.norm(left) > most:
            best, most = left, np.linalg.norm(left)
        if most > 0.5:
            break
    return best / most


def solve(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, directions as columns, sum of all squares): the ``k`` largest
    that are not zero to working precision."""
    d = r.shape[1]
    total = float((r * r).sum())
    scale = np.abs(r).max(initial=0.0)
    if scale == 0:
        return np.zeros(0), np.zeros((d, 0)), total
    a, b, v = bidiagonal(r / scale)
    a = np.copysign(np.maximum(np.abs(a), _EPS * _EPS), a)
    b[np.abs(b) <= _EPS * 0.5 * (np.abs(a[:-1]) + np.abs(a[1:]))] = 0.0
    cuts = [0, *(np.flatnonzero(b == 0.0) + 1), d]
    values = []
    for lo, hi in zip(cuts, cuts[1:]):
        values += [(x, lo, hi) for x in dqds(a[lo:hi], b[lo:hi - 1])]
    values.sort(key=lambda x: (-x[0], x[1]))
    floor = (_EPS * d) ** 2 * values[0][0]
    values = [x for x in values[:k] if x[0] > floor]
    directions: list[tuple[float, int, np.ndarray]] = []
    for x, lo, hi in values:
        close = [z[lo:hi] for y, at, z in directions if at == lo and y - x <= 1e-3 * y]
        z = np.zeros(d)
        z[lo:hi] = twisted(a[lo:hi], b[lo:hi - 1], x, close)
        directions.append((x, lo, z))
    return (np.array([x for x, _, _ in values]) * scale * scale,
            v @ np.array([z for _, _, z in directions]).T, total)


# --- whitening --------------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """A fitted transform: row x becomes (x - S/n) @ directions / sqrt(values)."""
    n: int
    sums: list[int]
    values: np.ndarray        # eigenvalues of the covariance, falling
    directions: np.ndarray    # unit columns
    explained: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    def apply(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([s // self.n for s in self.sums])
        rest = np.array([float(s % self.n) for s in self.sums])
        return _centred(x, self.n, whole, rest) @ self.directions / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n*x - S)^2, exactly; null beyond a long."""
        low = [s // self.n for s in self.sums]   # n*x - S = n*(x - low) - (S - n*low)
        y = x - np.array(low)
        spread = self.n * int(np.abs(y).max(initial=0)) + self.n
        rest = np.array([s - self.n * l for s, l in zip(self.sums, low)])
        if spread * spread * self.dims < 1 << 63:
            z = self.n * y - rest
            return (z * z).sum(axis=1).tolist()
        exact = [sum((self.n * int(v) - int(r)) ** 2 for v, r in zip(row, rest)) for row in y]
        return [v if v < 1 << 63 else None for v in exact]


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """Distinct rows (x) of the commonest length, and that length (0 without rows)."""
    size = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = size.d if size else 0
    return write_shared(rows.filter(F.size("x") == d).select("x").distinct()), d


def fit(distinct: DataFrame, d: int, k: int) -> Whitening | None:
    """The whitening of the ``k`` leading components, or None without rows."""
    n, sums = _sums(distinct, d) if d else (0, [])
    if n == 0:
        return None
    values, directions, total = solve(_qr(distinct, d, n, sums), k)
    return Whitening(n, sums, values / n, directions, values / total if total else values)


def identity_error(distinct: DataFrame, w: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k, d = len(w.values), w.dims
    if k == 0:
        return 0.0

    def add(batches):
        c, s, n = np.zeros((k, k)), np.zeros(k), 0
        for _, x in _blocks(batches, d):
            z = w.apply(x)
            c, s, n = c + z.T @ z, s + z.sum(axis=0), n + len(z)
        if n:
            yield pa.RecordBatch.from_pydict({"at": list(range(k * k + k)), "v": np.concatenate([c.ravel(), s])})

    sums = distinct.select("x").mapInArrow(add, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(k * k + k)
    for r in sums:
        flat[r["at"]] = r.v
    mean = flat[k * k:] / w.n
    return float(np.abs(flat[:k * k].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, w: Whitening) -> DataFrame:
    """(id, deviation, whitened array) of rows (id, x) of the fitted length."""
    kind = dict(rows.dtypes)["id"]

    def apply(batches):
        for part, x in _blocks(batches, w.dims):
            z = w.apply(x)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(w.deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(np.arange(0, z.size + 1, max(z.shape[1], 1), dtype=np.int32) if z.shape[1]
                                          else np.zeros(len(z) + 1, np.int32), z.ravel())],
                names=["id", "deviation", "whitened"])

    return rows.filter(F.size("x") == w.dims).select("id", "x").mapInArrow(
        apply, f"id {kind}, deviation long, whitened array<double>")


def components(rows: DataFrame, k: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained,
    identity_error."""
    usable = usable_rows(rows, id_col, vector_col)
    distinct, d = fit_list(usable)
    w = fit(distinct, d, k)
    schema = f"{id_col} {dict(usable.dtypes)['id']}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if w is None:
        return rows.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, w)
    shares = F.array(*[F.lit(float(v)) for v in w.explained]).cast("array<double>")
    return whiten(usable, w).select(
        F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        id_col, (F.col("at") + 1).cast("int").alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
