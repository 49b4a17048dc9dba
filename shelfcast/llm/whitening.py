"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries become integers, so the sums, and the scatter about the rounded mean, are added up
exactly by Spark in any order: reruns agree.  The covariance V follows from these in exact
integers too (the rounded mean is less than one unit off, which is taken out before anything
is divided).  Pivoted Cholesky gives V = L L' with the largest remaining variance first and
shows the rank; rotations from the right then make L's columns orthogonal (one-sided Jacobi,
on the triangular factor itself, V is not touched again).  The rotated columns' squared norms
are the eigenvalues, the columns divided by their norms the components.

All that reaches the driver is sums over the dimensions and their pairs, whose number is a
property of the embedding, not of the rows.  The rows are read for the sums, for the scatter,
for the whitened covariance and for the result; nothing but small sums is shuffled.

Defined cases: rows whose vector is null, empty, or holds a null or non-finite entry are
dropped; the dimension is that of most vectors (of equally many, the larger), rows of another
length are dropped; entries whose 1024-fold is beyond 2**40 are clipped there; components of
no variance (below 1e-12 of the largest; all of them for a single row) are not returned, so
a table without variance gives no rows; repeated rows count each; a deviation beyond 64 bits
is given as the largest; an empty table gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import pick, staged

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
CLIP = float(1 << 40)
RANK = 1e-12               # of the largest eigenvalue
LIMB = 30
MOST = (1 << 63) - 1
SAFE = 1 << 26             # centred entries up to here multiply in 64 bits, some rows at a time


def integers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x: floor(1024 c) + 100000 of each entry; the dimension)."""
    good = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    kept = pick(vectors, "vec_id", "embedding").where(F.size("embedding") > 0).where(good)
    top = kept.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = top["dim"] if top else 0
    cell = lambda c: (F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(CLIP)), F.lit(-CLIP))) + SHIFT).cast("long")
    return kept.where(F.size("embedding") == dim).select("vec_id", F.transform("embedding", cell).alias("x")), dim


def _rows(b: pd.DataFrame) -> np.ndarray:
    return np.array(b["x"].tolist(), dtype=np.int64)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, total, k = (-1 if total < 0 else 1), abs(total), 0
    while total or not k:
        yield k, sign * (total & ((1 << LIMB) - 1))
        total >>= LIMB
        k += 1


def _added(parts: DataFrame) -> dict[tuple[int, int], int]:
    """Exact sums by (i, j) of what the tasks found."""
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("total").alias("total")).collect():
        out[r["i"], r["j"]] = out.get((r["i"], r["j"]), 0) + (r["total"] << LIMB * r["limb"])
    return out


SUMS = "i int, j int, limb int, total long"


def _emit(cells: Iterator[tuple[int, int, int]]) -> pd.DataFrame:
    return pd.DataFrame([(i, j, k, t) for i, j, total in cells for k, t in _limbs(total)], columns=["i", "j", "limb", "total"])


def sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, s = 0, [0] * dim
        for b in batches:
            if len(b):
                n, s = n + len(b), [a + int(x) for a, x in zip(s, _rows(b).sum(axis=0))]
        if n:
            yield _emit((i, 0, t) for i, t in enumerate([*s, n]))

    got = _added(rows.mapInPandas(add, SUMS))
    return got.get((dim, 0), 0), [got.get((i, 0), 0) for i in range(dim)]


def scatter(rows: DataFrame, middle: list[int]) -> list[list[int]]:
    """Sum over the rows of z z', z = x - middle, exactly."""
    dim, at = len(middle), np.array(middle, dtype=np.int64)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim), dtype=object)
        for b in batches:
            if not len(b):
                continue
            z = _rows(b) - at
            if np.abs(z).max() < SAFE:
                for k in range(0, len(z), 1 << 10):          # 2**26 * 2**26 * 2**10 < 2**63
                    total += (z[k:k + (1 << 10)].T @ z[k:k + (1 << 10)]).astype(object)
            else:
                total += z.T.astype(object) @ z.astype(object)
        yield _emit((i, j, int(total[i, j])) for i in range(dim) for j in range(i, dim))

    got = _added(rows.mapInPandas(add, SUMS))
    return [[got.get((min(i, j), max(i, j)), 0) for j in range(dim)] for i in range(dim)]


def covariance(n: int, s: list[int], middle: list[int], zz: list[list[int]]) -> np.ndarray:
    """V with divisor n, from n zz' - (sum z)(sum z)', which is exact."""
    rest = [t - n * m for t, m in zip(s, middle)]
    return np.array([[(n * zz[i][j] - rest[i] * rest[j]) / (n * n) for j in range(len(s))] for i in range(len(s))])


def pivoted_cholesky(v: np.ndarray, tolerance: float = RANK) -> np.ndarray:
    """L (dimensions x rank) with V = L L': each step takes the largest remaining variance."""
    left, factor = np.diag(v).copy(), []
    first = left.max(initial=0.0)
    for _ in range(len(v)):
        p = int(left.argmax())
        if left[p] <= tolerance * first or left[p] <= 0:
            break
        col = v[:, p] - sum((f * f[p] for f in factor), np.zeros(len(v)))
        col = col / np.sqrt(left[p])
        factor.append(col)
        left = np.maximum(left - col * col, 0.0)
        left[p] = 0.0
    return np.array(factor).T.reshape(len(v), len(factor))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues of L L', falling; unit components as columns): L's columns are rotated in
    pairs from the right until all are orthogonal."""
    a = factor.copy()
    for _ in range(sweeps):
        worst = 0.0
        for p in range(a.shape[1] - 1):
            for q in range(p + 1, a.shape[1]):
                x, y, g = a[:, p] @ a[:, p], a[:, q] @ a[:, q], a[:, p] @ a[:, q]
                if g == 0 or x == 0 or y == 0:
                    continue
                worst = max(worst, abs(g) / np.sqrt(x * y))
                if abs(g) <= 1e-16 * np.sqrt(x * y):
                    continue
                tau = (y - x) / (2 * g)
                t = (1.0 if tau >= 0 else -1.0) / (abs(tau) + np.sqrt(1 + tau * tau))
                c = 1 / np.sqrt(1 + t * t)
                a[:, p], a[:, q] = c * a[:, p] - c * t * a[:, q], c * t * a[:, p] + c * a[:, q]
        if worst < 1e-14:
            break
    values = (a * a).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    values = values[order]
    return values, a[:, order] / np.sqrt(np.maximum(values, 1e-300))


class Whitener:
    """The fitted transform: n, sums S, components (columns, at most 8) and their eigenvalues."""

    def __init__(self, n: int, s: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, s, values, vectors, trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        whole = np.array([t // self.n for t in self.sums], dtype=np.int64)
        part = np.array([t % self.n / self.n for t in self.sums])
        return ((x - whole) - part) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S)**2, exactly."""
        whole = np.array([t // self.n for t in self.sums], dtype=np.int64)
        rest = np.array([t % self.n for t in self.sums], dtype=np.int64)
        z = x - whole
        if ((int(np.abs(z).max(initial=0)) + 1) * self.n) ** 2 * len(whole) <= MOST:
            d = z * self.n - rest
            return np.einsum("ij,ij->i", d, d).tolist()
        return [min(sum((int(v) * self.n - r) ** 2 for v, r in zip(row, rest.tolist())), MOST) for row in z]


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener | None:
    """From the integer vectors; None where there are none or nothing varies."""
    n, s = sums(rows, dim)
    if not n:
        return None
    middle = [(2 * t + n) // (2 * n) for t in s]
    v = covariance(n, s, middle, scatter(rows, middle))
    values, vectors = one_sided_jacobi(pivoted_cholesky(v))
    some = min(components, int((values > RANK * values.max(initial=0)).sum())) if len(values) else 0
    return Whitener(n, s, values[:some], vectors[:, :some], float(np.trace(v))) if some else None


def identity_error(rows: DataFrame, fitted: Whitener) -> float:
    """Largest absolute entry of the whitened rows' covariance (about their mean) minus the identity."""
    k = len(fitted.values)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, mean, m2 = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            if not len(b):
                continue
            w = fitted.whitened(_rows(b))
            own, more = w.mean(axis=0), len(w)
            gap = own - mean
            m2 += (w - own).T @ (w - own) + np.outer(gap, gap) * n * more / (n + more)
            mean, n = mean + gap * more / (n + more), n + more
        yield pd.DataFrame({"n": [float(n)], "mean": [mean.tolist()], "m2": [m2.ravel().tolist()]})

    # Partial covariances by their parts; sums of a few numbers per task
    parts = rows.mapInPandas(add, "n double, mean array<double>, m2 array<double>").where("n > 0")
    total, grand = 0.0, np.zeros(k)
    got = parts.select(F.col("n"), F.posexplode("mean").alias("i", "m")).groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("m")).alias("s")).collect()
    for r in got:
        total, grand[r["i"]] = r["n"], r["s"] / r["n"]
    cell = F.explode(F.sequence(F.lit(0), F.lit(k * k - 1)))
    centre = F.array(*[F.lit(float(x)) for x in grand])
    part = parts.select("n", "mean", "m2", cell.alias("at")).withColumns({"i": F.floor(F.col("at") / k).cast("int"), "j": (F.col("at") % k).cast("int")})
    off = lambda c: F.get("mean", F.col(c)) - F.get(centre, F.col(c))
    cov = part.groupBy("i", "j").agg(F.sum(F.get("m2", F.col("at").cast("int")) + F.col("n") * off("i") * off("j")).alias("s")).collect()
    return max((abs(r["s"] / total - (r["i"] == r["j"])) for r in cov), default=0.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> tuple[DataFrame, Whitener | None]:
    """(vec_id, whitened: array of up to ``components`` numbers, deviation; the transform)."""
    kept, dim = integers(vectors)
    rows = staged(kept, "whitening-rows")
    fitted = fit(rows, dim, components)
    if fitted is None:
        return rows.where("false").select("vec_id", F.array().cast("array<double>").alias("whitened"),
                                          F.lit(0).cast("long").alias("deviation")), None

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = _rows(b)
                yield pd.DataFrame({"vec_id": b["vec_id"], "whitened": list(fitted.whitened(x)), "deviation": fitted.deviations(x)})

    fitted.identity_error = identity_error(rows, fitted)
    return rows.mapInPandas(project, "vec_id long, whitened array<double>, deviation long"), fitted


def whiten_vectors(vectors: DataFrame) -> DataFrame:
    """The digest: vec_id, component, n, deviation, whitened, explained, identity_error."""
    out, fitted = whiten(vectors)
    share = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.values]) if fitted else F.array(F.lit(0.0))
    return out.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n if fitted else 0).cast("long").alias("n"),
        "deviation", "whitened", F.get(share, F.col("at")).alias("explained"),
        F.lit(float(fitted.identity_error) if fitted else 0.0).alias("identity_error"))
