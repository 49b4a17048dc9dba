"""Centroid clustering in exact integers, filtered by an N-simplex projection.

Vectors are turned into integers once.  The first centroids serve as pivots too: each
vector's distances to them are measured once and kept as the coordinates of an apex over
the simplex that the pivots span (one coordinate per pivot, the last one the height).
Between two apexes the Euclidean distance is a lower bound of the true distance, and with
the second height mirrored an upper bound.  In every round a centroid is compared in full,
in integers, only if its lower bound does not exceed the least of the upper bounds;
everything else is ruled out by the bounds (with slack for rounding, so none is lost).

A round reads the written vectors once.  What moves are sums per cluster and component
from each batch, added up exactly by Spark in 32-bit limbs; the driver sees the centroids
only (their number and length are parameters).

Defined cases: rows whose vector is null, of another length, or holds a null or non-finite
entry (also one whose 64-fold is) are dropped; with fewer kept vectors than centroids each
is one; rows with equal ids come in the order of their components, a null id behind all
others; repeated rows count each; ties go to the smaller number; a distance or inertia
beyond a 64-bit integer is given as the largest one; an empty table gives an empty result;
extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import pick, staged

DIM, K, ROUNDS, SCALE = 64, 16, 3, 64
SMALL = float(1 << 27)     # up to here squared distances of DIM components fit 64 bits
LIMB = 32
MOST = (1 << 63) - 1
SLACK = 1e-6               # of a bound, for rounding


def integers(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component, as a double that holds the integer exactly."""
    cells = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    whole = F.transform("embedding", lambda x: x.cast("double") * scale)
    # floor() of a double beyond 64 bits saturates, and there every double is an integer already
    exact = F.zip_with(cells, whole, lambda c, w: F.when(F.abs(w) < float(1 << 62), c).otherwise(w))
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf")))
    return pick(vectors, "vec_id", "embedding").where(F.size("embedding") == dim).where(good).select(
        "vec_id", exact.alias("v"))


def first_centroids(kept: DataFrame, k: int = K) -> list[list[int]]:
    """The k vectors with the least hash of their id."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    return [[int(x) for x in r["v"]] for r in rows]


def squared(v: np.ndarray, c: list[int]) -> np.ndarray:
    """Exact squared distances of the rows of ``v`` from ``c``."""
    big = max(map(abs, c), default=0) >= SMALL or (len(v) and np.abs(v).max() >= SMALL)
    if not big:
        d = v.astype(np.int64) - np.array(c, dtype=np.int64)
        return np.einsum("ij,ij->i", d, d)
    out = np.empty(len(v), dtype=object)
    for i, row in enumerate(v):
        out[i] = sum((int(x) - y) ** 2 for x, y in zip(row, c))
    return out


class Simplex:
    """The pivots' simplex: row i holds pivot i's coordinates, nothing at or behind column i."""

    def __init__(self, pivots: list[list[int]]):
        self.pivots, base = [], np.zeros((0, 0))
        for p in pivots:
            if not self.pivots:
                self.pivots, base = [p], np.zeros((1, 0))
                continue
            d2 = [float(squared(np.array([p], dtype=np.float64), q)[0]) for q in self.pivots]
            apex = self._apex(base, np.sqrt(np.array([d2])))[0]
            if not np.isfinite(apex).all() or apex[-1] <= 1e-4 * np.sqrt(max(d2)):
                continue                                     # (nearly) within the others' span
            base = np.vstack([np.hstack([base, np.zeros((len(base), 1))]), apex])
            self.pivots.append(p)
        self.base = base

    @staticmethod
    def _apex(base: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Coordinates of objects (rows) with distances ``d`` to the pivots of ``base``."""
        out = np.zeros((len(d), base.shape[1] + 1))
        for k in range(1, len(base)):
            dot = (d[:, 0] ** 2 + (base[k] ** 2).sum() - d[:, k] ** 2) / 2
            out[:, k - 1] = (dot - out[:, :k - 1] @ base[k, :k - 1]) / base[k, k - 1]
        out[:, -1] = np.sqrt(np.maximum(0.0, d[:, 0] ** 2 - (out[:, :-1] ** 2).sum(axis=1)))
        return out

    def apex(self, v: np.ndarray) -> np.ndarray:
        d = np.stack([np.sqrt(squared(v, p).astype(np.float64)) for p in self.pivots], axis=1)
        return self._apex(self.base, d)


def bounds(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between the apexes ``x`` and ``c``."""
    flat = np.maximum(0.0, ((x[:, None, :-1] - c[None, :, :-1]) ** 2).sum(axis=2))
    h, g = x[:, -1][:, None], c[:, -1][None, :]
    return np.sqrt(flat + (h - g) ** 2), np.sqrt(flat + (h + g) ** 2)


def nearest(v: np.ndarray, x: np.ndarray, centroids: list[list[int]], c_apex: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, squared distance, comparisons made)."""
    with np.errstate(all="ignore"):
        low, high = bounds(x, c_apex)
        least = high.min(axis=1)[:, None]
        slack = SLACK * (1 + np.abs(x).sum(axis=1)[:, None] + np.abs(c_apex).sum(axis=1)[None, :])
        go = ~(low - slack > least + slack)                  # what isn't a number is compared
    best, dist, made = np.full(len(v), -1), np.full(len(v), -1, dtype=object if np.abs(v).max(initial=0) >= SMALL else np.int64), 0
    for j, c in enumerate(centroids):                        # in order, so ties stay with the smaller number
        at = np.flatnonzero(go[:, j])
        if not len(at):
            continue
        made += len(at)
        d = squared(v[at], c)
        if d.dtype == object and dist.dtype != object:
            dist = dist.astype(object)
        better = (best[at] < 0) | (d < dist[at])
        best[at[better]], dist[at[better]] = j, d[better]
    return best, dist, made


def _matrix(b: pd.DataFrame, column: str) -> np.ndarray:
    return np.array(b[column].tolist(), dtype=np.float64)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, total, k = (-1 if total < 0 else 1), abs(total), 0
    while total or not k:
        yield k, sign * (total & ((1 << LIMB) - 1))
        total >>= LIMB
        k += 1


def _sums(centroids: list[list[int]], c_apex: np.ndarray):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, list] = {}
        for b in batches:
            if not len(b):
                continue
            v = _matrix(b, "v")
            at, _, _ = nearest(v, _matrix(b, "apex"), centroids, c_apex)
            exact = v.astype(np.int64) if np.abs(v).max() < SMALL else np.vectorize(int, otypes=[object])(v)
            for j in np.unique(at).tolist():
                some = exact[at == j]
                n, s = totals.get(j, (0, [0] * v.shape[1]))
                totals[j] = n + len(some), [a + int(x) for a, x in zip(s, some.sum(axis=0))]
        yield pd.DataFrame([(j, d, k, limb) for j, (n, s) in totals.items()
                            for d, t in enumerate([n, *s]) for k, limb in _limbs(t)],
                           columns=["cluster", "dim", "limb", "total"])
    return count


def moved(vectors: DataFrame, centroids: list[list[int]], c_apex: np.ndarray) -> list[list[int]]:
    """Each centroid replaced by the floor of its vectors' mean, component by component."""
    parts = vectors.mapInPandas(_sums(centroids, c_apex), "cluster int, dim int, limb int, total long")
    sums: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("cluster", "dim", "limb").agg(F.sum("total").alias("total")).collect():
        of = sums.setdefault(r["cluster"], {})
        of[r["dim"]] = of.get(r["dim"], 0) + (r["total"] << LIMB * r["limb"])
    return [[sums[j][d + 1] // sums[j][0] for d in range(len(c))] if j in sums else c for j, c in enumerate(centroids)]


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[int]], Simplex | None]:
    """(vec_id, cluster, distance, compared; the final centroids; the simplex).

    ``compared``: how many centroids the row's batch compared in full, per row."""
    kept = integers(vectors)
    centroids = first_centroids(kept, k)
    if not centroids:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("decimal(38,0)").alias("distance"),
                           F.lit(0.0).alias("compared")), [], None
    simplex = Simplex(centroids)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(apex=list(simplex.apex(_matrix(b, "v"))) if len(b) else pd.Series([], dtype=object))

    laid = staged(kept.mapInPandas(place, "vec_id long, v array<double>, apex array<double>"), "simplex-vectors")
    at = lambda cs: simplex.apex(np.array(cs, dtype=np.float64))
    for _ in range(rounds):
        centroids = moved(laid, centroids, at(centroids))
    final, c_apex = centroids, at(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            best, dist, made = nearest(_matrix(b, "v"), _matrix(b, "apex"), final, c_apex)
            yield pd.DataFrame({"vec_id": b["vec_id"], "cluster": best.astype(np.int32),
                                "distance": [str(min(int(d), MOST)) for d in dist], "compared": made / len(b)})

    out = laid.mapInPandas(assign, "vec_id long, cluster int, distance string, compared double")
    return out.withColumn("distance", F.col("distance").cast("decimal(38,0)")), centroids, simplex


def cluster_vectors(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """The digest: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    assigned, centroids, _ = cluster(vectors, k, rounds)
    assigned = staged(assigned.select("vec_id", "cluster", "distance"), "simplex-assigned")
    per = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    long = lambda x: min(x, MOST)
    named = [(j, long(s), long(sum(per.values())), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
             for j, s in sorted(per.items())]
    facts = vectors.sparkSession.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(                # k rows
        "vec_id", "cluster", F.col("distance").cast("long").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = K, rounds: int = ROUNDS) -> str:
    """All distances in every round, without any bound."""
    near = ("n{r} AS (SELECT id, min_by(c, d * {k} + c) AS c, min(d) AS d FROM (SELECT v.id, m.c, "
            "list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - m.x[i]) * (v.x[i] - m.x[i]))) AS d FROM v CROSS JOIN m{r} m) GROUP BY id)")
    step = ("m{s} AS (SELECT m.c, coalesce(u.x, m.x) AS x FROM m{r} m LEFT JOIN (SELECT c, list(y ORDER BY i) AS x FROM ("
            "SELECT c, i, CAST((sum(x[i]) - (((sum(x[i]) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS y "
            "FROM n{r} JOIN v USING (id), (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i) GROUP BY c) u ON u.c = m.c)")
    parts = ["""v AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda e: CAST(floor(CAST(e AS DOUBLE) * 64) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64 AND list_count(embedding) = 64 AND len(list_filter(embedding, lambda e: isfinite(e))) = 64)""",
             f"""m0 AS (SELECT CAST(row_number() OVER (ORDER BY h, x) - 1 AS INTEGER) AS c, x FROM (
  SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {k}))"""]
    for r in range(rounds):
        parts += [near.format(r=r, k=k), step.format(r=r, s=r + 1)]
    parts += [near.format(r=rounds, k=k), f"t AS (SELECT c, sum(d) AS s FROM n{rounds} GROUP BY c)"]
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.vec_id, n.c AS cluster, CAST(n.d AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM n{rounds} n JOIN v USING (id) JOIN t USING (c) JOIN m{rounds} m USING (c)"""


ORACLE = _oracle()
