"""Clustering and whitening of vectors against brute force, and their defined cases."""
import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import simplex_cluster as sc
from shelfcast.llm import whitening as wh
from shelfcast.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def vector(seed, n=64, scale=1.0):
    return [float(x) for x in np.float32(np.random.default_rng(seed).normal(size=n) * scale)]


AWKWARD = [(i, vector(i), 0) for i in range(30)] + [
    (3, vector(3), 1), (3, vector(3), 1), (4, vector(99), 1), (None, vector(7), 1), (None, None, 1), (50, None, 0), (51, [], 0),
    (52, vector(1, 63), 0), (53, vector(1, 65), 0), (54, [*vector(1, 63), None], 0), (55, [*vector(1, 63), NAN], 0),
    (56, [*vector(1, 63), INF], 0), (57, [0.0] * 64, 0), (58, [0.0] * 64, 0)]


def brute_clusters(data, k=16, rounds=3):
    kept = []
    for i, e, *_ in data:
        if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(64 * x) for x in e]))
    key = lambda r: ((0, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest()) if r[0] is not None else (1, ""), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:k]]
    dist = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min(range(len(cents)), key=lambda j: (dist(v, cents[j]), j))
    for _ in range(rounds):
        at = [near(v) for _, v in kept]
        groups = {j: [v for (_, v), a in zip(kept, at) if a == j] for j in range(len(cents))}
        cents = [[sum(c) // len(g) for c in zip(*g)] if (g := groups[j]) else cents[j] for j in range(len(cents))]
    at = [near(v) for _, v in kept]
    d = [dist(v, cents[a]) for (_, v), a in zip(kept, at)]
    per = Counter()
    for a, x in zip(at, d):
        per[a] += x
    cut = lambda x: min(x, sc.MOST)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted([(i, a, cut(x), cut(per[a]), cut(sum(d)), sha[a]) for (i, _), a, x in zip(kept, at, d)], key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_clusters_defined_cases(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)
    assert rows(sc.cluster_vectors(df)) == brute_clusters(AWKWARD)
    wide = df.select("*", F.lit(1).alias("cluster"), F.lit(2).alias("Embedding"), F.lit(3).alias("v"))
    assert rows(sc.cluster_vectors(wide)) == brute_clusters(AWKWARD)
    assert sc.cluster_vectors(df.limit(0)).collect() == []
    few = [r for r in AWKWARD if r[0] in (1, 2, 57, 58)]
    assert rows(sc.cluster_vectors(spark.createDataFrame(few, SCHEMA))) == brute_clusters(few)


def test_clusters_of_huge_numbers(spark):
    data = [(i, vector(i, scale=10.0 ** (i % 12 * 3)), 0) for i in range(36)]
    assert rows(sc.cluster_vectors(spark.createDataFrame(data, SCHEMA))) == brute_clusters(data)


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(2)
    centres = rng.integers(-40, 40, (16, 64))
    v = (centres[rng.integers(0, 16, 600)] + rng.integers(-9, 9, (600, 64))).astype(float)
    cents = [c.tolist() for c in centres]
    simplex = sc.Simplex(cents)
    x, c = simplex.apex(v), simplex.apex(centres.astype(float))
    low, high = sc.bounds(x, c)
    true = np.sqrt(((v[:, None] - centres[None]) ** 2).sum(axis=2))
    assert (low <= true + 1e-6).all() and (true <= high + 1e-6).all()
    best, dist, made = sc.nearest(v, x, cents, c)
    assert (best == true.argmin(axis=1)).all() and (dist == (true.min(axis=1) ** 2).round()).all()
    assert made < 2 * len(v)                                   # of 16 a vector
    assert len(sc.Simplex([cents[0], cents[0], cents[1]]).pivots) == 2


def test_clusters_of_the_table(spark, sf_small):
    df = table(spark, sf_small, "embeddings")
    data = [tuple(r) for r in df.collect()]
    assert rows(sc.cluster_vectors(df)) == brute_clusters(data)


def brute_whitening(data, k=8):
    kept = [(i, np.array([math.floor(1024 * x) + 100_000 for x in e], dtype=object)) for i, e, *_ in data
            if e and all(x is not None and math.isfinite(x) for x in e)]
    dim = max(Counter(len(x) for _, x in kept).items(), key=lambda c: (c[1], c[0]))[0]
    kept = [(i, x) for i, x in kept if len(x) == dim]
    n, s = len(kept), sum(x for _, x in kept)
    dev = [min(int(sum((n * x - s) ** 2)), wh.MOST) for _, x in kept]
    z = np.array([[float(v) for v in (n * x - s)] for _, x in kept]) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:k]
    return kept, n, dev, z, values[order], vectors[:, order], values.sum()


def check_whitening(df, data):
    kept, n, dev, z, values, vectors, trace = brute_whitening(data)
    got = df.collect()
    some = min(8, int((values > 1e-9 * values[0]).sum()))
    assert len(got) == len(kept) * some and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, some + 1))
    assert Counter((r.vec_id, r.deviation) for r in got) == Counter({k: some * c for k, c in Counter(
        (i, d) for (i, _), d in zip(kept, dev)).items()})
    for c in range(some):
        part = sorted((r for r in got if r.component == c + 1), key=lambda r: (repr(r.vec_id), r.deviation))
        assert part[0].explained == pytest.approx(values[c] / trace, rel=1e-6)
        want = z @ vectors[:, c] / math.sqrt(values[c])
        want = [w for _, w in sorted(zip([(repr(i), d) for (i, _), d in zip(kept, dev)], want), key=lambda x: x[0])]
        mine = np.array([r.whitened for r in part])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_defined_cases(spark):
    data = [r for r in AWKWARD if r[0] not in (52, 53)] + [(60, vector(5, 3), 0)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    check_whitening(wh.whiten_vectors(df), data)
    wide = df.select("*", F.lit(1).alias("x"), F.lit(2).alias("Embedding"), F.lit(3).alias("component"))
    cut = lambda out: sorted(((*r[:4], round(r[4], 9) + 0.0, r[5]) for r in out.collect()), key=repr)
    assert cut(wh.whiten_vectors(wide)) == cut(wh.whiten_vectors(df.repartition(2)))            # exact sums: reruns agree
    assert wh.whiten_vectors(df.limit(0)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 5, SCHEMA)
    assert wh.whiten_vectors(same).collect() == []
    line = [(i, [i * 1.0, i * 2.0, 5.0], 0) for i in range(9)]
    check_whitening(wh.whiten_vectors(spark.createDataFrame(line, SCHEMA)), line)               # rank 1 of 3
    huge = [(i, vector(i, 4, 1e6), 0) for i in range(20)]
    check_whitening(wh.whiten_vectors(spark.createDataFrame(huge, SCHEMA)), huge)


def test_whitening_of_the_table(spark, sf_small):
    df = table(spark, sf_small, "embeddings")
    check_whitening(wh.whiten_vectors(df), [tuple(r) for r in df.collect()])


def test_factor_and_rotations():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(12, 12)) * np.logspace(0, -5, 12)
    v = a @ a.T
    factor = wh.pivoted_cholesky(v)
    assert np.allclose(factor @ factor.T, v, atol=1e-12)
    values, vectors = wh.one_sided_jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:len(values)], rtol=1e-10, atol=1e-13)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert wh.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)
