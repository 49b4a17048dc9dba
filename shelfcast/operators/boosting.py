"""Gradient-boosted regression trees grown leaf by leaf, on all rows.

Features are cut into at most ``bins`` bins once, and the rows are packed into blocks (a byte
per feature, the label, the sum of the trees so far).  A tree grows best-first: of all leaves
the one whose split lowers the squared error most is split next, up to ``leaves`` leaves.
What a split needs is a histogram per leaf and feature, the sum of residuals and the number
of rows in each bin: the tasks count it in their blocks, Spark adds the parts up, and the
driver gets leaves x features x bins numbers, however many rows there are.  Only the smaller
child of a split is counted, its sibling is the parent less that.  Leaves whose children may
be needed next are counted in the same pass, so a tree takes about as many passes as it is deep.

Residuals are added as integers (units of 2**-20), so sums don't depend on the order and the
trees are the same on any number of tasks.  Every ``refresh`` rounds the blocks are written
again with the sum of the trees, which cuts the lineage and survives lost executors.
"""
from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import scratch_path

# functions of this module travel to the executors with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNIT = float(1 << 20)
BLOCK_ROWS = 1 << 16
MAX_BINS = 255
FEW_TASKS = 16               # whose histograms (some MB each at most) may come to the driver as they are


@dataclass
class Tree:
    """Node i tests ``feature[i] <= cut``; ``left[i]`` is -1 for a leaf, whose value is ``value[i]``."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int) -> int:
        """Turn a leaf into a test; its children are the two nodes from the returned one."""
        first = len(self.left)
        self.feature[node], self.bin[node], self.left[node] = feature, at, first
        for column, blank in ((self.feature, -1), (self.bin, -1), (self.left, -1), (self.value, 0.0)):
            column.extend([blank, blank])
        return first

    def leaves(self) -> int:
        return sum(x < 0 for x in self.left)

    def route(self, binned: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        feature, at, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node = np.zeros(len(binned), dtype=np.int64)
        rows = np.arange(len(binned))
        while len(rows):
            rows = rows[left[node[rows]] >= 0]
            here = node[rows]
            node[rows] = left[here] + (binned[rows, feature[here]] > at[here])
        return node

    def predict(self, binned: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.route(binned)]


@dataclass
class BoostedTrees:
    """A fitted model: cuts of each feature, the mean of the labels and the trees (already scaled)."""
    features: list[str]
    cuts: list[np.ndarray]
    base: float
    rows: int                  # it was fitted on
    trees: list[Tree] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin of each value; what isn't a number counts as 0."""
        x = np.where(np.isnan(x), 0.0, x)
        return np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        binned, out = self.binned(x), np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.predict(binned)
        return out

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``prediction``."""
        model = self

        @F.pandas_udf("double")
        def predict(*columns: pd.Series) -> pd.Series:
            return pd.Series(model.predict(np.stack([c.to_numpy(dtype=np.float64, na_value=np.nan) for c in columns], axis=1)))

        return rows.withColumn("prediction", predict(*[F.col(c).cast("double") for c in self.features]))


def feature_cuts(rows: DataFrame, features: list[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """Between all values where a feature has few, else at quantiles; a split is "at most this"."""
    out, many = {}, []
    for f in features:
        few = [r[0] for r in rows.select(F.coalesce(F.col(f).cast("double"), F.lit(0.0))).distinct().limit(bins + 1).collect()]
        if len(few) > bins:
            many.append(f)
        else:
            out[f] = np.array(sorted(few)[:-1])
    if many:
        share = [i / bins for i in range(1, bins)]
        filled = rows.select(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in many])
        for f, q in zip(many, filled.approxQuantile(many, share, 1 / (4 * bins))):
            out[f] = np.unique(q)
    return [out[f] for f in features]


def _pack(model: BoostedTrees, label: str):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.stack([b[f].to_numpy(dtype=np.float64, na_value=np.nan) for f in model.features], axis=1) if len(b) else np.zeros((0, 1))
            if len(b):
                yield pd.DataFrame({"n": [len(b)], "x": [model.binned(x).tobytes()], "y": [b[label].to_numpy(dtype=np.float64).tobytes()],
                                    "sum": [np.full(len(b), model.base).tobytes()]})
    return pack


BLOCKS = "n int, x binary, y binary, sum binary"


def _unpack(row, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row.x, dtype=np.uint8).reshape(row.n, features), np.frombuffer(row.y, dtype=np.float64),
            np.frombuffer(row.sum, dtype=np.float64))


def _added_up(blocks: DataFrame, trees: list[Tree], features: int) -> DataFrame:
    """The blocks with ``trees`` added to their sums."""
    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sums = []
            for row in b.itertuples():
                x, _, total = _unpack(row, features)
                sums.append((total + sum(t.predict(x) for t in trees)).tobytes())
            yield b.assign(sum=sums)
    return blocks.mapInPandas(add, BLOCKS)


def _histograms(blocks: DataFrame, tasks: int, recent: list[Tree], tree: Tree, nodes: list[int], features: int) -> dict[int, np.ndarray]:
    """node -> array (features, 256, 2): sum of residuals (in units) and number of rows in each bin."""
    place = np.full(len(tree.left), -1)
    place[nodes] = np.arange(len(nodes))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = np.zeros((len(nodes), features, 256), dtype=np.int64)
        n = np.zeros_like(g)
        for b in batches:
            for row in b.itertuples():
                x, y, total = _unpack(row, features)
                at = place[tree.route(x)]
                some = at >= 0
                if not some.any():
                    continue
                rest = (y - total)[some]
                for t in recent:
                    rest = rest - t.predict(x[some])
                units = np.rint(rest * UNIT)
                for f in range(features):
                    key = at[some] * 256 + x[some, f]
                    # sums below 2**53 are exact in doubles
                    g[:, f] += np.bincount(key, weights=units, minlength=len(nodes) * 256).reshape(-1, 256).astype(np.int64)
                    n[:, f] += np.bincount(key, minlength=len(nodes) * 256).reshape(-1, 256)
        full = np.flatnonzero(n)
        yield pd.DataFrame({"cell": full, "g": g.ravel()[full], "n": n.ravel()[full]})

    parts = blocks.mapInPandas(count, "cell long, g long, n long")
    if tasks > FEW_TASKS:                                    # few parts are added up here, without a shuffle
        parts = parts.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
    got = parts.toArrow()
    out = np.zeros((len(nodes) * features * 256, 2), dtype=np.int64)
    np.add.at(out, got["cell"].to_numpy(), np.stack([got["g"].to_numpy(), got["n"].to_numpy()], axis=1))
    return dict(zip(nodes, out.reshape(len(nodes), features, 256, 2)))


def best_split(h: np.ndarray, least: int) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the split that lowers the squared error most, each side of
    ``least`` rows at least; of equal ones the first feature and bin.  None if none helps."""
    left = h.cumsum(axis=1).astype(np.float64)
    g, n = left[:, :, 0] / UNIT, left[:, :, 1]
    whole_g, whole_n = g[:, -1:], n[:, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g ** 2 / n + (whole_g - g) ** 2 / (whole_n - n) - whole_g ** 2 / whole_n
    gain = np.where((n >= least) & (whole_n - n >= least), gain, -np.inf)
    f, b = divmod(int(gain.argmax()), gain.shape[1])
    return (float(gain[f, b]), f, b) if gain[f, b] > 1e-9 else None


def grow(count, leaves: int, least: int) -> tuple[Tree, dict[int, np.ndarray]]:
    """One tree, best-first.  ``count(tree, nodes)`` gives the histograms of nodes of ``tree``.

    A pass counts the smaller children of every leaf that has been split, or that is among the
    next to be: these are split ahead, and taken back if better ones come up."""
    tree = Tree()
    known = count(tree, [0])
    heap: list[tuple[float, int]] = []                       # leaves by gain
    splits = {}

    def offer(node: int) -> None:
        splits[node] = best_split(known[node], least)
        if splits[node]:
            heapq.heappush(heap, (-splits[node][0], node))

    offer(0)
    ahead: dict[int, tuple[np.ndarray, np.ndarray]] = {}     # leaf -> its children's histograms
    while heap and tree.leaves() < leaves:
        _, node = heap[0]
        last = tree.leaves() + 1 == leaves                   # the last split's children need no histogram
        if node not in ahead and not last:
            want = [v for _, v in heapq.nsmallest(leaves - tree.leaves(), heap) if v not in ahead]
            trial = Tree([*tree.feature], [*tree.bin], [*tree.left], [*tree.value])
            asked = {}
            for v in want:
                _, f, b = splits[v]
                n_left, n_all = known[v][f, :b + 1, 1].sum(), known[v][f, :, 1].sum()
                asked[trial.split(v, f, b) + int(2 * n_left > n_all)] = (v, int(2 * n_left > n_all))
            got = count(trial, list(asked))
            for child, (v, right) in asked.items():
                pair = (known[v] - got[child], got[child]) if right else (got[child], known[v] - got[child])
                ahead[v] = pair
        heapq.heappop(heap)
        _, f, b = splits[node]
        first = tree.split(node, f, b)
        if last:
            # only the totals of its children are needed
            part = known[node][f, :b + 1].sum(axis=0)
            for child, total in ((first, part), (first + 1, known[node][f].sum(axis=0) - part)):
                h = np.zeros((1, 1, 2), dtype=np.int64)
                h[0, 0] = total
                known[child] = h
            break
        for child, h in zip((first, first + 1), ahead.pop(node)):
            known[child] = h
            offer(child)
    return tree, known


def fit(rows: DataFrame, features: list[str], label: str, rounds: int = 200, rate: float = 0.05, leaves: int = 31,
        least: int = 20, bins: int = MAX_BINS, refresh: int = 10) -> BoostedTrees:
    """Squared-error boosting on every row of ``rows`` (null features count as 0, null labels are left out)."""
    spark = rows.sparkSession
    data = rows.where(F.col(label).isNotNull()).select(
        *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features], F.col(label).cast("double").alias(label))
    mean, n = data.agg(F.avg(label), F.count(label)).first()
    if not n:
        raise ValueError("no rows to fit")
    model = BoostedTrees(list(features), feature_cuts(data, features, bins), float(mean), n)
    path = scratch_path(spark, "boosting")
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK_ROWS))
    try:
        data.mapInPandas(_pack(model, label), BLOCKS).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    blocks, recent = spark.read.schema(BLOCKS).parquet(path).cache(), []
    tasks = blocks.rdd.getNumPartitions()
    for done in range(1, rounds + 1):
        tree, known = grow(lambda t, nodes: _histograms(blocks, tasks, recent, t, nodes, len(features)), leaves, least)
        for node, first in enumerate(tree.left):
            if first < 0:
                g, n = known[node][0].sum(axis=0)
                tree.value[node] = rate * float(g) / UNIT / max(1, int(n))
        model.trees.append(tree)
        recent.append(tree)
        if len(recent) == refresh and done < rounds:
            path = scratch_path(spark, "boosting")
            _added_up(blocks, recent, len(features)).write.parquet(path)
            blocks.unpersist()
            blocks, recent = spark.read.schema(BLOCKS).parquet(path).cache(), []
        if tree.leaves() == 1:                               # nothing left to lower
            break
    blocks.unpersist()
    return model
