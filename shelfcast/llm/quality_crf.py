"""Quality classifier: a linear-chain conditional random field over a text's lines.

Every line is labelled good or bad from features of its own and of the lines before
and behind it, with a transition weight between neighbouring labels.  Forward and
backward passes give each line's marginal; a document's score is the mean marginal
of ``good``, weighted by the lines' lengths.

The field is fitted on the lines of at most ``TRAIN_DOCS`` labelled documents (least
hash of doc_id, one row of each; a line takes its document's label), never on held-out ones.
Features are extracted on the executors; only this bounded sample's features come to
the driver.  Scoring reads every whole text once and moves nothing.

Defined cases: null, empty and blank texts score 0; a null doc_id is not held out and
never learned from; of several labels of a doc_id the least counts; without usable
labels every text scores 0; an empty table gives an empty result; extra columns are
ignored; repeated rows get equal results.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hash52, pick, small_batches

TRAIN_DOCS = 3000
TRAIN_CHAIN = 128          # lines of one training chain; longer documents give several
STEPS = 120
THRESHOLD = 0.7
L2 = 1.0
SYMBOLS = b"#*%&$@~^=+<>{}[]\\"
UPPER, DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
OWN = 11                   # features of a line itself


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features, lengths) of the text's lines that aren't blank."""
    rows, lengths, seen = [], [], set()
    for line in text.encode("utf-8", "replace").split(b"\n"):
        words = line.split()
        if not words:
            continue
        n, w, kinds = len(line), len(words), len(set(words))
        without = lambda chars, line=line, n=n: (n - len(line.translate(None, chars))) / n
        rows.append((min(n, 2000) / 200, without(UPPER), without(DIGITS), without(SYMBOLS),
                     line.count(b"!") / w, line.count(b"|") / w, min(n / w, 40) / 10, kinds / w,
                     kinds / w if w >= 8 else 1.0, float(line in seen), float(line.rstrip()[-1:] in b".!?")))
        lengths.append(n)
        seen.add(line)
    return np.array(rows, dtype=np.float64).reshape(-1, OWN), np.array(lengths, dtype=np.float64)


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and behind (zero at the ends), and the end marks."""
    zero, n = np.zeros((1, x.shape[1])), len(x)
    ends = np.zeros((n, 2))
    ends[0, 0] = ends[-1, 1] = 1
    return np.hstack([x, np.vstack([zero, x[:-1]]), np.vstack([x[1:], zero]), ends])


def forward_backward(unary: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals (chains, steps, 2) and the summed pair marginals (2, 2).

    ``unary`` is padded to the longest chain; the padding counts for nothing."""
    m, steps, _ = unary.shape
    on = np.arange(steps)[None, :] < lengths[:, None]
    pot = np.where(on[:, :, None], np.exp(unary - unary.max(axis=2, keepdims=True)), 1.0)
    a = np.exp(trans - trans.max())
    alpha, beta = np.empty_like(pot), np.ones_like(pot)
    alpha[:, 0] = pot[:, 0]
    alpha[:, 0] /= alpha[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        x = np.where(on[:, t, None], (alpha[:, t - 1] @ a) * pot[:, t], alpha[:, t - 1])
        alpha[:, t] = x / x.sum(axis=1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        x = np.where(on[:, t + 1, None], (pot[:, t + 1] * beta[:, t + 1]) @ a.T, 1.0)
        beta[:, t] = x / x.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(axis=2, keepdims=True)
    pair = alpha[:, :-1, :, None] * a * (pot[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= np.maximum(pair.sum(axis=(2, 3), keepdims=True), 1e-300)
    return gamma, (pair * on[:, 1:, None, None]).sum(axis=(0, 1))


def padded(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(c) for c in chains])
    out = np.zeros((len(chains), lengths.max(), chains[0].shape[1]))
    for i, c in enumerate(chains):
        out[i, :len(c)] = c
    return out, lengths


class Field:
    """Weights of the fitted field."""

    def __init__(self, mean, spread, weights, trans):
        self.mean, self.spread, self.weights, self.trans = mean, spread, weights, trans

    def unary(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights[:-1] + self.weights[-1]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        lines = [line_features(t) if isinstance(t, str) else (np.zeros((0, OWN)), np.zeros(0)) for t in texts]
        by_size: dict[int, list[int]] = {}
        for i, (x, _) in enumerate(lines):
            if len(x):
                by_size.setdefault(len(x).bit_length(), []).append(i)    # padding at most doubles a chain
        for rows in by_size.values():
            for at in range(0, len(rows), 256):
                some = rows[at:at + 256]
                unary, n = padded([self.unary(with_neighbours(lines[i][0])) for i in some])
                gamma, _ = forward_backward(unary, self.trans, n)
                for j, i in enumerate(some):
                    out[i] = float(gamma[j, :n[j], 1] @ lines[i][1] / lines[i][1].sum())
        return np.clip(np.round(out, 6), 0, 1)


def fit_field(chains: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, l2: float = L2) -> Field:
    """Penalised maximum likelihood by gradient ascent with momentum and scaled steps (Adam)."""
    x, n = padded(chains)
    on = np.arange(x.shape[1])[None, :] < n[:, None]
    mean, spread = x[on].mean(axis=0), x[on].std(axis=0) + 1e-6
    x = np.where(on[:, :, None], (x - mean) / spread, 0.0)
    x = np.concatenate([x, on[:, :, None].astype(float)], axis=2)
    y = np.stack([labels == 0, labels == 1], axis=1).astype(float)[:, None, :] * on[:, :, None]
    pairs = np.zeros((2, 2))
    for k in (0, 1):
        pairs[k, k] = (n - 1)[labels == k].sum()
    flat = x.reshape(-1, x.shape[2])
    theta = np.zeros(x.shape[2] * 2 + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    total = float(on.sum())
    for step in range(1, steps + 1):
        w, trans = theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2)
        gamma, seen = forward_backward((flat @ w).reshape(*on.shape, 2), trans, n)
        grad_w = flat.T @ ((y - gamma) * on[:, :, None]).reshape(-1, 2)
        grad = (np.concatenate([grad_w.ravel(), (pairs - seen).ravel()]) - l2 * theta) / total
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Field(mean, spread, theta[:-4].reshape(-1, 2), theta[-4:].reshape(2, 2))


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(int(d), int(q), x.ravel().tolist()) for d, q, t in zip(b["doc_id"], b["quality"], b["text"])
                for x in [line_features(t)[0]] if len(x)]
        yield pd.DataFrame(rows, columns=["doc_id", "quality", "x"])


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Field | None:
    small_batches(docs.sparkSession)
    known = (pick(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IN (0, 1)")
             .where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
             .orderBy(hash52(F.lit("crf"), F.col("doc_id")), "doc_id").limit(train_docs))
    # of a doc_id's rows one, the least by hash: the bound is one on rows
    first = F.min(F.struct(F.xxhash64("text").alias("th"), "text")).alias("first")
    sample = (pick(docs, "doc_id", "text").where("text IS NOT NULL").join(F.broadcast(known), "doc_id")
              .groupBy("doc_id", "quality").agg(first).select("doc_id", "quality", "first.text"))
    got = sample.select("doc_id", "quality", "text").mapInPandas(_lines, "doc_id long, quality int, x array<double>").toArrow()
    if not got.num_rows or len(set(got["quality"].to_pylist())) < 2:
        return None
    rows = sorted(zip(got["doc_id"].to_pylist(), got["quality"].to_pylist(), got["x"].to_pylist()))
    chains, ys = [], []
    for _, q, x in rows:
        whole = with_neighbours(np.array(x).reshape(-1, OWN))
        for at in range(0, len(whole), TRAIN_CHAIN):
            chains.append(whole[at:at + TRAIN_CHAIN])
            ys.append(q)
    return fit_field(chains, np.array(ys))


def classify(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",),
             train_docs: int = TRAIN_DOCS) -> DataFrame:
    """The columns ``keep`` of ``docs``, held_out, score, predicted: one row for each row of ``docs``."""
    fitted = train(docs, labels, train_docs)
    parts = docs.sparkSession.sparkContext.broadcast(
        fitted and (fitted.mean, fitted.spread, fitted.weights, fitted.trans))
    cols = list(dict.fromkeys([*keep, "doc_id", "text"]))
    rows = pick(docs, *cols).withColumn("held_out", held_out(F.col("doc_id")))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if parts.value is None:
            return pd.Series(np.zeros(len(texts)))
        return pd.Series(Field(*parts.value).scores([t if isinstance(t, str) else None for t in texts]))

    scored = rows.withColumn("score", score("text"))
    return scored.select(*keep, "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
