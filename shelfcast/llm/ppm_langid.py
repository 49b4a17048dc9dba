"""Language ID by prediction by partial matching (PPM).

For each language a context tree over bytes holds how often each byte follows each
context of 0 to ``ORDER`` bytes.  A text's code length under a language is the sum,
over its bytes, of the exact PPM cost with escape method C: in the longest context
seen, a byte met c times of n (d different ones) costs log2((n + d) / c) bits; an
unseen one costs the escape, log2((n + d) / d), and the next shorter context
decides; below order 0 a byte costs 8 bits.  The statistics are frozen: scoring
does not update them.  The shortest code wins; the score is its posterior share.

Counting is a Spark aggregation over a sample bounded by ``TRAIN_DOCS`` documents a
language (by hash of doc_id, whole texts); the counts of that sample are the model
that is broadcast, so its size does not grow with the corpus.  Scoring reads every
whole text once and moves nothing.

Defined cases: null and letterless texts are ``und`` with score 0; a table without
any labelled row makes every text ``und``; a null doc_id is never learned from and
not held out; ties go to the first language in code point order; an empty table
gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hash52, pick, small_batches
from shelfcast.operators.joins import bounded_broadcast

ORDER = 3
TRAIN_DOCS = 300
CHUNK_BYTES = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def has_letter(text: str) -> bool:
    """Any code point of the letter categories; digits like \u00b2 or \u00bd are none."""
    return any(map(str.isalpha, text))


def contexts(raw: bytes) -> np.ndarray:
    """For every byte its context of ORDER bytes and itself, as one integer (0 before the text)."""
    b = np.frombuffer(bytes(ORDER) + raw, dtype=np.uint8).astype(np.uint32)
    n = len(raw)
    key = np.zeros(n, dtype=np.uint32)
    for k in range(ORDER + 1):
        key = (key << np.uint32(8)) | b[k:k + n]
    return key


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for lang, part in batch.groupby("lang"):
            keys = np.concatenate([contexts(t.lower().encode()) for t in part["text"]])
            got, n = np.unique(keys, return_counts=True)
            yield pd.DataFrame({"lang": lang, "key": got.astype(np.int64), "n": n.astype(np.int64)})


class Model:
    """Counts of every order, from the counts of the longest contexts."""

    def __init__(self, langs: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        self.tables = []
        for lang in self.langs:
            at = langs == lang
            k, n = keys[at].astype(np.uint32), counts[at].astype(np.float64)
            orders = []
            for order in range(ORDER, -1, -1):
                k = k & np.uint32((1 << 8 * (order + 1)) - 1)
                k, inv = np.unique(k, return_inverse=True)
                n = np.bincount(inv, weights=n, minlength=len(k))
                ctx, inv = np.unique(k >> np.uint32(8), return_inverse=True)
                orders.append((order, k, n, ctx, np.bincount(inv, weights=n), np.bincount(inv).astype(np.float64)))
            self.tables.append(orders)

    @classmethod
    def of(cls, langs: list, tables: list) -> "Model":
        """From plain parts, as broadcast."""
        model = cls.__new__(cls)
        model.langs, model.tables = langs, tables
        return model

    def bits(self, keys: np.ndarray, lang: int) -> np.ndarray:
        """Cost of each key's last byte behind its context."""
        cost, todo = np.zeros(len(keys)), np.arange(len(keys))
        for order, k, n, ctx, total, kinds in self.tables[lang]:
            cut = keys[todo] & np.uint32((1 << 8 * (order + 1)) - 1)
            at = np.minimum(np.searchsorted(ctx, cut >> np.uint32(8)), len(ctx) - 1)
            known = ctx[at] == cut >> np.uint32(8)
            where = np.minimum(np.searchsorted(k, cut), len(k) - 1)
            hit = k[where] == cut
            both = total[at] + kinds[at]
            cost[todo[hit]] += np.log2(both[hit] / n[where[hit]])
            miss = known & ~hit
            cost[todo[miss]] += np.log2(both[miss] / kinds[at[miss]])
            todo = todo[~hit]
            if not len(todo):
                return cost
        cost[todo] += 8.0
        return cost

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text under each language: one row per text, one column per language."""
        out = np.zeros((len(texts), len(self.langs)))
        parts, owner, held = [], [], 0

        def flush():
            keys = np.concatenate(parts)
            kinds, inv = np.unique(keys, return_inverse=True)
            rows = np.repeat(np.array(owner), [len(p) for p in parts])
            for j in range(len(self.langs)):
                out[:, j] += np.bincount(rows, weights=self.bits(kinds, j)[inv], minlength=len(texts))

        for i, t in enumerate(texts):
            keys = contexts(t.lower().encode("utf-8", "replace"))
            for at in range(0, len(keys), CHUNK_BYTES):          # contexts are already in the keys
                parts.append(keys[at:at + CHUNK_BYTES])
                owner.append(i)
                held += len(parts[-1])
                if held >= CHUNK_BYTES:
                    flush()
                    parts, owner, held = [], [], 0
        if parts:
            flush()
        return out


def fit_ppm(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    small_batches(docs.sparkSession)
    rows = pick(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chance = hash52(F.lit("ppm"), F.col("doc_id")) / float(1 << 52)
    sample = (rows.join(bounded_broadcast(sizes, 10_000), "lang")
              .where(chance * F.col("n") < train_docs)
              # of a doc_id's rows in a language one, the least by hash: a repeated row counts once
              .groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("th"), "text")).alias("first"))
              .select("lang", "first.text"))
    counts = (sample.mapInPandas(_count, "lang string, key long, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow())
    return Model(np.array(counts["lang"].to_pylist(), dtype=object), counts["key"].to_numpy(), counts["n"].to_numpy())


def identify(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits (code length): one row for each row of ``docs``."""
    spark = docs.sparkSession
    fitted = fit_ppm(docs, train_docs)
    parts = spark.sparkContext.broadcast((fitted.langs, fitted.tables))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model.of(*parts.value)
        for b in batches:
            texts = [t if isinstance(t, str) and has_letter(t) else "" for t in b["text"]]
            langs, scores, bits = ["und"] * len(b), np.zeros(len(b)), np.zeros(len(b))
            if m.langs:
                cost = m.code_lengths(texts)
                best = cost.argmin(axis=1)
                share = 1 / np.exp2(np.maximum(cost[np.arange(len(b)), best][:, None] - cost, -1000)).sum(axis=1)
                for i, t in enumerate(texts):
                    if t:
                        langs[i], scores[i], bits[i] = m.langs[best[i]], round(float(share[i]), 6), round(cost[i, best[i]], 3)
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "lang_pred": langs, "score": scores, "bits": bits})

    return pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInPandas(
        score, "doc_id long, held_out boolean, lang_pred string, score double, bits double")
