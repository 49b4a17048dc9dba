"""Benchmark decontamination: a BM25 index of the test items searched by block-max WAND.

The test items are indexed, not the corpus.  Every document is cut into passages
that overlap by half, each twice as long as the longest item, so that an item lies
whole in some passage; each passage is a query.  An item's BM25 scores are divided
by the score of its own words, so one threshold holds for all items.  Postings lie
in blocks of items; a passage whose terms' block maxima don't reach the threshold
skips that block, and within the others WAND moves from pivot to pivot.  All items
above the threshold are retrieved, then verified: the words of question and answer
must be in the passage, each with at least ``OVERLAP`` of its five-word shingles, or that
much of the item as a whole (so a copy whose short last sentence is cut or edited counts).

Repeated items are indexed once and joined back.  The index is broadcast in slices of at most
``SLICE_ITEMS`` items and ``SLICE_BYTES`` of text (and one item), one after the other: the driver and the
tasks hold one slice at a time.  The documents, the larger side, are read once per
slice and never moved.

Words are runs of letters and digits, lower-cased.  An item's answer is its last
sentence if there are several (a part shorter than five words is one shingle).

Defined cases: null and word-free texts and items match nothing; an item above ``SLICE_BYTES`` is refused; repeated documents
are each reported, repeated items too; an empty corpus or benchmark gives an empty
result; extra columns are ignored; rows with null ids are reported under null.
"""
from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import pick, small_batches, staged
from shelfcast.operators import prefix

K1, B = 1.2, 0.75
THRESHOLD = 0.6            # of an item's own score
OVERLAP = 0.8              # of the five-word shingles
SHINGLE = 5
BLOCK_ITEMS = 4
SLICE_ITEMS = 2_000
SLICE_BYTES = 4 << 20
SLACK = 1e-4               # of the bounds, which are summed in single precision
TOKEN = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if isinstance(text, str) else []


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(SHINGLE)]))


def question_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer (the last sentence, if there are several)."""
    parts = [p for p in (tokens(s) for s in SENTENCE.split(text.strip())) if p]
    if len(parts) < 2:
        return [w for p in parts for w in p], []
    return [w for p in parts[:-1] for w in p], parts[-1]


def found(part: set, words: list[str], have: set) -> float:
    """Share of the part's shingles that the passage has."""
    if not part:
        return 1.0
    short = [s for s in part if len(s) < SHINGLE]
    if short:                                        # a part of fewer words: as a run of words
        n, run = len(short[0]), short[0]
        return float(any(tuple(words[i:i + n]) == run for i in range(len(words) - n + 1)))
    return len(part & have) / len(part)


class Index:
    """BM25 postings of the items, as shares of each item's own score, with block maxima."""

    def __init__(self, items: list[tuple[int | None, str]], n_items: int, df: dict[str, int], mean_len: float):
        kept = [(i, t, tokens(t)) for i, t in items]
        kept = sorted((x for x in kept if x[2]), key=lambda x: len(x[2]))   # alike lengths share blocks
        self.ids = [x[0] for x in kept]
        self.parts = [tuple(shingles(p) for p in (*question_answer(x[1]), x[2])) for x in kept]
        self.longest = max((len(x[2]) for x in kept), default=0)
        self.blocks = -(-len(kept) // BLOCK_ITEMS)
        raw = []
        for _, _, words in kept:
            norm = K1 * (1 - B + B * len(words) / mean_len)
            row = {w: math.log(1 + (n_items - df[w] + 0.5) / (df[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                   for w, n in Counter(words).items()}
            own = sum(row.values())
            raw.append({w: x / own for w, x in row.items()})
        self.terms: dict[str, int] = {}
        postings: list[list[tuple[int, float]]] = []
        for item, row in enumerate(raw):
            for w, share in row.items():
                t = self.terms.setdefault(w, len(self.terms))
                if t == len(postings):
                    postings.append([])
                postings[t].append((item, share))
        self.postings = [defaultdict(list) for _ in postings]              # term -> block -> [(item, share)]
        self.maxima = np.zeros((len(postings), self.blocks), dtype=np.float32)
        for t, row in enumerate(postings):
            for item, share in row:
                b = item // BLOCK_ITEMS
                self.postings[t][b].append((item, share))
                self.maxima[t, b] = max(self.maxima[t, b], share * (1 + 1e-6))

    def wand(self, terms: list[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """All items of the block whose score for the terms reaches the threshold."""
        lists = [[self.postings[t][block], 0, float(self.maxima[t, block])] for t in terms]
        out = []
        while lists:
            lists.sort(key=lambda c: c[0][c[1]][0])
            bound, pivot = 0.0, -1
            for i, c in enumerate(lists):
                bound += c[2]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][1]][0]
            if lists[0][0][lists[0][1]][0] == item:
                score = 0.0
                for c in lists:
                    if c[0][c[1]][0] != item:
                        break
                    score += c[0][c[1]][1]
                    c[1] += 1
                if score >= threshold:
                    out.append((item, score))
            else:                                     # move the lists before the pivot up to its item
                for c in lists[:pivot]:
                    while c[1] < len(c[0]) and c[0][c[1]][0] < item:
                        c[1] += 1
            lists = [c for c in lists if c[1] < len(c[0])]
        return out

    def search(self, texts: list[str | None], threshold: float = THRESHOLD,
               overlap: float = OVERLAP) -> list[tuple[int, int, float, float, float, float]]:
        """(text, item, score, shares of question, answer and whole item) of the verified matches, best passage each."""
        if not self.ids:
            return []
        half, get = self.longest, self.terms.get
        words_of, owner, first, ids, seg = [], [], [], [], []
        for i, text in enumerate(texts):
            words = tokens(text)
            words_of.append(words)
            for at in range(0, len(words), half):
                known = {t for t in map(get, words[at:at + half]) if t is not None}
                ids.extend(known)
                seg.extend([len(owner)] * len(known))
                owner.append(i)
                first.append(at)
        if not ids:
            return []
        # block maxima summed over each half passage; a passage is a half and the next one
        seg_a, ids_a, owner_a = np.array(seg), np.array(ids), np.array(owner)
        bound = np.zeros((len(owner), self.blocks), dtype=np.float32)
        starts = np.flatnonzero(np.diff(seg_a, prepend=-1))
        for at in range(0, len(starts), 2048):        # rows of maxima for some halves at a time
            lo, hi = starts[at], starts[at + 2048] if at + 2048 < len(starts) else len(ids_a)
            bound[seg_a[starts[at:at + 2048]]] = np.add.reduceat(self.maxima[ids_a[lo:hi]], starts[at:at + 2048] - lo, axis=0)
        nxt = np.zeros_like(bound)
        same = owner_a[1:] == owner_a[:-1]
        nxt[:-1][same] = bound[1:][same]
        best: dict[tuple[int, int], tuple[float, ...]] = {}
        for s in np.flatnonzero((bound + nxt >= threshold - SLACK).any(axis=1)):
            i, at = owner[s], first[s]
            words, have = words_of[i][at:at + 2 * half], None
            terms = np.array(sorted({t for t in map(get, words) if t is not None}))
            # the halves' sum counts a word of both twice; the passage's own bound doesn't
            for b in np.flatnonzero(self.maxima[terms].sum(axis=0) >= threshold - SLACK):
                for item, score in self.wand(terms[self.maxima[terms, b] > 0].tolist(), int(b), threshold):
                    have = shingles(words) if have is None else have
                    q, a, whole = (found(p, words, have) for p in self.parts[item])
                    if (min(q, a) >= overlap or whole >= overlap) and (score, q, a, whole) > best.get((i, item), (0.0,)):
                        best[i, item] = (score, q, a, whole)
        return [(i, item, *x) for (i, item), x in sorted(best.items())]


def _items(benchmark: DataFrame) -> DataFrame:
    """item, text, w (its words), slice: distinct texts that have words; written, so that numbers stay."""
    small_batches(benchmark.sparkSession)

    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(tokens)

    texts = pick(benchmark, "text").where("text IS NOT NULL").distinct().select(
        F.xxhash64("text").alias("h"), "text", F.octet_length("text").cast("long").alias("bytes"), F.lit(1).cast("long").alias("one"))
    numbered = prefix.running(texts, [("h", True), ("text", True)], {"item": ("sum", "one"), "before": ("sum", "bytes")}, exclusive=True)
    # both counts only grow, so rows with one sum of quotients share both: a slice is within both bounds
    cut = F.expr(f"item DIV {SLICE_ITEMS}") + F.expr(f"before DIV {SLICE_BYTES}")
    return staged(numbered.select(F.col("item").cast("long").alias("item"), "text", "bytes", cut.cast("long").alias("slice"),
                                  words("text").alias("w")).where(F.size("w") > 0), "decontam-items")


def _slices(items: DataFrame) -> Iterator[Broadcast]:
    """Arguments of the index of each slice in turn; the one before is released."""
    spark = items.sparkSession
    n_items, n_words, largest = items.agg(F.count(F.lit(1)), F.sum(F.size("w")), F.max("bytes")).first()
    if (largest or 0) > SLICE_BYTES:
        raise ValueError(f"an item of {largest} bytes is above the {SLICE_BYTES} bytes of a slice")
    # the statistics are those of all distinct items, so that slices score alike
    freq = staged(items.select(F.explode(F.array_distinct("w")).alias("w")).groupBy("w").count(), "decontam-words")
    for (k,) in items.select("slice").distinct().orderBy("slice").toLocalIterator():
        some = items.where(F.col("slice") == k)
        rows = [(r["item"], r["text"]) for r in some.select("item", "text").orderBy("item").collect()]
        own = some.select(F.explode("w").alias("w")).distinct()
        df = {r["w"]: r["count"] for r in freq.join(own, "w").collect()}
        yield spark.sparkContext.broadcast((rows, n_items, df, n_words / n_items))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question, answer, whole: one row for each verified match (and row of
    ``docs`` and of ``benchmark``)."""
    spark = docs.sparkSession
    schema = "doc_id long, item long, score double, question double, answer double, whole double"
    items = _items(benchmark)
    out = spark.createDataFrame([], schema)
    for index in _slices(items):
        def search(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            built = Index(*index.value)
            for b in batches:
                got = built.search(b["text"].tolist())
                yield pd.DataFrame({
                    "doc_id": b["doc_id"].iloc[[g[0] for g in got]].reset_index(drop=True),
                    "item": pd.array([built.ids[g[1]] for g in got], dtype="Int64"),
                    "score": [round(g[2], 6) for g in got], "question": [round(g[3], 6) for g in got],
                    "answer": [round(g[4], 6) for g in got], "whole": [round(g[5], 6) for g in got]})
        out = out.unionByName(staged(pick(docs, "doc_id", "text").mapInPandas(search, schema), "decontam-matches"))
        index.unpersist()
    ids = pick(benchmark, "item_id", "text").join(items.select("item", "text"), "text").select("item", "item_id")
    return out.join(ids, "item").select("doc_id", "item_id", "score", "question", "answer", "whole")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any verified match; its columns stay as they are.

    With several slices what each leaves is written for the next one."""
    held = None
    for index in _slices(_items(benchmark)):
        if held is not None:
            docs = staged(docs, "decontam-left")
            held.unpersist()
        held = index

        def keep(batches: Iterator[pd.DataFrame], index=index) -> Iterator[pd.DataFrame]:
            built = Index(*index.value)
            for b in batches:
                bad = {g[0] for g in built.search(b["text"].tolist())}
                yield b.iloc[[i for i in range(len(b)) if i not in bad]]
        docs = docs.mapInPandas(keep, docs.schema)
    return docs
