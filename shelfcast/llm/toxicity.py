"""Toxicity behind a noisy channel: disguised words are restored first, then the text is scored.

A disguised word is taken for a clean word that passed a channel: letters became look-alike
digits or signs, marks or blanks were put between letters, letters were repeated.  Each
observed piece may stand for several letters, for none, or for the end of a word; these
choices, with their channel costs, make a lattice, and Viterbi finds its cheapest path under
a trigram model of characters (states are the last two letters).  A word that no channel
step may have touched has one path only and is taken as it is.

The character model is counted over all texts (distinct trigrams of a fixed alphabet, so
what the tasks get is bounded, whatever the corpus).  Words that tell toxic from other texts
are found in the restored texts of at most ``TRAIN_ROWS`` labelled documents of each class
(least hash of doc_id, one row each, never held-out ones): a word counts if even the lower
end of its log odds is positive.  A text's evidence is the sum of its distinct words'
log odds; a logistic curve through the training texts turns it into the score.

Scoring reads every whole text once and moves nothing.

Defined cases: null, empty and letterless texts have no evidence and get the lowest score;
a null doc_id is not held out and never learned from; of several labels of a doc_id the
least counts, of several rows the one with the least text hash; without labels of both
classes every text scores 0; an empty table gives an empty result; extra columns are
ignored; repeated rows get equal results; a very long run without blanks is one word.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hash52, pick, small_batches, staged

TRAIN_ROWS = 2000          # labelled documents of each class
LEXICON = 1000             # most telling words kept
THRESHOLD = 0.5
SURE = 3.0                 # standard errors between a word's log odds and their lower end
LEAST_DOCS = 3             # toxic training texts that a telling word stands in
CACHE = 200_000            # restored words a task remembers

# The alphabet, and the letters that a sign may stand for
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c"}
FILLERS = ".-_*~'"
END = 0                    # code of a word's border; letters follow from 1
SIZE = len(LETTERS) + 1
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}

# Costs of the channel, in nats: a sign for a letter; a single sign as a border, and a run of signs or one
# behind the word; a mark or blank dropped or kept as a border; a long run of a letter for one or two; a pair for one
LOOK, LONE, MARKS, DROPPED, KEPT, ONCE, TWICE, PAIR = 1.0, 9.0, 0.3, 0.3, 5.0, 0.7, 1.5, 4.0
RARE = 5.0                 # nats from which a letter behind itself is out of the ordinary

WORD = re.compile(r"[^\W\d_]+")
SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")            # single characters, a blank between them
SIGNS, MARK = re.escape("".join(LOOKS)), re.escape(FILLERS)


def suspects(cost: np.ndarray) -> tuple[re.Pattern, re.Pattern]:
    """Patterns of what the channel may have touched: letters run together (three equal ones, or two
    that the model hardly ever sees together), and these or signs or marks at letters."""
    letter = r"[^\W\d_]"
    rare = "".join(c for c, i in CODE.items() if np.min(cost[1:, i, i]) > RARE)
    runs = rf"({letter})\1\1" + (rf"|([{rare}])\2" if rare else "")
    return re.compile(runs), re.compile(
        runs + rf"|{letter}[{SIGNS}]+(?:{letter}|$)|^[{SIGNS}]+{letter}|{letter}[{MARK}]{letter}[{MARK}]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _pieces(word: str) -> list[list[tuple[str, float]]]:
    """What each piece of the observed word may stand for: (letters, channel cost); "#" ends a word."""
    out, i = [], 0
    while i < len(word):
        c, j = word[i], i + 1
        while j < len(word) and word[j] == c:
            j += 1
        run = j - i
        if c in CODE:
            if run == 1:
                out.append([(c, 0.0)])
            elif run == 2:
                out.append([(c + c, 0.0), (c, PAIR)])
            else:
                out.append([(c, ONCE), (c + c, TWICE)])
        elif c in LOOKS:
            border = LONE if run == 1 and not (c == "!" and j == len(word)) else MARKS
            out.append([(x, LOOK * (1 + 0.5 * (run - 1))) for x in LOOKS[c]] + [("#", border)])
            if run > 1:
                out[-1] += [(x + x, LOOK * run + TWICE) for x in LOOKS[c]]
        elif c in FILLERS or c == " ":
            out.append([("", DROPPED), ("#", KEPT)])
        else:
            out.append([("#", 0.0)])
        i = j
    return out


def restore_word(word: str, cost: np.ndarray) -> str:
    """The cheapest reading of the observed word, borders as blanks."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(END, END): (0.0, None)}
    for options in [*_pieces(word), [("#", 0.0)]]:
        reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (so_far, path) in states.items():
            for letters, channel in options:
                x, y, total, way = a, b, so_far + channel, path
                for c in letters:
                    k = CODE.get(c, END)
                    if k == END and y == END:                # a border behind a border
                        continue
                    total += cost[x, y, k]
                    x, y = (y, k) if k != END else (END, END)
                    way = (way, c)
                if (x, y) not in reached or total < reached[x, y][0]:
                    reached[x, y] = (total, way)
        states = reached
    path, out = min(states.values(), key=lambda s: s[0])[1], []
    while path:
        path, c = path
        out.append(" " if c == "#" else c)
    return "".join(reversed(out)).strip()


class Restorer:
    """Restores words, and remembers the last ones."""

    def __init__(self, cost: np.ndarray):
        self.cost, self.known = cost, {}
        self.runs, self.suspect = (p.search for p in suspects(cost))

    def word(self, observed: str) -> str:
        got = self.known.get(observed)
        if got is None:
            got = restore_word(observed, self.cost)
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[observed] = got
        return got

    def words(self, text: str | None) -> set[str]:
        """The distinct words of the restored text."""
        if not isinstance(text, str):
            return set()
        low, out = SPACED.sub(lambda m: self.word(m[0]), text.lower()), set()
        runs = self.runs(low) is not None
        for token in set(low.split()):
            bare = token.strip(".,;:?")
            if bare.isalpha() and not (runs and self.runs(bare)):
                out.add(bare)
            elif self.suspect(token):
                out.update(self.word(token).split())
            else:
                out.update(WORD.findall(token))
        return out

    def text(self, text: str | None) -> str:
        """The whole text with its disguised words restored (lower-cased)."""
        if not isinstance(text, str):
            return ""
        low = SPACED.sub(lambda m: self.word(m[0]), text.lower())
        return re.sub(r"\S+", lambda m: self.word(m[0]) if self.suspect(m[0]) else m[0], low)


def _trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of (letter, letter, letter), borders between words; a whole task's in one small table."""
    code = np.zeros(257, dtype=np.int64)
    code[[ord(c) for c in CODE]] = list(CODE.values())
    total = np.zeros(SIZE ** 3, dtype=np.int64)
    for b in batches:
        low = "\n".join(t.lower() for t in b["text"] if isinstance(t, str))
        for at in range(0, len(low), 1 << 20):               # a million characters at a time; words at a seam are cut
            raw = low[at:at + (1 << 20)].encode("utf-32-le", "surrogatepass")
            x = code[np.minimum(np.frombuffer(raw, dtype=np.uint32), 256)]
            x = np.concatenate([[END, END], x, [END]])
            x = x[np.concatenate([[True], (x[1:] != END) | (x[:-1] != END)])]           # one border between words
            y = np.insert(x, np.flatnonzero(x == END), END)  # a word's first letter stands behind two borders
            key = (y[:-2] * SIZE + y[1:-1]) * SIZE + y[2:]
            total += np.bincount(key[(y[2:] != END) | (y[1:-1] != END)], minlength=SIZE ** 3)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"gram": at.astype(np.int32), "n": total[at]})


def character_model(docs: DataFrame) -> np.ndarray:
    """Cost in nats of each letter behind two others, counted over every whole text.

    Trigrams are backed by bigrams and letters (Witten-Bell); at most SIZE ** 3 counts reach the driver."""
    small_batches(docs.sparkSession)
    got = pick(docs, "text").where("text IS NOT NULL").mapInPandas(_trigrams, "gram int, n long").groupBy("gram").agg(
        F.sum("n").alias("n")).toArrow()
    n = np.zeros(SIZE ** 3)
    n[got["gram"].to_numpy()] = got["n"].to_numpy()
    three = n.reshape(SIZE, SIZE, SIZE)
    one, two = three.sum(axis=(0, 1)), three.sum(axis=0)
    p = (one + 1) / (one.sum() + SIZE)
    for counts in (two, three):
        total, kinds = counts.sum(axis=-1, keepdims=True), (counts > 0).sum(axis=-1, keepdims=True)
        p = np.where(total > 0, (counts + kinds * p) / np.maximum(total + kinds, 1), p)
    return -np.log(p)


class Scorer:
    """Evidence of words and the curve over it."""

    def __init__(self, weights: dict[str, float], slope: float, offset: float):
        self.weights, self.slope, self.offset = weights, slope, offset

    def evidence(self, words: set[str]) -> float:
        few, many = (words, self.weights) if len(words) < len(self.weights) else (self.weights, words)
        return math.fsum(self.weights[w] for w in few if w in many)

    def score(self, words: set[str]) -> float:
        z = self.slope * self.evidence(words) + self.offset
        return round(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), 6)


def labelled(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, toxic, text: at most ``rows`` labelled documents of each class, one row each, none held out."""
    known = (pick(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic")))
    known = known.withColumn("h", hash52(F.lit("toxic"), F.col("doc_id")))
    # some ids may have no text: the sample is taken among those that have one
    have = pick(docs, "doc_id", "text").where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th"))
    first = have.groupBy("doc_id").agg(F.min("th").alias("th")).join(known, "doc_id")
    chosen = None
    for c in (0, 1):
        part = first.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(rows).select("doc_id", "toxic", "th")
        chosen = part if chosen is None else chosen.unionByName(part)
    text = pick(docs, "doc_id", "text").withColumn("th", F.xxhash64("text"))
    return text.join(F.broadcast(chosen), ["doc_id", "th"]).dropDuplicates(["doc_id"]).select("doc_id", "toxic", "text")


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50, l2: float = 1e-3) -> tuple[float, float]:
    """Slope and offset of a logistic curve (Newton's method, lightly penalised)."""
    a = np.stack([x, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + l2 * len(x) * np.eye(2)
        step = np.linalg.solve(h, a.T @ (y - p) - l2 * len(x) * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, cost: np.ndarray, rows: int = TRAIN_ROWS) -> Scorer | None:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(cost)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(shared.value)
        for b in batches:
            words = [sorted(restorer.words(t)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "words": pd.Series(words, index=b.index, dtype=object)})

    sample = staged(labelled(docs, labels, rows).mapInPandas(split, "doc_id long, toxic int, words array<string>"), "toxic-sample")
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return None
    a, b = F.col("bad") + 0.5, F.col("docs") - F.col("bad") + 0.5
    p, q = F.lit(size[1] + 1.0) - a, F.lit(size[0] + 1.0) - b
    telling = (sample.select("toxic", F.explode("words").alias("word")).groupBy("word")
               .agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("docs"))
               .where(F.col("bad") >= min(LEAST_DOCS, max(1, size[1] // 10)))
               .withColumn("weight", F.log(a / p) - F.log(b / q) - SURE * F.sqrt(1 / a + 1 / p + 1 / b + 1 / q))
               .where("weight > 0").orderBy(F.desc("weight"), "word").limit(LEXICON).select("word", "weight"))
    weights = {r["word"]: r["weight"] for r in telling.collect()}
    plain = Scorer(weights, 1.0, 0.0)

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "x": [plain.evidence(set(w)) for w in b["words"]]})

    got = sample.mapInPandas(weigh, "doc_id long, toxic int, x double").orderBy("doc_id").toArrow()     # 2 * rows numbers
    return Scorer(weights, *fit_curve(got["x"].to_numpy(), got["toxic"].to_numpy().astype(float)))


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""
    spark = docs.sparkSession
    cost = character_model(docs)
    parts = spark.sparkContext.broadcast((cost, train(docs, labels, cost, rows)))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, scorer = parts.value
        restorer = Restorer(table)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"],
                                "score": [scorer.score(restorer.words(t)) if scorer else 0.0 for t in b["text"]]})

    scored = pick(docs, "doc_id", "text").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInPandas(
        judge, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def restore_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text, restored: the whole texts with their disguised words restored."""
    shared = docs.sparkSession.sparkContext.broadcast(character_model(docs))

    def restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(shared.value)
        for b in batches:
            yield b.assign(restored=[restorer.text(t) for t in b["text"]])

    return pick(docs, "doc_id", "text").mapInPandas(restore, "doc_id long, text string, restored string")
