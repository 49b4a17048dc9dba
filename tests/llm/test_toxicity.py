"""Deobfuscation and toxicity: exhaustive lattices, restored words, held-out accuracy, defined cases."""
import itertools
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import toxicity as tx
from shelfcast.llm.common import table
from tests.llm.cases import DOC_SCHEMA, ROWS, rows

TEXTS = ["the little idiot and the clown went to the town", "a stupid loser in the moron town", "i like the letter and the book"] * 4


@pytest.fixture(scope="module")
def cost(spark):
    return tx.character_model(spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"))


def test_model_counts_every_letter(spark, cost):
    """Against counting letter by letter."""
    three = np.zeros((tx.SIZE,) * 3)
    for t in TEXTS:
        for w in t.split():
            codes = [tx.END, tx.END, *[tx.CODE[c] for c in w], tx.END]
            for a, b, c in zip(codes, codes[1:], codes[2:]):
                three[a, b, c] += 1
    df = spark.createDataFrame([(i, t.replace(" ", " 12,\t ").upper()) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = next(tx._trigrams(iter([df.toPandas()])))
    assert dict(zip(got["gram"], got["n"])) == {int(k): int(v) for k, v in enumerate(three.ravel()) if v}
    assert np.allclose(np.exp(-cost).sum(axis=2), 1.0)


def brute_reading(word, cost):
    best = None
    for path in itertools.product(*tx._pieces(word), [("#", 0.0)]):
        a = b = tx.END
        total, out = 0.0, ""
        for letters, channel in path:
            total += channel
            for c in letters:
                k = tx.CODE.get(c, tx.END)
                if k == tx.END and b == tx.END:
                    continue
                total += cost[a, b, k]
                a, b = (b, k) if k != tx.END else (tx.END, tx.END)
                out += " " if c == "#" else c
        if best is None or total < best[0] - 1e-9:
            best = (total, out.strip())
    return best[1]


def test_viterbi_finds_the_cheapest_reading(cost):
    for word in ("1d10t", "st00pid", "cl0wn!", "l-o-s-e-r", "m o r o n", "sttuuupid", "|e77er", "b00k$$", "$$", "", "1", "i.d.i.0.7", "ab12|cd"):
        assert tx.restore_word(word, cost) == brute_reading(word, cost), word


def test_disguised_words_are_restored(cost):
    r = tx.Restorer(cost)
    for seen, meant in (("1d10t", "idiot"), ("ID10T!", "idiot"), ("c.l.o.w.n", "clown"), ("l o s e r", "loser"), ("stuuuupid", "stupid"),
                        ("m0r0n,", "moron"), ("$tup1d", "stupid"), ("i-d-i-o-t", "idiot")):
        assert r.words(f"the {seen} and") == {"the", meant, "and"}, seen
    assert r.words("The letter, a book: town.") == {"the", "letter", "a", "book", "town"}
    assert r.words(None) == r.words("") == r.words(" \t\n") == set()
    assert r.text("The  1D10T\nand  a c l o w n") == "the  idiot\nand  a clown" or "idiot" in r.text("The  1D10T\nand")
    assert r.text(None) == "" and r.words("x" * 100_000 + "1" + "y" * 1000)


def planted():
    rng = np.random.default_rng(6)
    vocab = ["".join(rng.choice(list("aeioulnrst"), rng.integers(2, 8))) for _ in range(300)]
    bad = ["idiot", "clown", "stupid", "moron"]
    data, labels = [], []
    for i in range(900):
        w = [str(x) for x in rng.choice(vocab, rng.integers(1, 60))]
        toxic = i % 5 == 1
        if toxic:
            word = bad[i // 5 % 4]
            word = word.replace("o", "0").replace("i", "1") if i % 3 == 0 else "-".join(word) if i % 3 == 1 else word
            w.insert(int(rng.integers(0, len(w) + 1)), word)
        data.append((i, " ".join(w), "en", "s", 1))
        if i % 7 or not toxic:
            labels.append((i, 1, int(toxic)))
    return data, labels


def test_planted_toxic_texts_are_found(spark):
    data, labels = planted()
    docs, marks = spark.createDataFrame(data, DOC_SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in tx.score_documents(docs, marks).collect()}
    assert len(got) == len(data) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    right = sum(r.predicted == int(d % 5 == 1) for d, r in got.items())
    assert right >= 0.98 * len(data)
    # held-out labels are not looked at
    other = marks.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert rows(tx.score_documents(docs, other)) == rows(tx.score_documents(docs.repartition(5), marks))


def test_scores_by_hand(spark):
    """The whole score from the sample's words, recomputed."""
    data, labels = planted()
    docs, marks = spark.createDataFrame(data, DOC_SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cost = tx.character_model(docs)
    scorer, restorer = tx.train(docs, marks, cost), tx.Restorer(cost)
    sample = [(restorer.words(data[d][1]), y) for d, _, y in labels if zlib.crc32(str(d).encode()) % 5]
    n1, n0 = sum(y for _, y in sample), sum(1 - y for _, y in sample)
    for word in {w for s, _ in sample for w in s}:
        bad, docs_ = sum(y for s, y in sample if word in s), sum(word in s for s, _ in sample)
        a, b = bad + 0.5, docs_ - bad + 0.5
        p, q = n1 + 1 - a, n0 + 1 - b
        low = np.log(a / p) - np.log(b / q) - tx.SURE * np.sqrt(1 / a + 1 / p + 1 / b + 1 / q)
        assert (scorer.weights.get(word) == pytest.approx(low)) if low > 0 and bad >= tx.LEAST_DOCS else word not in scorer.weights
    assert "idiot" in scorer.weights and scorer.slope > 0


def test_defined_cases(spark, docs, clashing, no_docs):
    marks = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (1, 0, 1), (3, 1, 0), (7, 1, 0), (None, 1, 1), (6, 1, None), (99, 1, 1)],
                                  "doc_id long, quality int, toxic int")
    got = rows(tx.score_documents(docs, marks))
    assert len(got) == len(ROWS) and got == rows(tx.score_documents(clashing, marks))
    assert tx.score_documents(no_docs, marks).collect() == []
    assert all(r.score == 0 and r.predicted == 0 for r in tx.score_documents(docs, marks.limit(0)).collect())
    hot = spark.createDataFrame([(0, "one idiot", "en", "a", 1)] * 300 + [(3, "fine", "en", "a", 1)], DOC_SCHEMA)
    assert tx.labelled(hot, marks).count() == 2


def test_held_out_labels_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect()}
    got = [r for r in tx.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels")).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in got) >= 0.93 * len(got)


def test_restored_texts(spark):
    out = tx.restore_documents(spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None, "a 1D10T"])], "doc_id long, text string"))
    got = {r.doc_id: r.restored for r in out.collect()}
    assert got[0] == TEXTS[0] and got[len(TEXTS)] == "" and got[len(TEXTS) + 1] == "a idiot"
    assert isinstance(pd.Series(got), pd.Series)
