"""The quality classifier's whole score by brute force: features spelt out, label paths enumerated."""
import itertools
import math

from shelfcast.llm import quality_crf
from tests.llm.cases import DOC_SCHEMA

GOOD = "The river runs past the old mill and the town.\nPeople walk there on Sundays, and they rest.\nIt is quiet."
BAD = "BUY!!! NOW!!! ### 50% $$$\nclick | here | menu | home\nBUY!!! NOW!!! ### 50% $$$\n@@@ ~~~ ^^^"
TEXTS = [GOOD, BAD, "One line only.", "# # #\n\n  \nA plain sentence stands here.", "x\nx\nX", "", None, " \n\t\n", "A B C 1 2 3!?\nend",
         GOOD + "\n" + BAD]
UPPER, DIGITS, SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*%&$@~^=+<>{}[]\\"


def plain_features(text):
    """One list of eleven numbers for each line that isn't blank, and the lines' lengths in bytes."""
    rows, lengths, seen = [], [], []
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        n, w, kinds = len(line.encode()), len(words), len(set(words))
        share = lambda chars, line=line, n=n: sum(c in chars for c in line) / n
        rows.append([min(n, 2000) / 200, share(UPPER), share(DIGITS), share(SYMBOLS), line.count("!") / w, line.count("|") / w,
                     min(n / w, 40) / 10, kinds / w, kinds / w if w >= 8 else 1.0, 1.0 if line in seen else 0.0,
                     1.0 if line.rstrip()[-1] in ".!?" else 0.0])
        lengths.append(n)
        seen.append(line)
    return rows, lengths


def brute_score(text, field):
    rows, lengths = plain_features(text or "")
    if not rows:
        return 0.0
    n, none = len(rows), [0.0] * len(rows[0])
    unary = []
    for i in range(n):
        x = [*rows[i], *(rows[i - 1] if i else none), *(rows[i + 1] if i + 1 < n else none), float(i == 0), float(i == n - 1)]
        z = [(v - m) / s for v, m, s in zip(x, field.mean, field.spread)]
        unary.append([sum(v * w for v, w in zip(z, field.weights[:-1, k])) + field.weights[-1, k] for k in (0, 1)])
    total, good = 0.0, [0.0] * n
    for path in itertools.product((0, 1), repeat=n):
        p = math.exp(sum(unary[i][k] for i, k in enumerate(path)) + sum(field.trans[a][b] for a, b in zip(path, path[1:])))
        total += p
        for i, k in enumerate(path):
            good[i] += p * k
    return sum(g / total * w for g, w in zip(good, lengths)) / sum(lengths)


def test_scores_by_enumeration(spark):
    data = [(i, t, "en", "s", 1) for i, t in enumerate(TEXTS * 4)]
    labels = [(i, int(t is not None and "BUY" not in t), 0) for i, t, *_ in data]
    docs = spark.createDataFrame(data, DOC_SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    field = quality_crf.train(docs, marks)
    got = quality_crf.classify(docs, marks).collect()
    assert len(got) == len(data)
    for r in got:
        assert abs(r.score - brute_score(TEXTS[r.doc_id % len(TEXTS)], field)) < 2e-6, r
        assert r.predicted == int(r.score >= 0.7)


def test_the_bound_is_one_on_rows(spark):
    """A labelled doc_id that holds most rows gives one of them to the sample."""
    few = [(0, GOOD, "en", "s", 1), (1, BAD, "en", "s", 1), (3, "A third text.", "en", "s", 1)]
    marks = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    one = quality_crf.train(spark.createDataFrame(few, DOC_SCHEMA), marks)
    many = quality_crf.train(spark.createDataFrame(few + few[:1] * 500, DOC_SCHEMA).repartition(4), marks)
    assert (one.weights == many.weights).all() and (one.trans == many.trans).all()
