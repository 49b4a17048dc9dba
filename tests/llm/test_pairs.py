"""N-gram Jaccard join and decontamination against brute force, and their defined cases."""
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from shelfcast.llm import components, decontam, jaccard_join
from shelfcast.llm.common import table
from tests.llm.cases import ROWS, rows


def words(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = words(text)
    return frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def brute_join(data):
    """(doc_id, n_shingles, component_id, n_links) by comparing all pairs."""
    sets = [shingles(t) for _, t, *_ in data]
    links, root = [0] * len(data), list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 90 * (len(sets[i]) + len(sets[j]) - common):
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = defaultdict(list)
    for i in range(len(data)):
        groups[find(i)].append(data[i][0])
    name = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted([(data[i][0], len(sets[i]), name[find(i)], links[i]) for i in range(len(data))], key=repr)


def mutated(rng, base, changes):
    w = list(base)
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
    return w


def near_copies(seed=5):
    """Groups whose similarities lie around 0.9, a shared passage, and texts of every small length."""
    rng = random.Random(seed)
    texts = []
    for n in (12, 20, 60, 150, 400):
        base = [f"w{rng.randrange(3000)}" for _ in range(n)]
        for k in range(14):
            texts.append(" ".join(mutated(rng, base, rng.choice([0, 0, 1, 2, max(1, n // 60), n // 30]))))
            texts.append(" ".join(base[: n - k]))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10 ** 6)}" for _ in range(rng.choice([1, 3, 4, 5, 80]))) for _ in range(25)]
    texts += [" ".join(["a"] * k) for k in range(1, 6)] + ["A b  C", "a B c", "one two", "One\ttwo", "two one"]
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def as_rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect()), key=repr)


def test_join_defined_cases(docs, clashing, no_docs):
    want = brute_join(ROWS)
    assert as_rows(jaccard_join.join_documents(docs)) == want
    assert as_rows(jaccard_join.join_documents(clashing)) == want
    assert jaccard_join.join_documents(no_docs).collect() == []


def test_join_finds_every_link(spark):
    data = near_copies()
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = as_rows(jaccard_join.join_documents(df))
    assert got == brute_join(data)
    assert sum(r[3] for r in got) > 300


def test_join_in_many_blocks_is_the_same(spark):
    data = near_copies(9)
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    small = jaccard_join.jaccard_join(df, block_tokens=500)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in small.collect()), key=repr)
    assert got == brute_join(data)


def test_keep_one_row_of_each_component(docs):
    out = jaccard_join.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted((r[0] for r in out.collect()), key=repr)
    # 0 stands for 0, 1 and 9; 5 for both rows 5 and 6; blank rows (2, 3, 4, null) all stay
    assert got == sorted([0, 2, 3, 4, 5, 7, 8, None, None], key=repr)


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(3)
    base = rng.choice(5000, 120, replace=False)
    sets = []
    for k in range(60):
        s = base.copy()
        s[rng.choice(120, k % 9, replace=False)] = rng.integers(10_000, 20_000, k % 9)
        sets.append(np.unique(s).astype(np.int64))
    sizes = np.array([len(s) for s in sets])
    every = np.ones(len(sets), dtype=bool)
    got = {(min(i, int(j)), max(i, int(j))) for i, found in jaccard_join.search(sizes, sets, every, every) for j in found}
    want = {(j, i) for i in range(60) for j in range(i)
            if 100 * (k := len(np.intersect1d(sets[i], sets[j]))) >= 90 * (sizes[i] + sizes[j] - k)}
    assert got == want and len(want) > 100


def similar(rng, a, share):
    """A set that is just similar enough to ``a``."""
    num, den = share
    b = a
    while True:                                               # spoil shingles as long as the pair stays similar
        c = b[rng.permutation(len(b))]
        c = np.unique(np.concatenate([c[1:], rng.integers(0, 2 ** 63, int(rng.integers(0, 2))).astype(np.uint64)]))
        common = len(np.intersect1d(a, c))
        if not len(c) or den * common < num * (len(a) + len(c) - common):
            return b
        b = c


def test_heads_of_similar_sets_share_enough():
    rng = np.random.default_rng(11)
    for share in ((9, 10), (4, 5), (17, 20), (3, 5)):
        for n in [*range(1, 40), 95, 96, 97, 200, 333, 1000]:
            for _ in range(10):
                a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
                b = similar(rng, a, share)
                common = len(np.intersect1d(jaccard_join.head(a, share), jaccard_join.head(b, share)))
                for x in (a, b):
                    assert common >= jaccard_join.margin(jaccard_join.need(len(x), share)), (share, n)


def test_shared_shingles_are_counted_over_different_sets():
    """Two batches of one bucket: 1 stands in two sets, 2 in copies of one, 3 in one, 4 in three."""
    pack = lambda x, t: np.array(x, dtype=t).tobytes()
    b = pd.DataFrame({"bucket": [0, 0], "batch": [10, 11], "keys": [pack([1, 2, 4, 4], np.uint32), pack([1, 2, 3, 4], np.uint32)],
                      "idx": [pack([0, 0, 0, 1], np.uint16), pack([7, 8, 7, 9], np.uint16)],
                      "tags": [pack([50, 50, 50, 51], np.uint32), pack([60, 50, 60, 61], np.uint32)]})
    got = {r.batch: (np.frombuffer(r.keys, np.uint32).tolist(), np.frombuffer(r.idx, np.uint16).tolist(), list(r.df))
           for r in jaccard_join._answer(b).itertuples()}
    assert got == {10: ([1, 4, 4], [0, 0, 1], [2, 3, 3]), 11: ([1, 4], [7, 9], [2, 3])}


def test_filter_rules_nothing_in_out(spark):
    th = [3, -1, 2 ** 62, -2 ** 63, 1 << 25, 77]
    table = jaccard_join._filter(spark.createDataFrame([(x,) for x in th], "th long"))
    on = lambda x: table[x % jaccard_join.FILTER_BITS // 8] >> (x % 8) & 1
    assert all(on(x) for x in th) and not any(on(x) for x in (4, 78, 2 ** 61 + 1))
    assert len(table) * 8 == jaccard_join.FILTER_BITS


def test_equal_rows_meet_once(spark):
    """3,000 equal rows without an id and one near copy: two sets are searched, and all rows are linked."""
    base = [f"w{i}" for i in range(60)]
    data = [(None, " ".join(base), "en", "s", 1)] * 3000 + [(7, " ".join([*base[:59], "other"]), "en", "s", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = jaccard_join.join_documents(df).groupBy("doc_id", "component_id", "n_links").count().collect()
    assert sorted(map(tuple, got), key=repr) == [(7, 7, 3000, 1), (None, 7, 3000, 3000)]
    texts = jaccard_join._texts(df)
    left = texts.drop("text").distinct().selectExpr("th as node", "58L as n", "1L as copies", "no_id", "doc_id", "th")
    assert jaccard_join.filled(texts, left).count() == 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (3000, 2999), (2999, 3000)]
    rng = random.Random(2)
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(200))
    assert got[3000] == got[2999] == 2999
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


ITEMS = [
    (1, "What is the tallest tower of the old river town in the valley? It is the tower of the northern gate by the mill."),
    (2, "short item"), (3, None), (4, ""), (None, "An item without an id asks something long enough to be found. The answer is forty two."),
    (5, "What is the tallest tower of the old river town in the valley? It is the tower of the northern gate by the mill."),
    (6, "ping pong ping pong ping pong ping pong ping pong ping pong"),
]


def plain_words(text):
    """Runs of letters and digits, found character by character."""
    out, run = [], ""
    for c in (text or "").lower() + " ":
        if c.isalnum():
            run += c
        elif run:
            out, run = [*out, run], ""
    return out


def runs_held(part, words):
    """Share of the part's runs of five words (of the whole part, if shorter) that stand in ``words``."""
    n = min(5, len(part))
    if not n:
        return 1.0
    have = {" ".join(words[i:i + n]) for i in range(len(words) - n + 1)}
    want = {" ".join(part[i:i + n]) for i in range(len(part) - n + 1)}
    return len(want & have) / len(want)


def brute_leaks(data, items):
    """(doc, item) pairs by the two rules of verification; nothing is taken from the operator."""
    out = set()
    for i, text in items:
        whole = plain_words(text)
        if not whole:
            continue
        sentences, run = [], ""
        for k, c in enumerate(text.strip()):
            if c.isspace() and run[-1:] in (".", "!", "?"):
                sentences, run = [*sentences, run], ""
            elif not (c.isspace() and not run):
                run += c
        parts = [p for p in map(plain_words, [*sentences, run]) if p]
        q, a = (sum(parts[:-1], []), parts[-1]) if len(parts) > 1 else (whole, [])
        for d, t, *_ in data:
            w = plain_words(t)
            if w and (min(runs_held(q, w), runs_held(a, w)) >= 0.8 or runs_held(whole, w) >= 0.8):
                out.add((d, i))
    return out


def test_a_copy_without_the_last_word_is_found(spark):
    item = "Which of the nine bells of the northern tower rang first on the morning of the great fire in the harbour? Third."
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id long, text string")
    data = [(1, item.replace(" Third.", "")), (2, item.replace("Third", "Fourth")), (3, " ".join(item.split()[:9])), (4, item)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontam.contaminated(df, benchmark).collect()]
    assert sorted(got) == sorted((d, i) for d in (1, 2, 4) for i in (1, 1, 2))
    assert {r.doc_id for r in decontam.clean(df, benchmark).collect()} == {3}


def test_slices_are_within_both_bounds(spark, monkeypatch):
    texts = [f"item number {i} asks something " + "long " * (i % 40) for i in range(300)]
    benchmark = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 500, "item_id long, text string")
    monkeypatch.setattr(decontam, "SLICE_ITEMS", 70)
    monkeypatch.setattr(decontam, "SLICE_BYTES", 6000)
    sizes = [(len(r), sum(len(t) for _, t in r)) for r, *_ in (x.value for x in decontam._slices(decontam._items(benchmark)))]
    assert len(sizes) > 4 and sum(n for n, _ in sizes) == 300 and all(n <= 70 and b <= 6000 + 300 for n, b in sizes)
    with pytest.raises(ValueError):
        list(decontam._slices(decontam._items(spark.createDataFrame([(1, "x " * 4000)], "item_id long, text string"))))


def test_decontamination_defined_cases(spark, docs, monkeypatch):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(500))
    data = [(1, filler + " " + ITEMS[0][1] + " " + filler), (2, ITEMS[0][1].upper().replace(" ", "\n")), (3, None), (4, ""),
            (5, ITEMS[0][1].split("?")[0]), (6, "a SHORT, item!"), (7, filler), (None, "x " + ITEMS[4][1]), (8, (filler + " ") * 40 + ITEMS[6][1]),
            (2, ITEMS[0][1].upper().replace(" ", "\n"))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = decontam.contaminated(df.selectExpr("*", "1 as score", "2 as Text"), benchmark).collect()
    pairs = sorted(((r.doc_id, r.item_id) for r in got), key=repr)
    assert set(pairs) == brute_leaks(data, ITEMS)
    assert pairs.count((2, 1)) == 2 and (1, 5) in pairs and (None, None) in pairs and (6, 2) in pairs and (8, 6) in pairs
    assert all(r.score >= decontam.THRESHOLD for r in got)
    monkeypatch.setattr(decontam, "SLICE_ITEMS", 2)
    sliced = decontam.contaminated(df, benchmark).collect()
    assert sorted(map(repr, sliced)) == sorted(map(repr, got))
    assert decontam.contaminated(df.limit(0), benchmark).collect() == []
    assert decontam.contaminated(df, benchmark.limit(0)).collect() == []
    left = decontam.clean(df.selectExpr("*", "'k' as extra"), benchmark)
    assert left.columns == ["doc_id", "text", "extra"]
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 7]


def test_wand_retrieves_all_above_threshold(sf_small, spark):
    """Block-max WAND against scoring every item for every passage."""
    items = [(r.item_id, r.text) for r in table(spark, sf_small, "benchmark").collect()]
    df = defaultdict(int)
    for _, t in items:
        for w in set(decontam.tokens(t)):
            df[w] += 1
    index = decontam.Index(items, len(items), dict(df), sum(len(decontam.tokens(t)) for _, t in items) / len(items))
    rng = random.Random(1)
    for _ in range(40):
        w = [x for _, t in rng.sample(items, 2) for x in decontam.tokens(t)]
        terms = sorted({index.terms[x] for x in rng.sample(w, len(w) * 3 // 4)})
        want = {}
        for t in terms:
            for postings in index.postings[t].values():
                for item, share in postings:
                    want[item] = want.get(item, 0.0) + share
        got = {i: s for b in range(index.blocks) for i, s in index.wand([t for t in terms if index.maxima[t, b] > 0], b, 0.4)}
        assert set(got) == {i for i, s in want.items() if s >= 0.4}
        assert all(got[i] == pytest.approx(want[i]) for i in got)


def test_decontamination_finds_all_planted_passages(spark, sf_small):
    docs, benchmark = table(spark, sf_small, "documents"), table(spark, sf_small, "benchmark")
    want = brute_leaks([tuple(r) for r in docs.collect()], [tuple(r) for r in benchmark.collect()])
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, benchmark).collect()}
    assert want and got == want
    assert rows(decontam.contaminated(docs, benchmark)) == rows(decontam.contaminated(docs.repartition(7), benchmark))
