"""The pipeline's near copies: five-word shingles, similarity of at least 0.8, by brute force."""
import random

import corpus_pipeline as cp

from shelfcast.llm import jaccard_join
from shelfcast.llm.common import DOC_COLS, table
from tests.llm.cases import DOC_SCHEMA
from tests.llm.test_pairs import brute_join, mutated, near_copies, words


def shingles(text, n=5):
    w = words(text)
    return frozenset(zip(*[w[i:] for i in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_near(data):
    """The least doc_id of each group of texts tied by a similarity of 0.8."""
    sets, root = [shingles(r[1]) for r in data], list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 5 * common >= 4 * len(sets[i] | sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, r in enumerate(data):
        groups.setdefault(find(i), []).append(r[0])
    return sorted(min(g) for g in groups.values())


def test_stage_takes_five_words_and_four_fifths(spark, sf_small):
    data = near_copies()
    df = spark.createDataFrame(data, DOC_SCHEMA)
    want = brute_near(data)
    assert sorted(r.doc_id for r in cp.near_dups(spark, df, sf_small).collect()) == want
    assert len(want) < len({c for _, _, c, _ in brute_join(data)})           # more than the digest's 3 words and 0.9
    few = jaccard_join.jaccard_join(df, block_tokens=500, shingle=5, share=(4, 5))
    assert sorted({r.component_id for r in few.collect()}) == want
    docs = table(spark, sf_small, "documents")
    want = brute_near([tuple(r) for r in docs.select(*DOC_COLS).collect()])
    assert sorted(r.doc_id for r in cp.near_dups(spark, docs, sf_small).collect()) == want



def test_a_third_of_all_rows_are_near_copies(spark, sf_small):
    """One hot group of near copies among texts that share a long passage."""
    rng = random.Random(8)
    base, passage = ([f"{c}{rng.randrange(5000)}" for _ in range(n)] for c, n in (("b", 150), ("p", 80)))
    data = []
    for i in range(360):
        w = mutated(rng, base, rng.randrange(0, 5)) if i % 3 == 0 else [*passage, *[f"u{rng.randrange(10 ** 7)}" for _ in range(40)]]
        data.append((i, " ".join(w), "en", "s", 1))
    df = spark.createDataFrame(data, DOC_SCHEMA)
    assert sorted(r.doc_id for r in cp.near_dups(spark, df, sf_small).collect()) == brute_near(data)
    few = jaccard_join.jaccard_join(df, block_tokens=2000, shingle=5, share=(4, 5)).collect()
    assert sorted({r.component_id for r in few}) == brute_near(data)
