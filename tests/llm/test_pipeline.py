"""The pipeline's stages by brute force on their own inputs, and the run as a whole."""
from collections import Counter

import corpus_pipeline as cp
from pyspark.sql import functions as F
from shelfcast.llm import quality_crf
from shelfcast.llm.common import DOC_COLS, table
from tests.llm.cases import ROWS
from tests.llm.test_dedup_shard_mix import brute_targets, shard_of
from tests.llm.test_near_copies import brute_near
from tests.llm.test_pairs import brute_leaks


def test_stages_one_after_the_other(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, sf_small, "labels").collect()}
    kept = []
    for name, stage in cp.STAGES:
        before = [tuple(r) for r in docs.select(*DOC_COLS).collect()]
        out = stage(spark, docs, sf_small)
        if name != "shard":
            assert out.columns == DOC_COLS
        after = [r.asDict() for r in out.collect()]
        ids, was = [r["doc_id"] for r in after], [r[0] for r in before]
        kept.append((name, len(after)))
        if name == "quality":
            assert all(labels.get(d, 1) == 1 for d in ids) and len([d for d in was if labels.get(d) == 1]) <= len(ids)
            assert {d for d in was if labels.get(d) == 1} <= set(ids)
        elif name == "near_dups":
            assert sorted(ids) == brute_near(before)
        elif name == "decontaminate":
            bench = [tuple(r) for r in table(spark, sf_small, "benchmark").collect()]
            bad = {d for d, _ in brute_leaks(before, bench)}
            assert sorted(ids) == sorted(set(was) - bad)
        elif name == "mix":
            size = {r[0]: len((r[1] or "").encode().split()) for r in before}
            source = {r[0]: r[3] for r in before}
            total, taken = Counter(), Counter()
            for d in was:
                total[source[d]] += size[d]
            for d in ids:
                taken[source[d]] += size[d]
            want = brute_targets(total)
            longest = {s: max(size[d] for d in was if source[d] == s) for s in total}
            assert all(abs(taken[s] - want[s]) <= longest[s] + 1 for s in total)
            assert {s for s in total if total[s]} == {r["source"] for r in after}
            assert max(Counter(ids).values()) <= 2
        else:
            assert sorted(ids) == sorted(was)
            assert all(r["shard"] == shard_of(r["doc_id"], 8) for r in after)
            for k in range(8):
                slots = sorted(r["slot"] for r in after if r["shard"] == k)
                assert slots == list(range(len(slots)))
        docs = spark.createDataFrame([[r[c] for c in DOC_COLS] for r in after], docs.select(*DOC_COLS).schema)
    assert [n for n, _ in kept] == ["quality", "near_dups", "decontaminate", "mix", "shard"] and all(n for _, n in kept)


def test_run_equals_its_stages_and_reruns_agree(spark, sf_small):
    a = sorted(cp.run(spark, sf_small).select("doc_id", "shard", "slot").collect())
    assert a and a == sorted(cp.run(spark, sf_small).select("doc_id", "shard", "slot").collect())


def test_stages_take_awkward_rows(spark, docs, sf_small, monkeypatch):
    """Nulls, blank and long texts, repeated rows and further columns pass every stage."""
    wide = docs.select("*", F.lit(1).alias("shard"), F.lit(2).alias("Text"))
    monkeypatch.setattr(quality_crf, "THRESHOLD", -1.0)          # nothing is rejected
    for name, stage in cp.STAGES:
        out = stage(spark, wide, sf_small)
        n = out.count()
        if name in ("quality", "decontaminate", "shard"):
            assert n == len(ROWS)
        assert 0 < n <= 2 * len(ROWS)
        assert stage(spark, wide.limit(0), sf_small).count() == 0
