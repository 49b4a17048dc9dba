"""Exact dedup, sharding and mixing against brute force, and their defined cases."""
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import exact_dedup, mixing, sharding
from shelfcast.llm.common import table
from tests.llm.cases import ROWS, rows

SPACES = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def brute_dedup(data):
    groups = defaultdict(list)
    for d, t, *_ in data:
        groups[(t or "").translate(SPACES)].append((-len(t or ""), d is None, d or 0, d))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for i, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), i == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_dedup_defined_cases(docs, clashing, no_docs):
    want = brute_dedup(ROWS)
    assert rows(exact_dedup.exact_dedup(docs)) == want
    assert rows(exact_dedup.exact_dedup(clashing)) == want
    assert rows(exact_dedup.exact_dedup(no_docs)) == []


@pytest.mark.parametrize("salts", [1, 7])
def test_dedup_group_over_many_runs(spark, salts):
    data = [(i, "same  text" if i % 3 == 0 else f"text {i % 40}") for i in range(900)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(exact_dedup.exact_dedup(df, salts)) == brute_dedup(data)


def shard_of(key, n):
    best = []
    for i in range(n):
        u = (int(hashlib.md5(f"shard:{i}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        best.append((-1.0 / math.log(u), -i))
    return -max(best)[1]


def test_shards_defined_cases(docs, clashing, no_docs):
    got = sharding.shard_documents(docs).collect()
    assert len(got) == len(ROWS)
    by_shard = defaultdict(list)
    for r in got:
        key = "\x00" if r.doc_id is None else r.doc_id
        assert (r.shard, r.grown_shard, r.law) == (shard_of(key, 8), shard_of(key, 9), "key")
        by_shard[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert rows(sharding.shard_documents(clashing)) == rows(sharding.shard_documents(docs))
    assert rows(sharding.shard_documents(no_docs)) == []


def test_shards_keep_columns_and_grow_into_the_new_one(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("slot"), F.lit("t").alias("text"))
    out = sharding.shard_records(df, weights=(1.0, 1.0, 2.0), grown=1.0).collect()
    n = Counter(r.shard for r in out)
    assert 1350 < n[2] < 1650 and 620 < n[0] < 880                  # shares follow the weights
    assert all(r.grown_shard in (r.shard, 3) for r in out)
    assert out[0].text == "t"
    path = str(tmp_path / "shards")
    sharding.write_shards(sharding.shard_records(df), path)
    assert spark.read.parquet(path).count() == 3000
    with pytest.raises(ValueError):
        sharding.shard_records(df, weights=(1.0, 0.0))


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(2 * sizes[s] for s in full)
        over = {s for s in free if 2 * sizes[s] * sum(w[f] for f in free) <= w[s] * rest}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else rest * w[s] / sum(w[f] for f in free) for s in names}
        full |= over


def check_mix(df, data, block):
    got = mixing.mix_documents(df, block).collect()
    assert len(got) == len(data)
    count = lambda t: len((t or "").encode().split())
    sizes = Counter()
    for _d, t, _l, s, *_ in data:
        sizes[s] += count(t)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d, count(t)) for d, t, *_ in data)
    want = brute_targets(sizes)
    assert Counter((sizes[s], round(want[s], 6)) for _d, _t, _l, s, *_ in data) == Counter(
        (r.source_size, round(r.target, 6)) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    return got


def test_mix_defined_cases(docs, clashing, no_docs):
    a = check_mix(docs, ROWS, 16)
    assert sorted(map(repr, a)) == sorted(map(repr, mixing.mix_documents(clashing, 16).collect()))
    assert mixing.mix_documents(no_docs).collect() == []


def test_mix_meets_targets_and_reruns_agree(spark, sf_small):
    df = table(spark, sf_small, "documents")
    data = [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]
    got = check_mix(df, data, 64)
    source = {d: s for d, _t, _l, s in data}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1, s
    assert rows(mixing.mix_documents(df)) == rows(mixing.mix_documents(df.repartition(5)))


def test_schedule_prefixes_are_near_the_mix(spark):
    src = spark.createDataFrame([("a", 0, 10_000, 6000.0), ("b", 0, 10_000, 3000.0), ("c", 0, 900, 1000.0)],
                                "src string, no_src int, source_size long, target double")
    plan = sorted((r.slot, r.src, r.block, r.epoch, r.use) for r in mixing.schedule(mixing.cut(src, 10)).collect())
    assert len(plan) == 1000 and len({p[0] for p in plan}) == 1000
    for upto in (50, 300, 1000):
        n = Counter(p[1] for p in plan[:upto])
        assert all(abs(n[s] - share * upto) <= 8 for s, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)))
    mine = [p[2:] for p in plan if p[1] == "c"]
    assert [(e, b) for b, e, _ in mine] == [(i // 90, i % 90) for i in range(100)] and sum(u for *_, u in mine) == 1000


def test_blocks_are_equal_and_cover_the_stream(spark):
    sizes = [1, 2, 63, 64, 65, 100, 127, 128, 129, 1000]
    src = spark.createDataFrame([(f"s{n}", 0, n, 1.3 * n) for n in sizes], "src string, no_src int, source_size long, target double")
    got = mixing.cut(src, 64)
    words = got.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("source_size") - 1)).alias("w")).select(
        "src", "source_size", "blocks", "w", mixing.block_of(F.col("w")).alias("b")).withColumn("b", F.col("b"))
    n = Counter((r.src, r.source_size, r.blocks, r.b) for r in words.collect())
    for s in sizes:
        mine = [n[k] for k in sorted(n) if k[0] == f"s{s}"]
        assert len(mine) == -(-s // 64) and max(mine) <= 64 and max(mine) - min(mine) <= 1 and sum(mine) == s
    assert all(r["take"] == max(1, int(1.3 * r.source_size + 0.5)) for r in got.collect())


@pytest.mark.parametrize("sizes", [[30] * 60, [1, 10, 30, 64, 65, 200, 1], [500, 1, 1, 1, 64, 64]])
def test_small_sources_meet_their_targets(spark, sizes):
    data = [(i, " ".join(f"w{i}x{k}" for k in range(n)), "en", f"s{i:03d}", 1) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    got = check_mix(df, data, 64)
    assert all(abs(r.taken - r.target) <= 1 and r.taken >= 1 for r in got)
    assert {r.source for r in mixing.repeat_documents(df).collect()} == {d[3] for d in data}


def test_a_repeated_row_is_laid_end_to_end(spark):
    data = [(None, "one two three", "en", "s", 1)] * 400 + [(i, f"a b c{i}", "en", "s", 1) for i in range(200)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = check_mix(df, data, 64)
    assert abs(sum(r.taken for r in got) - got[0].target) <= 1


def test_repeat_documents_repeats_whole_rows(docs):
    out = mixing.repeat_documents(docs, 16).collect()
    n = Counter(r.doc_id for r in out)
    assert set(n) <= {r[0] for r in ROWS} and max(Counter((r.doc_id, r.text) for r in out).values()) <= 4
    assert all(r.text and r.text.strip() for r in out)
