"""Sharding by weighted rendezvous hashing of a stable record key.

Each (key, shard) pair has a hash u in (0, 1); the shard with the largest
-weight / ln(u) takes the record.  A shard's share follows its weight, and a
further shard takes records only into itself.  The hash is 52 bits of an MD5, so
any engine finds the same shard.

Slots number a shard's records from 0 without gaps.  Their order is the hash
order, so the top bits of that hash cut a shard into even blocks, each numbered in
its own task (``running``).

Defined cases: a null doc_id is a key of its own, so all such rows share a shard
(their slots are still dealt by the text's checksum); rows of one doc_id share a
shard; a null text has size 1 and the checksum of the empty text; an empty table
gives an empty result; extra columns are carried, those named like a result
column are replaced.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import hash52, n_blocks, pick, running

SHARDS = 8
LAW = "key"


def rendezvous(key: Column, weights: Sequence[float], seed: str = "shard") -> Column:
    """Index of the shard that wins ``key``."""
    def bid(i: int, w: float) -> Column:
        u = (hash52(F.lit(seed), F.lit(i), key) + F.lit(0.5)) / F.lit(float(1 << 52))
        return F.struct((F.lit(-float(w)) / F.log(u)).alias("bid"), F.lit(-i).alias("neg"))
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    return (-F.array_max(F.array(*[bid(i, w) for i, w in enumerate(weights)]))["neg"]).cast("int")


def shard_records(df: DataFrame, key: str = "doc_id", tie: Sequence[str] = (), weights: Sequence[float] = (1.0,) * SHARDS,
                  grown: float | None = 1.0, n_rows: int | None = None) -> DataFrame:
    """``df`` with shard, slot and grown_shard (the shard if one of weight ``grown`` is added).

    ``tie``: further columns that order the rows of one key."""
    n = df.count() if n_rows is None else n_rows
    blocks = n_blocks(n)
    order = hash52(F.lit("slot"), F.col(key), *[F.col(c) for c in tie])
    more = rendezvous(F.col(key), [*weights, grown]) if grown is not None else F.lit(None).cast("int")
    taken = {"shard", "slot", "grown_shard", "__order", "__block"}
    dealt = df.select(*[c for c in df.columns if c not in taken], rendezvous(F.col(key), weights).alias("shard"),
                      more.alias("grown_shard"), order.alias("__order"))
    dealt = dealt.withColumn("__block", F.shiftright("__order", 52 - blocks.bit_length() + 1))
    ranked = running(dealt, ["shard"], "__block", [F.col("__order"), F.col(key), *[F.col(c) for c in tie]],
                     F.lit(1), "slot")
    return ranked.drop("__order", "__block")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    sharded.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame) -> DataFrame:
    """The digest: doc_id, size, text_crc32, law, shard, slot, grown_shard.  The texts
    are reduced to size and checksum before anything moves."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = pick(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit(LAW).alias("law"))
    return shard_records(slim, "doc_id", ["text_crc32", "size"], n_rows=docs.count()).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
