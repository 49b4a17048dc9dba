"""Chat formatting with the perspective rotated over all participants.

For every conversation and every participant the dialogue is rendered once with
that speaker as ``assistant`` and all others as named users; the masks are the
code point spans that the model shall learn, the assistant's words and the end
mark behind them.  A conversation is rendered in parts of ``PART_TURNS`` turns
(nearly always one), so that one of any length is never gathered in one task; its
parts, joined in order, are the whole rendering, and masks count from their part.

Turns are numbered in blocks of turn numbers (``running``), so a conversation that
holds a third of all rows is numbered by many tasks.  The participants are spread
over the parts before the join, whose key is (conversation, part).

Defined cases: rows with a null conv_id form one conversation; a null turn comes
last; equal turns are ordered by role and text and all kept; a null text is empty;
a null role is an unnamed user and no participant; ``system`` stays system and is
no participant; a conversation without participants has no rendering; the marks
``<|`` inside texts and roles are written ``< |``; an empty table gives an empty
result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import hash52, n_blocks, pick, running

PART_TURNS = 256
BLOCK_TURNS = 64
START, END = "<|im_start|>", "<|im_end|>"


def _plain(c: Column) -> Column:
    return F.replace(F.coalesce(c, F.lit("")), F.lit("<|"), F.lit("< |"))


def numbered(conversations: DataFrame) -> DataFrame:
    """cid, no_id, conv_id, role, text, nth (from 0 in the conversation), part."""
    turns = pick(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", F.coalesce("conv_id", F.lit(0)).alias("cid"), F.col("conv_id").isNull().cast("int").alias("no_id"),
        "turn", "role", "text", hash52(F.col("role"), F.col("text")).alias("h"))
    shift = 52 - n_blocks(conversations.count()).bit_length() + 1
    # turns without a number have blocks by their hash, behind all others
    block = F.when(F.col("turn").isNull(), F.lit(1 << 60) + F.shiftright("h", shift)).otherwise(
        F.floor(F.col("turn") / BLOCK_TURNS))
    order = [F.col("turn"), F.when(F.col("turn").isNull(), F.col("h")), F.col("role").asc_nulls_last(),
             F.col("text").asc_nulls_last()]
    return (running(turns.withColumn("block", block.cast("long")), ["cid", "no_id"], "block", order, F.lit(1), "nth")
            .withColumn("part", F.floor(F.col("nth") / PART_TURNS).cast("int")))


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, masks ("start:end,..."), n_masked."""
    turns = numbered(conversations)
    keys = ["cid", "no_id", "part"]
    parts = turns.groupBy(*keys).agg(F.first("conv_id").alias("conv_id"))
    who = turns.where("role IS NOT NULL AND role <> 'system'").select(
        "cid", "no_id", F.col("role").alias("perspective")).distinct()
    views = who.join(turns.groupBy("cid", "no_id").agg(F.max("part").alias("last")), ["cid", "no_id"]).select(
        "cid", "no_id", "perspective", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("part"))
    own = F.col("role").eqNullSafe(F.col("perspective"))
    speaker = (F.when(own, F.lit("assistant")).when(F.col("role") == "system", F.lit("system"))
               .when(F.col("role").isNull(), F.lit("user"))
               .otherwise(F.concat(F.lit("user name="), _plain(F.col("role")))))
    head = F.concat(F.lit(START), speaker, F.lit("\n"))
    said = turns.join(views, keys).select(
        *keys, "perspective", "nth", own.alias("own"), F.length(head).alias("n_head"),
        F.concat(head, _plain(F.col("text")), F.lit(END + "\n")).alias("said"))
    upto = Window.partitionBy(*keys, "perspective").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = said.withColumn("at", F.coalesce(F.sum(F.length("said")).over(upto), F.lit(0)))
    first, last = F.col("at") + F.col("n_head"), F.col("at") + F.length("said") - 1
    in_order = F.sort_array(F.collect_list(F.struct(
        "nth", "said", F.when(F.col("own"), F.concat(first.cast("string"), F.lit(":"), last.cast("string"))).alias("mask"))))
    out = placed.groupBy(*keys, "perspective").agg(
        in_order.alias("all"), F.count(F.lit(1)).alias("n_turns"),
        F.sum(F.when(F.col("own"), last - first).otherwise(0)).cast("long").alias("n_masked"))
    return out.join(parts, keys).select(
        "conv_id", "perspective", "part", "n_turns", F.array_join("all.said", "").alias("text"),
        F.array_join(F.filter("all.mask", lambda m: m.isNotNull()), ",").alias("masks"), "n_masked")


ORACLE = f"""
WITH t AS (
  SELECT conv_id, role, coalesce(text, '') AS raw,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) - 1 AS nth
  FROM conversations),
w AS (SELECT DISTINCT conv_id AS c, role AS perspective FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
s AS (
  SELECT t.conv_id, w.perspective, CAST(t.nth // {PART_TURNS} AS INTEGER) AS part, t.nth,
         t.role IS NOT DISTINCT FROM w.perspective AS own,
         '{START}' || CASE WHEN t.role = w.perspective THEN 'assistant' WHEN t.role = 'system' THEN 'system'
                           WHEN t.role IS NULL THEN 'user'
                           ELSE 'user name=' || replace(t.role, '<|', '< |') END || chr(10) AS head,
         replace(t.raw, '<|', '< |') || '{END}' || chr(10) AS body
  FROM t JOIN w ON t.conv_id IS NOT DISTINCT FROM w.c),
p AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (
      PARTITION BY conv_id, perspective, part ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM s)
SELECT conv_id, perspective, part, count(*) AS n_turns, string_agg(head || body, '' ORDER BY nth) AS text,
       coalesce(string_agg(CAST(pos + length(head) AS BIGINT) || ':' || CAST(pos + length(head) + length(body) - 1 AS BIGINT), ','
                ORDER BY nth) FILTER (WHERE own), '') AS masks,
       CAST(sum(CASE WHEN own THEN length(body) - 1 ELSE 0 END) AS BIGINT) AS n_masked
FROM p GROUP BY ALL
"""
