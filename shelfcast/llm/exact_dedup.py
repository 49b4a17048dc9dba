"""Exact dedup by content sort.

Sampled splitters range-partition the normalised texts, an external sort places
equal ones next to each other, and a window compares neighbours in full.

The splitters are taken on a key of bounded length (first code points, 64-bit
hash of the whole, salt), so the sample and the splitters on the driver stay small
however long the texts are; the sort inside a partition and the comparison are on
the whole text.  ``salt`` (from doc_id) cuts a text that a third of all rows share
into at most ``SALTS`` runs.  Spark's window needs no further exchange: the range
partitioning on a part of its keys already clusters them.  The texts move once and
are dropped there; the runs of one text are then joined by the SHA-256 that the
result carries anyway, at most ``SALTS`` slim rows a text.

Defined cases: a null text is the empty text; texts that are empty after
normalising are equal to each other; ties go to the smallest doc_id, a null doc_id
last; of repeated rows (equal doc_id and text) exactly one is kept; an empty table
gives an empty result; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import SPACE, pick, staged

SALTS = 256
LEAD = 32          # code points of the text in the splitter key


def exact_dedup(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = pick(docs, "doc_id", "text").select(
        "doc_id", (-F.length(text)).alias("neg_len"), F.translate(text, SPACE, "").alias("norm"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    ).select("*", F.substring("norm", 1, LEAD).alias("lead"), F.xxhash64("norm").alias("h"))
    dealt = keyed.repartitionByRange("lead", "h", "salt")
    best = F.struct("neg_len", F.col("doc_id").isNull().alias("no_id"), "doc_id")
    run = Window.partitionBy("lead", "h", "salt", "norm")
    first = run.orderBy("neg_len", F.col("doc_id").asc_nulls_last())
    rows = staged(dealt.select(
        "doc_id", "salt", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.row_number().over(first).alias("nth"),
        F.first(best).over(first).alias("run_best"),
        F.count(F.lit(1)).over(run).alias("run_rows")), "exact-rows")
    # one slim row per run; at most SALTS of them per text
    of_text = Window.partitionBy("text_sha256")
    runs = rows.where("nth = 1").select(
        "text_sha256", "salt", F.min("run_best").over(of_text).alias("best"),
        F.sum("run_rows").over(of_text).alias("group_size"))
    return (rows.join(runs, ["text_sha256", "salt"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        ((F.col("nth") == 1) & F.col("run_best").eqNullSafe(F.col("best"))).alias("kept"), "text_sha256"))


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     w AS (SELECT doc_id, norm,
                  row_number() OVER (PARTITION BY norm ORDER BY length(x) DESC, doc_id NULLS LAST) AS nth,
                  first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(x) DESC, doc_id NULLS LAST) AS keep_id,
                  count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, sha256(norm) AS text_sha256 FROM w
"""
