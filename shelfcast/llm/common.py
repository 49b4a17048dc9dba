"""Helpers shared by the text operators.

Every operator names its input columns exactly and takes them by position
(``pick``), so that extra columns, also ones whose names differ only in case or
equal an operator's own column names, can't clash.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.session import scratch_path

DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
SPACE = " \t\n\x0b\x0c\r"                    # [\x20\x09-\x0D]
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK_ROWS = 50_000                          # rows that one ordered block should hold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, matched exactly; of several with one name the first."""
    at = [df.columns.index(n) for n in names]
    return df.toDF(*[f"__c{i}" for i in range(len(df.columns))]).select(
        *[F.col(f"__c{i}").alias(n) for i, n in zip(at, names)])


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is (``lower`` would fold all of Unicode)."""
    return F.translate(c, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash52(*parts: Column) -> Column:
    """Uniform 52-bit integer of the joined parts: the same in any engine that has md5."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read back: cuts the lineage, and
    what follows survives the loss of executors without running the plan again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_blocks(n_rows: int, per_block: int = BLOCK_ROWS) -> int:
    """Power of two so that ``n_rows`` spread evenly give blocks of about ``per_block`` rows."""
    return 1 << max(0, math.ceil(math.log2(max(1, n_rows) / per_block)))


def running(df: DataFrame, groups: Sequence[str], block: str, order: Sequence[Column],
            value: Column, out: str, generated: bool = False) -> DataFrame:
    """Sum of ``value`` over the earlier rows of the group, by ``block`` and then ``order``.

    ``groups`` (never null) may be as uneven as they like: a group is cut into its
    blocks, each block is summed in a task of its own, and the blocks' totals (one
    row per group and block) give what lies before each block.  ``generated``: the rows come from
    few, so Spark takes them for few, too, and must not choose a broadcast by that.
    """
    keys = [*groups, block]
    before = Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = (df.groupBy(*keys).agg(F.sum(value).alias("__sum"))
              .select(*keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")))
    return (df.withColumn("__in", F.coalesce(F.sum(value).over(within), F.lit(0)))
            .join(totals.hint("merge") if generated else totals, keys)
            .withColumn(out, (F.col("__base") + F.col("__in")).cast("long"))
            .drop("__in", "__base"))


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Arrow batches of at most ``rows`` texts, so that long ones fit a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))
