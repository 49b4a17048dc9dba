"""Mergeable states of the weekly and product views: new days are added to what is stored.

A state holds sums and, for distinct items, bitmaps over a dense item code.  States of
different days are merged by adding the sums and or-ing the bitmaps, so a view of all days
comes from the stored state and the new days alone, and a longer period or a larger group
(a store, a year) is a union of states.  Both states come from one scan of Silver, by way of one
aggregate per series and week that its buckets need no exchange for.

weekly: (cat_id, store_id, wm_yr_wk, part) -> units, rev (cents), n (units that aren't null),
        items and sold (bitmaps of the items with rows, and with units above 0)
items:  item_id -> rev, total_units
A bitmap covers 32,768 item codes (``part`` says which); the sums lie with the first of a key's parts
that a batch has, which adding up doesn't notice.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.numeric import cents_sum, money, round_half_up
from shelfcast.operators import prefix
from shelfcast.session import checkpoint_root
from shelfcast.sources import versions

WEEK = ["cat_id", "store_id", "wm_yr_wk"]
SUMS = ["units", "rev", "n"]
BITMAPS = ["items", "sold"]


@dataclass
class State:
    weekly: DataFrame
    items: DataFrame


def item_codes(items: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """item_id, code: known items keep their codes, new ones follow in order of their ids."""
    new = items.select("item_id").where("item_id IS NOT NULL").distinct()
    first = 0
    if known is not None:
        new = new.join(known, "item_id", "left_anti")
        first = (known.agg(F.max("code")).first()[0] or 0) + 1 if known.limit(1).count() else 0
    numbered = prefix.running(new.withColumn("one", F.lit(1).cast("long")), [("item_id", True)], {"code": ("sum", "one")}, exclusive=True)
    numbered = numbered.select("item_id", (F.col("code") + first).cast("long").alias("code"))
    return numbered if known is None else known.select("item_id", "code").unionByName(numbered)


def _bitmap(code: Column, when: Column | None = None) -> Column:
    at = F.bitmap_bit_position(code + 1)                     # Spark numbers bits from 1
    return F.bitmap_construct_agg(F.when(when, at) if when is not None else at)


def state(silver: DataFrame, codes: DataFrame) -> State:
    """The state of Silver's days; ``codes`` as from ``item_codes``, for all of its items."""
    checkpoint_root(silver.sparkSession)
    per = silver.groupBy("id", "item_id", *WEEK).agg(
        F.sum("units").alias("units"), cents_sum("revenue").alias("rev"), F.count("units").alias("n"),
        F.max(F.col("units") > 0).alias("any")).checkpoint(eager=True)
    keyed = per.where(" AND ".join(f"{c} IS NOT NULL" for c in WEEK)).join(codes, "item_id", "left")
    part = F.coalesce(F.bitmap_bucket_number(F.col("code") + 1), F.lit(0)).alias("part")
    weekly = keyed.groupBy(*WEEK, part).agg(
        *[F.sum(c).alias(c) for c in SUMS], _bitmap(F.col("code"), F.col("code").isNotNull()).alias("items"),
        _bitmap(F.col("code"), F.col("any") & F.col("code").isNotNull()).alias("sold"))
    items = per.groupBy("item_id").agg(F.sum("rev").alias("rev"), F.sum("units").alias("total_units"))
    return State(weekly, items)


def merge(*states: State) -> State:
    """The state of all days that the states are of (each day in one of them)."""
    weekly, items = states[0].weekly, states[0].items
    for s in states[1:]:
        weekly, items = weekly.unionByName(s.weekly), items.unionByName(s.items)
    return State(
        weekly.groupBy(*WEEK, "part").agg(*[F.sum(c).alias(c) for c in SUMS], *[F.bitmap_or_agg(c).alias(c) for c in BITMAPS]),
        items.groupBy("item_id").agg(F.sum("rev").alias("rev"), F.sum("total_units").alias("total_units")))


def weekly_category_sales(s: State) -> DataFrame:
    """The weekly view, from a state (``operators.gold.weekly_category_sales`` of the same days)."""
    return s.weekly.groupBy(*WEEK).agg(
        F.sum("units").alias("total_units"), money(F.sum("rev")).alias("total_revenue"),
        round_half_up(F.try_divide(F.sum("units"), F.sum("n")), 6).alias("avg_daily_units"),
        F.sum(F.bitmap_count("items")).alias("active_items"))


def abc_classification(s: State, parts: int | None = None) -> DataFrame:
    """The Pareto classes, from a state."""
    from shelfcast.operators.gold import abc_from_revenue

    return abc_from_revenue(s.items, parts=parts)


def distinct_items(s: State, by: list[str], which: str = "sold") -> DataFrame:
    """Distinct items per group of any of the weekly keys: the groups' bitmaps are or-ed, not counted again."""
    united = s.weekly.groupBy(*by, "part").agg(F.bitmap_or_agg(which).alias("b"))
    return united.groupBy(*by).agg(F.sum(F.bitmap_count("b")).alias("n_items"))


def store_kpis(s: State, codes: DataFrame) -> DataFrame:
    """The KPIs of each store (``operators.kpis.store_kpis``), from a state: its A products are counted as
    |sold| + |A| - |sold or A| of bitmaps."""
    at = F.col("code") + 1
    best = abc_classification(s).where("abc_class = 'A'").join(codes, "item_id").groupBy(
        F.bitmap_bucket_number(at).alias("part")).agg(_bitmap(F.col("code")).alias("a"))
    sold = s.weekly.groupBy("store_id", "part").agg(*[F.sum(c).alias(c) for c in SUMS], F.bitmap_or_agg("sold").alias("b"))
    met = sold.join(best, "part", "left")
    # one row per store and part; or-ed by laying the two bitmaps below each other
    both = met.where("a IS NOT NULL").select("store_id", "part", F.explode(F.array("a", "b")).alias("x")).groupBy("store_id", "part").agg(
        F.bitmap_count(F.bitmap_or_agg("x")).alias("either"))
    counted = met.join(both, ["store_id", "part"], "left").withColumn("n_a", F.when(
        F.col("a").isNotNull(), F.bitmap_count("a") + F.bitmap_count("b") - F.col("either")).otherwise(0))
    return counted.groupBy("store_id").agg(
        money(F.sum("rev")).alias("total_revenue"), round_half_up(F.try_divide(F.sum("units"), F.sum("n")), 6).alias("avg_daily_units"),
        F.sum("n_a").cast("bigint").alias("abc_a_products"))


def append_days(spark: SparkSession, root: str, days: DataFrame) -> State:
    """Add new days to the state stored under ``root`` (made, if there is none) and read it back.

    Item codes, weekly and product state are one version each; the days are scanned once.  The weekly
    state is published last, and names the versions that it belongs to by its own number."""
    tables = {k: f"{root.rstrip('/')}/{k}" for k in ("codes", "items", "weekly")}
    last = max(versions.versions(spark, tables["weekly"]), default=0)
    old = {k: versions.open_version(spark, p, last) for k, p in tables.items()} if last else None
    codes = item_codes(days, old["codes"] if old else None).checkpoint(eager=True)
    now = state(days, codes)
    if old:
        now = merge(State(old["weekly"], old["items"]), now)
    for k, df in (("codes", codes), ("items", now.items), ("weekly", now.weekly)):
        # a version above the weekly state's is of a run that died: it goes
        for v in versions.versions(spark, tables[k]):
            if v > last:
                versions.retract(spark, tables[k], v)
        versions.publish_version(df, tables[k], number=last + 1)
    return State(versions.open_version(spark, tables["weekly"]), versions.open_version(spark, tables["items"]))
