"""Mergeable states against the views made from all days at once."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import silver_df
from shelfcast.operators import gold, kpis, states
from shelfcast.session import scratch_path
from shelfcast.sources import versions

SERIES = {f"I{i:02d}_{s}": [(i * k + len(s)) % (3 + i % 4) if k > 4 * i else 0 for k in range(70)] for i in range(9) for s in ("CA_1", "TX_1")}


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr) if cols else sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def silver(spark):
    s = silver_df(spark, SERIES, price=1.25)
    return s.withColumn("store_id", F.regexp_extract("id", "_(.._.)$", 1)).withColumn(
        "cat_id", F.when(F.col("item_id") < "I04", "FOODS").otherwise("HOBBIES")).cache()


def check(spark, state, codes, days):
    weekly = gold.weekly_category_sales(days)
    assert rows(states.weekly_category_sales(state), *weekly.columns) == rows(weekly)
    abc = gold.abc_classification(days)
    assert rows(states.abc_classification(state), *abc.columns) == rows(abc)
    k = kpis.store_kpis(gold.fact_sales(days), abc)
    assert rows(states.store_kpis(state, codes), *k.columns) == rows(k)
    want = days.where("units > 0").groupBy("store_id").agg(F.countDistinct("item_id").alias("n"))
    assert {r.store_id: r.n_items for r in states.distinct_items(state, ["store_id"]).collect() if r.n_items} == {r.store_id: r.n for r in want.collect()}


def test_three_appended_batches_equal_a_rebuild(spark, silver):
    root, start = scratch_path(spark, "s"), dt.date(2000, 1, 1)
    cuts = [start, start + dt.timedelta(days=10), start + dt.timedelta(days=45), start + dt.timedelta(days=70)]     # weeks are cut, too
    for a, b in zip(cuts, cuts[1:]):
        held = states.append_days(spark, root, silver.where((F.col("date") >= F.lit(a)) & (F.col("date") < F.lit(b))))
        check(spark, held, versions.open_version(spark, f"{root}/codes"), silver.where(F.col("date") < F.lit(b)))
    assert versions.versions(spark, f"{root}/weekly") == [1, 2, 3]


def test_an_append_that_died_is_not_seen(spark, silver):
    root, day = scratch_path(spark, "s"), F.lit(dt.date(2000, 2, 1))
    states.append_days(spark, root, silver.where(F.col("date") < day))
    half = states.state(silver, states.item_codes(silver))
    versions.publish_version(half.items, f"{root}/items")             # died before the weekly state
    held = states.append_days(spark, root, silver.where(F.col("date") >= day))
    check(spark, held, versions.open_version(spark, f"{root}/codes"), silver)


def test_codes_are_kept_and_dense(spark, silver):
    old = states.item_codes(silver.where("item_id > 'I03'"))
    new = states.item_codes(silver, old)
    a, b = ({r.item_id: r.code for r in x.collect()} for x in (old, new))
    assert all(b[i] == c for i, c in a.items()) and sorted(b.values()) == list(range(9))
    many = spark.range(70_000).select(F.format_string("i%06d", "id").alias("item_id"))
    codes = states.item_codes(many)
    s = many.join(codes, "item_id").select(
        F.col("item_id").alias("id"), "item_id", F.lit("C").alias("cat_id"), F.lit("S").alias("store_id"), F.lit(1).alias("wm_yr_wk"),
        (F.col("code") % 2).cast("int").alias("units"), F.lit(1.0).alias("revenue"))
    st = states.state(s, codes)
    assert st.weekly.count() == 3                                     # parts of 32,768 items
    r = states.weekly_category_sales(st).first()
    assert (r.active_items, r.total_units, r.total_revenue) == (70_000, 35_000, 70_000.0)
    assert states.distinct_items(st, ["store_id"]).first().n_items == 35_000


def test_silver_is_scanned_once(spark, silver):
    path = scratch_path(spark, "sil")
    silver.write.parquet(path)
    days = spark.read.parquet(path)
    codes = states.item_codes(days)
    st = states.state(days, codes)
    for df in (st.weekly, st.items):                                   # both start from the checkpoint
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString().replace("codes", "") or "Scan ExistingRDD" in \
            df._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in st.items._jdf.queryExecution().executedPlan().toString()
