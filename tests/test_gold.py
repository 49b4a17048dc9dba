import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import silver_df
from shelfcast.functions.dates import sunday_week_start
from shelfcast.functions.numeric import round_half_even
from shelfcast.operators import gold
from shelfcast.sources import fixtures


def rev_silver(spark, revenues: dict[str, float]):
    """One day per item, units 1, price = revenue."""
    rows = []
    for item, r in revenues.items():
        rows += [(item, r)]
    base = silver_df(spark, {f"{i}_X_1": [1] for i in revenues})
    price = spark.createDataFrame(rows, "item_id string, p double")
    return base.drop("sell_price", "revenue").join(price, "item_id").select(
        *[c for c in base.columns if c not in ("sell_price", "revenue")],
        F.col("p").alias("sell_price"), F.col("p").alias("revenue"))


def classes(df):
    return {r.item_id: r.abc_class for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 3])
def test_abc_boundaries_inclusive(spark, parts):
    s = rev_silver(spark, {"a": 80.0, "b": 15.0, "c": 5.0})
    assert classes(gold.abc_classification(s, parts=parts)) == {"a": "A", "b": "B", "c": "C"}


def test_abc_lone_item_and_percent_rank(spark):
    s = rev_silver(spark, {"a": 10.0})
    assert classes(gold.abc_classification(s, parts=1)) == {"a": "C"}
    assert classes(gold.abc_percent_rank(s, parts=1)) == {"a": "A"}


def test_abc_zero_total(spark):
    s = rev_silver(spark, {"a": 0.0, "b": 0.0})
    out = gold.abc_classification(s, parts=1).collect()
    assert {r.abc_class for r in out} == {"C"}
    assert all(r.revenue_share is None for r in out)


def test_abc_ties_by_item(spark):
    # total 100: "a" and "b" tie at 40; a first (item order) -> 0.40 A, b -> 0.80 A, c -> 0.90 B
    s = rev_silver(spark, {"b": 40.0, "a": 40.0, "c": 10.0, "d": 10.0})
    got = classes(gold.abc_classification(s, parts=1))
    assert got == {"a": "A", "b": "A", "c": "B", "d": "C"}


def test_abc_is_the_same_for_any_number_of_ranges(spark, sf_small):
    rev = fixtures.part_revenue(spark, sf_small).cache()
    one = gold.abc_from_revenue(rev, 10_000, parts=1).collect()
    assert sorted(one) == sorted(gold.abc_from_revenue(rev, 10_000, parts=7).collect())
    assert {k: sum(r.abc_class == k for r in one) for k in "ABC"} == {"A": 146, "B": 38, "C": 16}
    p1, p5 = (gold.percent_rank_from_revenue(rev, 10_000, parts=n).collect() for n in (1, 5))
    assert sorted(p1) == sorted(p5)


def test_percent_rank_ties_share_a_class(spark):
    s = rev_silver(spark, {"a": 9.0, "b": 9.0, "c": 5.0, "d": 0.0, "e": 0.0, "f": 0.0})
    assert classes(gold.abc_percent_rank(s)) == {"a": "A", "b": "A", "c": "B", "d": "C", "e": "C", "f": "C"}


def test_many_ranges_compile(spark):
    """Thousands of ranges are no larger a plan than a few."""
    from shelfcast.operators.prefix import running_sums
    df = spark.range(20_000).selectExpr("id AS k", "id % 7 AS v")
    out = running_sums(df, [("v", True), ("k", True)], {"run": "v"}, parts=512)
    assert out.agg(F.max("run")).first()[0] == sum(i % 7 for i in range(20_000))


def test_bucketed_prefix_with_hot_value(spark):
    """A third of the rows share one value: buckets split it by the tie key."""
    from shelfcast.operators.prefix import running_sums
    rows = [(i, 5 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, v long")
    a = running_sums(df, [("v", False), ("k", True)], {"run": "v"}, parts=1, with_total=True)
    b = running_sums(df, [("v", False), ("k", True)], {"run": "v"}, parts=9, with_total=True)
    assert a.exceptAll(b).count() == 0


def test_exact_median_matches_numpy(spark):
    import numpy as np
    from shelfcast.operators.prefix import exact_median
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    df = spark.createDataFrame([(("x" if i % 2 else "y"), v) for i, v in enumerate(vals)] + [("x", None)],
                               "g string, v double")
    got = {r.g: r.median for r in exact_median(df, "v", ["g"], parts=3).collect()}
    assert got["x"] == pytest.approx(np.median(vals[1::2]))
    assert got["y"] == pytest.approx(np.median(vals[0::2]))
    whole = exact_median(df, "v", parts=2).first().median
    assert whole == pytest.approx(np.median(vals))


def test_sunday_week_start(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 3),), (dt.date(2016, 1, 9),)], "date date")
    got = [r.w for r in df.select(sunday_week_start("date").alias("w")).collect()]
    assert got == [dt.date(2016, 1, 3), dt.date(2016, 1, 3)]


def test_round_half_even_like_pandas(spark):
    df = spark.createDataFrame([(2.25,), (2.35,), (7.25,)], "x double")
    got = [r.r for r in df.select(round_half_even("x", 1).alias("r")).collect()]
    assert got == [round(2.25, 1), round(2.35, 1), 7.2] and got[0] == 2.2


def test_weekly_avg_is_per_product_day(spark):
    s = silver_df(spark, {"A_X_1": [1, 2, 3, 4, 5, 6, 7], "B_X_1": [0] * 7})
    r = gold.weekly_category_sales(s).first()
    assert r.total_units == 28 and r.avg_daily_units == 2.0 and r.active_items == 2


def test_dim_calendar_keeps_first_by_id(spark):
    s = silver_df(spark, {"A_X_1": [1, 2], "B_X_1": [0, 0]})
    dc = gold.dim_calendar(s)
    assert dc.count() == 2 and set(dc.columns) >= {"is_event", "d", "wday"}


def test_abc_summary_rounding(spark):
    s = rev_silver(spark, {"a": 80.0, "b": 15.0, "c": 5.0})
    rows = {r.abc_class: r for r in gold.abc_summary(gold.abc_classification(s, parts=1)).collect()}
    assert rows["A"].pct_revenue == 80.0 and rows["B"].pct_items == 33.3


def test_order_outputs(spark):
    s = rev_silver(spark, {"a": 10.0, "b": 30.0, "c": 20.0})
    out = gold.order_outputs(gold.abc_classification(s, parts=1), "abc_classification").collect()
    assert [r.item_id for r in out] == ["b", "c", "a"]
