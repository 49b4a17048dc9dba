import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast import registry
from shelfcast.operators import features as feat
from shelfcast.operators import joins, reshape
from shelfcast.plans import silver as sp
from shelfcast.sources import fixtures


def wide(spark, rows, days=("d_1", "d_2")):
    cols = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", *days]
    ddl = ", ".join([f"{c} string" for c in cols[:6]] + [f"{d} int" for d in days])
    return spark.createDataFrame(rows, ddl)


def test_unpivot_keeps_nulls_sql_variant_drops(spark):
    df = wide(spark, [("a", "i", "D", "C", "S", "CA", 1, None), ("b", "j", "D", "C", "S", "CA", None, 2)])
    assert reshape.unpivot_sales(df).count() == 4
    sql = reshape.unpivot_sales_sql(df)
    assert sql.count() == 2
    assert "dept_id" not in sql.columns


def test_unpivot_gap_in_day_names(spark):
    df = wide(spark, [("a", "i", "D", "C", "S", "CA", 5, 7)], days=("d_1", "d_3"))
    got = sorted((r.d, r.units) for r in reshape.unpivot_sales(df).collect())
    assert got == [("d_1", 5), ("d_3", 7)]


def test_dept_id_is_not_a_day_column(spark):
    df = wide(spark, [("a", "i", "D", "C", "S", "CA", 1, 2)])
    assert reshape.day_columns(df) == ["d_1", "d_2"]


def test_calendar_miss_raises(spark):
    cal = fixtures.calendar(spark, fixtures.Span(dt.date(2000, 1, 1), 1))   # only d_1
    long_df = reshape.unpivot_sales(wide(spark, [("a", "i", "D", "C", "S", "CA", 1, 2)]))
    with pytest.raises(Exception, match="no calendar row"):
        joins.join_calendar(long_df, cal).collect()
    guard = joins.calendar_match_guard(long_df, cal).first()
    assert guard.n_violations == 1 and not guard.passed
    # SQL path keeps the row with a null date instead
    out = long_df.join(cal, "d", "left").where(F.col("date").isNull()).count()
    assert out == 1


def test_unknown_state_snap(spark):
    cal = fixtures.calendar(spark, fixtures.Span(dt.date(2000, 1, 1), 2))
    long_df = reshape.unpivot_sales(wide(spark, [("a", "i", "D", "C", "NY_1", "NY", 1, 2),
                                                 ("b", "i", "D", "C", "CA_1", "CA", 1, 2)]))
    joined = joins.join_calendar(long_df, cal)
    local = {(r.id, r.d): r.snap_flag for r in feat.snap_flag(joined).collect()}
    sql = {(r.id, r.d): r.snap_flag for r in feat.snap_flag_sql(joined).collect()}
    assert local[("a", "d_1")] == 0 and sql[("a", "d_1")] is None
    assert local[("b", "d_1")] == 1 == sql[("b", "d_1")]   # day 1 <= 10 -> CA SNAP


def test_clean_types_rejects_null_units(spark):
    df = spark.createDataFrame([("a", None)], "id string, units int").withColumn("date", F.current_date()) \
        .withColumn("sell_price", F.lit(None).cast("double")).withColumn("snap_flag", F.lit(0)) \
        .withColumn("is_weekend", F.lit(0)).withColumn("is_active", F.lit(0))
    with pytest.raises(Exception, match="null units"):
        feat.clean_types(df).collect()


N_DAYS = 2499                 # 1995-01-02 to 2001-11-04


def test_silver_covers_all_of_lineitem(spark, sf_small):
    """The whole date span, every unit sold, every series complete."""
    s = registry.silver(spark, sf_small)
    prof = sp.silver_profile(s).first()
    assert prof.n_rows == 125 * N_DAYS and prof.n_columns == 20
    assert prof.min_date == dt.date(1995, 1, 2) and prof.max_date == dt.date(2001, 11, 4)
    assert s.columns == sp.SILVER_COLS
    types = dict(s.dtypes)
    assert types["units"] == "int" and types["snap_flag"] == "tinyint" and types["date"] == "date"
    sold = fixtures.table(spark, sf_small, "lineitem").agg(F.sum("l_quantity")).first()[0]
    assert s.agg(F.sum("units")).first()[0] == sold
    weeks = s.select("date", "wday", "wm_yr_wk").distinct()
    assert weeks.groupBy("wm_yr_wk").agg(F.min("date").alias("a"), F.count("*").alias("n")).where("n > 7").count() == 0
    first = weeks.where("wday = 1").orderBy("date").first()
    assert first.date.isoweekday() == 6 and first.wm_yr_wk == fixtures.FIRST_WEEK + 1


def test_wide_to_long_roundtrip(spark, sf_small):
    """unpivot(pivot(x)) = x on part of the fixture's days."""
    from shelfcast.operators.reshape import series_matrix
    start = dt.date(2000, 1, 1)
    dates = [start + dt.timedelta(days=i) for i in range(60)]
    s = registry.silver(spark, sf_small).select("id", "date", "units").where(F.col("date").between(dates[0], dates[-1]))
    m = series_matrix(s, dates)
    names = F.array(*[F.lit(str(d)) for d in dates])
    back = m.select("id", F.posexplode(F.array(*[F.col(f"`{d}`") for d in dates])).alias("p", "units")) \
        .select("id", F.element_at(names, F.col("p") + 1).cast("date").alias("date"), "units")
    assert back.exceptAll(s).count() == 0 and s.exceptAll(back).count() == 0


def _small(spark, prices):
    sales = wide(spark, [("A_CA_1", "A", "D", "C", "CA_1", "CA", 1, 2), ("B_CA_1", "B", "D", "C", "CA_1", "CA", 3, 4)])
    cal = fixtures.calendar(spark, fixtures.Span(dt.date(2000, 1, 7), 2))         # Friday and Saturday: two weeks
    return sales, cal, spark.createDataFrame(prices, "store_id string, item_id string, wm_yr_wk int, sell_price double")


def test_prices_meet_their_week_only(spark):
    sales, cal, prices = _small(spark, [("CA_1", "A", 11101, 2.0), ("CA_1", "B", 11102, 5.0), ("TX_1", "A", 11102, 9.0)])
    got = {(r.id, r.d): (r.sell_price, r.revenue, r.is_active) for r in sp.silver_sales_daily(sales, cal, prices).collect()}
    assert got == {("A_CA_1", "d_1"): (2.0, 2.0, 1), ("A_CA_1", "d_2"): (None, 0.0, 0),
                   ("B_CA_1", "d_1"): (None, 0.0, 0), ("B_CA_1", "d_2"): (5.0, 20.0, 1)}


def test_prices_with_gaps_in_any_order(spark):
    """Weeks without a price before, between and behind others; a null price, a null week, a
    week that no day has, and no prices at all."""
    days = [f"d_{i}" for i in range(1, 57)]
    sales = spark.createDataFrame([(f"{k}_CA_1", k, "D", "C", "CA_1", "CA", *[1] * 56) for k in "ABC"],
                                  ", ".join([f"{c} string" for c in ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")]
                                            + [f"{d} int" for d in days]))
    cal = fixtures.calendar(spark, fixtures.Span(dt.date(2000, 1, 8), 56))        # eight weeks from a Saturday on
    weeks = sorted({r.wm_yr_wk for r in cal.collect()})
    assert len(weeks) == 8
    rows = [("A", weeks[6], 6.0), ("A", weeks[1], 1.0), ("A", weeks[4], 4.0), ("A", weeks[5], None), ("A", None, 9.0),
            ("A", 1, 9.0), ("B", weeks[7], 7.0), ("B", weeks[0], 0.5), ("D", weeks[2], 2.0)]
    want = {(k, w): p for k, w, p in rows}
    prices = spark.createDataFrame([("CA_1", *r) for r in rows],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    got = sp.silver_sales_daily(sales, cal, prices).collect()
    assert len(got) == 3 * 56
    assert all(r.sell_price == want.get((r.item_id, r.wm_yr_wk)) for r in got)
    assert all(r.sell_price is None for r in sp.silver_sales_daily(sales, cal, prices.limit(0)).collect())


def test_duplicate_price_key_still_fans_out(spark):
    from shelfcast.operators import quality as dq
    sales, cal, prices = _small(spark, [("CA_1", "A", 11101, 2.0), ("CA_1", "A", 11101, 2.5)])
    out = sp.silver_sales_daily(sales, cal, prices)
    assert out.count() == 5
    assert not dq.dq_no_fanout(out).first().passed


def test_long_rows_never_move(spark):
    """No exchange between the explode and Silver, also without any broadcast of prices."""
    sales, cal, prices = _small(spark, [("CA_1", "A", 11101, 2.0)])
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sp.silver_sales_daily(sales, cal, prices, partitions=3)._jdf.queryExecution().sparkPlan().toString()
        physical = sp.silver_sales_daily(sales, cal, prices, partitions=3)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "Generate" in plan
    above = physical[:physical.rindex("Generate posexplode")]
    assert "Exchange hashpartitioning" not in above and "Exchange rangepartitioning" not in above


def test_series_matrix_rejects_duplicates(spark):
    df = spark.createDataFrame([("a", dt.date(2000, 1, 1), 1), ("a", dt.date(2000, 1, 1), 2)],
                               "id string, date date, units int")
    with pytest.raises(ValueError):
        reshape.series_matrix(df, [dt.date(2000, 1, 1)])


def test_series_matrix_cells(spark):
    """Dates in any order and twice, cells missing, null or outside the dates, rows without a date
    or an id; a series whose cells all lie outside keeps its row."""
    day = lambda i: dt.date(2000, 1, 1) + dt.timedelta(days=i)
    df = spark.createDataFrame([("a", day(0), 1), ("a", day(2), None), ("a", day(7), 9), ("b", day(7), 5), ("b", day(-1), 6),
                                ("c", None, 3), (None, day(2), 4), ("d", None, 1), ("d", day(0), 2)],
                               "id string, date date, units int")
    wide = reshape.series_matrix(df, [day(2), day(0), day(4)])
    assert wide.columns == ["id", "2000-01-03", "2000-01-01", "2000-01-05"]
    assert [f.dataType.simpleString() for f in wide.schema.fields] == ["string", "int", "int", "int"]
    assert {tuple(r) for r in wide.collect()} == {("a", None, 1, None), ("b", None, None, None), (None, 4, None, None),
                                                  ("d", None, 2, None)}
    twice = reshape.series_matrix(df.where("id = 'a'"), [day(0), day(7), day(0)])
    assert [tuple(r) for r in twice.collect()] == [("a", 1, 9, 1)]


def test_expression_over_all_days_of_the_matrix_is_not_one_method(spark):
    """What is computed from every day column stays apart from the columns: merged with them it
    was compiled on the driver as one method, whose variables took all its memory."""
    n = 150
    dates = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    df = spark.createDataFrame([(s, d, i) for s in "ab" for i, d in enumerate(dates)], "id string, date date, units int")
    digest = registry._digest(reshape.series_matrix(df, dates), ["id"], [d.isoformat() for d in dates])
    assert {(r.id, r.units) for r in digest.collect()} == {(s, ",".join(map(str, range(n)))) for s in "ab"}
    steps = [line for line in digest._jdf.queryExecution().executedPlan().toString().split("\n") if "array_join(" in line]
    assert steps and not any("*(" in line[:line.index("Project")] for line in steps)
