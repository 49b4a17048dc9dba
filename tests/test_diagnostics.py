import pytest
from pyspark.sql import functions as F

from helpers import silver_df
from shelfcast.operators import diagnostics as dg


@pytest.mark.parametrize("adi,cv2,klass", [(1.31, 0.48, "smooth"), (1.31, 0.49, "erratic"),
                                           (1.32, 0.48, "intermittent"), (1.32, 0.49, "lumpy"),
                                           (None, None, "sin_demanda")])
def test_class_cuts(spark, adi, cv2, klass):
    df = spark.createDataFrame([(adi, cv2)], "adi double, cv2 double")
    assert df.select(dg.classify_syntetos_boylan("adi", "cv2").alias("c")).first().c == klass


def test_demand_stats_exact(spark):
    # from first sale on: 2 of 4 days sold, units 17 and 3 -> ADI 2.0, CV2 exactly 0.49 -> lumpy
    s = silver_df(spark, {"A_X_1": [0, 17, 0, 3, 0]})
    d = dg.demand_stats(dg.series_stats(s)).first()
    assert d.first_sale_index == 1 and d.adi == 2.0 and d.cv2 == pytest.approx(0.49)
    assert d.demand_class == "lumpy"
    smooth = dg.demand_stats(dg.series_stats(silver_df(spark, {"B_X_1": [5, 5, 5, 6]}))).first()
    assert smooth.demand_class == "smooth"


def test_all_classes_reached(spark):
    series = {"sm_X_1": [5, 5, 6, 5, 5, 6], "er_X_1": [1, 9, 1, 9, 1, 9], "in_X_1": [5, 0, 0, 5, 0, 0],
              "lu_X_1": [1, 0, 0, 9, 0, 0], "no_X_1": [0] * 6}
    got = {r.id: r.demand_class for r in dg.demand_stats(dg.series_stats(silver_df(spark, series))).collect()}
    assert got == {"sm_X_1": "smooth", "er_X_1": "erratic", "in_X_1": "intermittent",
                   "lu_X_1": "lumpy", "no_X_1": "sin_demanda"}


def test_snap_lift_one_sided(spark):
    s = silver_df(spark, {"A_X_1": [1, 2, 3]})          # snap_flag all 0
    r = dg.snap_lift(s).first()
    assert r.mean_snap is None and r.lift_pct is None and r.mean_no_snap == 2.0
    s2 = s.withColumn("snap_flag", F.when(F.col("units") == 3, 1).otherwise(0).cast("tinyint"))
    assert dg.snap_lift(s2).first().lift_pct == pytest.approx(100.0)


def test_weekday_index_averages_weekday_means(spark):
    s = silver_df(spark, {"A_X_1": [1] * 14})
    rows = dg.weekday_seasonality(s).collect()
    assert len(rows) == 7 and all(r.seasonal_index == 100.0 for r in rows)
    assert dg.weekday_spread(s).first().weekly_seasonality is False


def test_intermittency_median_interpolates(spark):
    s = silver_df(spark, {"A_X_1": [0, 1, 2, 10]})
    r = dg.intermittency_profile(s).first()
    assert r.median_units == 1.5 and r.zero_share == 0.25 and r.n_cells == 4


def test_active_days_run_to_the_end_of_the_axis(spark):
    """A series whose rows stop early is still active until the last date of all."""
    s = silver_df(spark, {"A_X_1": [2, 0, 2, 0, 0, 0], "B_X_1": [1] * 6})
    short = s.where(~((F.col("id") == "A_X_1") & (F.col("date") > "2000-01-03")))
    assert {r.id: r.adi for r in dg.demand_stats(dg.series_stats(short)).collect()} == {"A_X_1": 3.0, "B_X_1": 1.0}


def test_huge_units_do_not_overflow(spark):
    s = silver_df(spark, {"A_X_1": [2_000_000_000, 2_000_000_000, 1_000_000_000]})
    d = dg.demand_stats(dg.series_stats(s)).first()
    assert d.cv2 == pytest.approx(0.08) and d.demand_class == "smooth"


def test_overall_medians(spark):
    series = {"a_X_1": [5, 0, 0, 5], "b_X_1": [5, 5, 5, 5], "c_X_1": [1, 9, 1, 9], "n_X_1": [0] * 4}
    rows = dg.demand_class_summary(dg.demand_stats(dg.series_stats(silver_df(spark, series)))).collect()
    assert len(rows) == 4
    assert {r.overall_median_adi for r in rows} == {1.0} and {r.overall_median_cv2 for r in rows} == {0.0}


def test_one_rule_for_both_classifiers(spark):
    df = spark.createDataFrame([(33, 25, 49, 100), (32, 25, 48, 100)], "an long, ad long, cn long, cd long")
    exact = [r.c for r in df.select(dg.syntetos_boylan(F.col("an"), F.col("ad"), F.col("cn"), F.col("cd")).alias("c")).collect()]
    plain = [r.c for r in df.select(dg.classify_syntetos_boylan(F.col("an") / F.col("ad"), F.col("cn") / F.col("cd")).alias("c")).collect()]
    assert exact == plain == ["lumpy", "smooth"]
