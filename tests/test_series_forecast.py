import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import silver_df
from shelfcast.operators import forecast as fc
from shelfcast.operators import metrics as mt
from shelfcast.operators import series as se
from shelfcast.session import scratch_path


def test_rolling_mean_min_periods(spark):
    s = silver_df(spark, {"A_X_1": list(range(1, 11))}).select("id", "date", "units")
    got = [r.rolling_mean_7 for r in se.rolling_mean_features(s, windows=(7,)).orderBy("date").collect()]
    assert got[:7] == [None] * 7 and got[7:] == [4.0, 5.0, 6.0]


def test_lag_does_not_leak_across_series(spark):
    s = silver_df(spark, {"A_X_1": [1, 2, 3], "B_X_1": [7, 8, 9]}).select("id", "date", "units")
    rows = {(r.id, r.units): r.lag_1 for r in se.lag_features(s, lags=(1,)).collect()}
    assert rows[("B_X_1", 7)] is None and rows[("B_X_1", 8)] == 7 and rows[("A_X_1", 1)] is None


def test_split_too_short_raises(spark):
    s = silver_df(spark, {"A_X_1": [1] * 28})
    with pytest.raises(ValueError):
        se.temporal_split(s, horizon=28)
    train, test, _ = se.temporal_split(silver_df(spark, {"A_X_1": [1] * 30}), horizon=28)
    assert train.count() == 2 and test.count() == 28


def test_first_sale_lifecycle(spark):
    from shelfcast.operators import diagnostics as dg
    series = {"never_X_1": [0] * 100, "day0_X_1": [1] + [1] * 99, "late_X_1": [0] * 5 + [2] * 95,
              "dead_X_1": [3] * 5 + [0] * 95}
    s = silver_df(spark, series)
    idx = {r.id: r.first_sale_index for r in se.series_first_sale(s).collect()}
    assert idx == {"never_X_1": -1, "day0_X_1": 0, "late_X_1": 5, "dead_X_1": 0}
    life = dg.series_lifecycle(dg.series_stats(s)).first()
    assert (life.never_sold, life.born_late, life.dead_90) == (1, 1, 2)


# Two series of 35 days, 7 of them to be forecast; worked out by hand.
#   W repeats 1..7, so its last week is again 1..7; F is 4 until the last week, then 6.
HAND = {"W_X_1": [1, 2, 3, 4, 5, 6, 7] * 5, "F_X_1": [4] * 28 + [6] * 7}


def test_baselines_by_hand(spark):
    frame = fc.baseline_frame(silver_df(spark, HAND), horizon=7)
    got = {(r.model, r.id, r.step): r.yhat for r in fc.baseline_forecasts(frame).collect()}
    assert [got["naive", "W_X_1", k] for k in (1, 7)] == [7.0, 7.0]
    assert [got["seasonal_naive_7", "W_X_1", k] for k in range(1, 8)] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    assert got["moving_average_7", "W_X_1", 3] == 4.0 and got["moving_average_28", "F_X_1", 5] == 4.0
    assert got["zero", "F_X_1", 1] == 0.0
    scale = {r.id: r.scale for r in frame.collect()}
    # W's differences: 24 ones and 3 drops of 6 among 27 -> (24 + 108) / 27; F is flat
    assert scale["W_X_1"] == pytest.approx(132 / 27) and scale["F_X_1"] is None


def test_metrics_by_hand(spark):
    s = silver_df(spark, HAND)
    ev = {r.model: r for r in mt.evaluate_models(fc.baseline_forecasts(fc.baseline_frame(s, horizon=7)), digits=6).collect()}
    # seasonal naive: exact on W, off by 2 on each of F's seven days (of 6)
    sn = ev["seasonal_naive_7"]
    assert sn.MAE == 1.0 and sn.RMSE == 1.414214 and sn.RMSSE == 0.0
    assert sn.MAPE == 16.666667 and sn.sMAPE == 20.0
    # naive: W misses by 6, 5, 4, 3, 2, 1, 0 (sum 21, squares 91), F by 2 each
    nv = ev["naive"]
    assert nv.MAE == 2.5 and nv.RMSE == 2.915476 and nv.RMSSE == 1.630672
    # zero: every point with sales is 100 % off
    assert ev["zero"].MAPE == 100.0 and ev["zero"].sMAPE == 200.0


def test_a_gap_is_refused(spark):
    s = silver_df(spark, HAND)
    with pytest.raises(ValueError, match="F_X_1 has 34"):
        fc.baseline_frame(s.where(~((F.col("id") == "F_X_1") & (F.col("date") == "2000-01-05"))), horizon=7)
    with pytest.raises(ValueError, match="incomplete"):
        fc.baseline_frame(s.withColumn("units", F.when(F.col("units") != 7, F.col("units"))), horizon=7)


def test_every_model_can_be_served(spark):
    s = silver_df(spark, {"A_CA_1": [1, 2, 3, 4, 5, 6, 7] * 5})
    feats = fc.demand_features(s)
    model = fc.train_demand_model(feats, max_iter=2)
    table = fc.write_forecasts(s, scratch_path(spark, "served"), (*fc.BASELINE_MODELS, "gbt"), model)
    assert {r.model for r in table.select("model").distinct().collect()} == {*fc.BASELINE_MODELS, "gbt"}
    sn = sorted((r.date, r.predicted_units) for r in fc.forecast_lookup(table, None, None, 9, "seasonal_naive_7").collect())
    assert [v for _, v in sn] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 1.0, 2.0]
    assert fc.forecast_lookup(table, None, None, 90, "gbt").where("predicted_units IS NULL").count() == 0


def test_all_zero_actuals(spark):
    df = spark.createDataFrame([("m", "a", 1, 0, 1.0, None), ("m", "a", 2, 0, 0.0, None)],
                               "model string, id string, step int, y int, yhat double, scale double")
    r = mt.evaluate_models(df).first()
    assert r.MAPE is None and r.sMAPE == 200.0   # 200 on the first point, the second is skipped
    df0 = df.withColumn("yhat", F.lit(0.0))
    assert mt.evaluate_models(df0).first().sMAPE == 0.0


def test_zero_weights_uniform(spark):
    s = silver_df(spark, {"A_X_1": [0] * 60, "B_X_1": [0] * 60})
    w = {r.id: r.weight for r in fc.revenue_weights(s, horizon=28).collect()}
    assert w == {"A_X_1": 0.5, "B_X_1": 0.5}


@pytest.mark.parametrize("h,ok", [(0, False), (1, True), (90, True), (91, False)])
def test_lookup_horizon(spark, h, ok):
    s = silver_df(spark, {"A_X_1": [1] * 40})
    table = fc.forecasts_table(s)
    if ok:
        assert fc.forecast_lookup(table, "A", "CA_1", h).count() == h
    else:
        with pytest.raises(ValueError):
            fc.forecast_lookup(table, "A", "CA_1", h)


def test_best_model_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.5), ("c", 0.7)], "model string, RMSSE double")
    assert mt.best_model(df).first().model == "b"


def test_gbt_trains_and_predicts(spark):
    rng = np.random.default_rng(0)
    s = silver_df(spark, {f"S{i}_X_1": [int(x) for x in rng.poisson(3, 60)] for i in range(3)})
    feats = fc.demand_features(s)
    train, test = se.cutoff_split(feats, "date", "2000-02-15")
    model = fc.train_demand_model(train, max_iter=3)
    out = fc.predict_demand(model, test)
    assert out.count() == test.count() and out.where(F.col("predicted_units").isNull()).count() == 0
