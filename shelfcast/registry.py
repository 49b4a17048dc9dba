"""Name -> job registry.

Every callable takes (spark, sf_dir) and returns a DataFrame computed from the
driver tables in ``sf_dir``: the Bronze projection is derived from them on the
fly, and the Silver layer - like the reference's persisted Silver file - is
written once per session and application into the shared checkpoint folder
and then read by every job that starts from Silver.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.numeric import cents_sum, money
from shelfcast.operators import diagnostics as dg
from shelfcast.operators import features as feat
from shelfcast.operators import forecast as fc
from shelfcast.operators import gold
from shelfcast.operators import joins
from shelfcast.operators import kpis
from shelfcast.operators import metrics as mt
from shelfcast.operators import quality as dq
from shelfcast.operators import reshape
from shelfcast.operators import series as se
from shelfcast.operators import states
from shelfcast.plans import silver as silver_plan
from shelfcast.plans.gold import write_gold
from shelfcast.plans.pipeline import run_pipeline
from shelfcast.schemas import ID_COLS
from shelfcast.session import scratch_path
from shelfcast.sources import bronze as bz
from shelfcast.sources import files
from shelfcast.sources import fixtures
from shelfcast.sources import quarantine
from shelfcast.sources import versions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------ shared inputs ---
_BRONZE: dict[tuple, fixtures.Bronze] = {}
_SILVER: dict[tuple, tuple[str, str]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def bronze(spark: SparkSession, sf_dir: str) -> fixtures.Bronze:
    """The Bronze projection, written once per application and folder and read back:
    planning thousands of day columns is the costly part, not the data."""
    key = _key(spark, sf_dir)
    if key not in _BRONZE:
        b = fixtures.bronze(spark, sf_dir)
        sales = files.write_parquet(b.sales, scratch_path(spark, "bronze-sales"))
        prices = files.write_parquet(b.prices, scratch_path(spark, "bronze-prices"))
        _BRONZE[key] = fixtures.Bronze(spark.read.schema(b.sales.schema).parquet(sales), b.calendar,
                                       spark.read.parquet(prices), b.days)
    return _BRONZE[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once as a table bucketed by id (see ``publish_silver``)
    and read back; per-series jobs then need no shuffle of it."""
    key = _key(spark, sf_dir)
    if key not in _SILVER:
        path = scratch_path(spark, "silver")
        table = "silver_" + path.rsplit("-", 1)[1]
        b = bronze(spark, sf_dir)
        n = silver_plan.silver_buckets(b.sales)
        silver_plan.publish_silver(silver_plan.silver_sales_daily(b.sales, b.calendar, b.prices, partitions=n),
                                   path, table, n)
        _SILVER[key] = (path, table)
    return silver_plan.open_silver(spark, *_SILVER[key])


def cutoff(spark: SparkSession, sf_dir: str) -> str:
    """First day of the last 28."""
    return (bronze(spark, sf_dir).days.last - dt.timedelta(days=27)).isoformat()


def _long(spark, sf_dir) -> DataFrame:
    return reshape.unpivot_sales(bronze(spark, sf_dir).sales)


def _with_calendar(spark, sf_dir) -> DataFrame:
    return joins.join_calendar(_long(spark, sf_dir), bronze(spark, sf_dir).calendar)


def _with_prices(spark, sf_dir) -> DataFrame:
    return joins.join_prices(_with_calendar(spark, sf_dir), bronze(spark, sf_dir).prices)


def _raw_dir(spark, sf_dir, skip: tuple = ()) -> str:
    """The Bronze projection written as the raw headed CSV files."""
    raw = scratch_path(spark, "raw")
    tables = {k: v for k, v in bronze(spark, sf_dir).as_dict().items() if k not in skip}
    bz.write_raw(tables, raw)
    return raw


# What a written table is summed up by: SQL that Spark and the oracle read alike.
CONTENT = {
    "bronze_calendar": "CAST(SUM(wm_yr_wk) AS BIGINT)",
    "bronze_prices": "CAST(SUM(CAST(round(sell_price * 100) AS BIGINT)) AS BIGINT)",
    "silver_sales_daily": "CAST(SUM(units) + SUM(CAST(round(revenue * 100) AS BIGINT)) + SUM(is_active) AS BIGINT)",
    "dim_product": "CAST(SUM(length(item_id) + length(dept_id)) AS BIGINT)",
    "dim_store": "CAST(SUM(length(store_id) + length(state_id)) AS BIGINT)",
    "dim_calendar": "CAST(SUM(wm_yr_wk + is_event) AS BIGINT)",
    "fact_sales": "CAST(SUM(units) + SUM(CAST(round(revenue * 100) AS BIGINT)) AS BIGINT)",
    "weekly_category_sales": "CAST(SUM(total_units) + SUM(CAST(round(total_revenue * 100) AS BIGINT)) + SUM(active_items) AS BIGINT)",
    "abc_classification": "CAST(SUM(total_units) + SUM(CASE WHEN abc_class = 'A' THEN 1 ELSE 0 END) AS BIGINT)",
}


def _contents(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table, n_rows, content of written tables: every value of some columns is summed."""
    parts = []
    for name, path in sorted(paths.items()):
        df = spark.read.parquet(path)
        total = F.expr(CONTENT[name]) if name in CONTENT else F.sum(_day_total(df)).cast("long")
        parts.append(df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n_rows"), total.alias("content")))
    return reduce(DataFrame.unionByName, parts).select("table", "n_rows", "content")


def _day_total(df: DataFrame):
    return F.aggregate(reshape.day_values(reshape.day_columns(df)), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _digest(df: DataFrame, ids: list[str], days: list[str]) -> DataFrame:
    """A frame with a column per day as ids, n_days and all its units in one text."""
    return df.select(*ids, F.lit(len(days)).cast("long").alias("n_days"),
                     F.array_join(reshape.day_values(days, "string"), ",").alias("units"))


def _wide_digest(df: DataFrame) -> DataFrame:
    return _digest(df, ID_COLS, reshape.day_columns(df))


# ------------------------------------------------------------- 2.1 sources ---
@register("read_raw_csv")
def q_read_raw_csv(spark, sf_dir):
    raw = _raw_dir(spark, sf_dir)
    return _wide_digest(files.read_raw_csv(spark, bz.bronze_tables(raw)["bronze_sales"]))


@register("csv_quarantine")
def q_csv_quarantine(spark, sf_dir):
    """The prices as CSV files with planted bad lines: by reason, how many lines, and the weeks of the good ones."""
    cols = ["store_id", "item_id", "wm_yr_wk", "sell_price"]
    price = F.when(F.col("wm_yr_wk") % 50 == 7, F.lit("n/x")).otherwise(F.col("sell_price").cast("string"))
    line = F.concat_ws(",", "store_id", "item_id", F.col("wm_yr_wk").cast("string"),
                       F.when((F.col("wm_yr_wk") % 40 != 3) | (F.col("store_id") != "TX_1"), price))        # else a field is missing
    lines = bronze(spark, sf_dir).prices.select(line.alias("value"))

    def headed(batches):
        yield pd.DataFrame({"value": [",".join(cols)]})
        yield from batches

    path = scratch_path(spark, "dirty")
    lines.mapInPandas(headed, "value string").write.text(path)
    good, rejects = quarantine.read_with_rejects(spark, path, max_rejects=1 << 40)
    return good.agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n_lines"), F.sum("wm_yr_wk").alias("weeks")).unionByName(
        rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"), F.lit(None).cast("long").alias("weeks")))


@register("load_csv_autodetect")
def q_load_csv_autodetect(spark, sf_dir):
    raw = _raw_dir(spark, sf_dir)
    df, _n = files.load_csv_autodetect(spark, bz.bronze_tables(raw)["bronze_sales"],
                                       scratch_path(spark, "autodetect"))
    return _wide_digest(df)


@register("bronze_tables")
def q_bronze_tables(spark, sf_dir):
    res = bz.ingest_bronze(spark, _raw_dir(spark, sf_dir), scratch_path(spark, "bronze"))
    return _contents(spark, res.paths)


@register("missing_source_policy")
def q_missing_source_policy(spark, sf_dir):
    raw = _raw_dir(spark, sf_dir, skip=("bronze_sales",))
    res = bz.ingest_bronze(spark, raw, scratch_path(spark, "bronze"), on_missing="skip")
    rows = [(t, "loaded", n) for t, n in res.rows.items()] + [(t, "skipped", None) for t in res.skipped]
    return spark.createDataFrame(sorted(rows), "table string, status string, n_rows bigint")


@register("subset_filter")
def q_subset_filter(spark, sf_dir):
    raw = _raw_dir(spark, sf_dir)
    frames, _ = bz.read_bronze_sources(spark, raw, cat="FOODS", store="CA_1")
    return _wide_digest(frames["bronze_sales"])


@register("nonempty_guard")
def q_nonempty_guard(spark, sf_dir):
    # the reference's own subset (FOODS x CA_1), guarded before any write
    res = bz.ingest_bronze(spark, _raw_dir(spark, sf_dir), scratch_path(spark, "bronze"),
                           cat="FOODS", store="CA_1")
    return _contents(spark, res.paths)


@register("write_parquet")
def q_write_parquet(spark, sf_dir):
    path = files.write_parquet(silver(spark, sf_dir), scratch_path(spark, "silver-out"),
                               partition_by=["store_id"], sort_within=["id", "date"])
    return files.read_parquet(spark, path)


@register("read_parquet")
def q_read_parquet(spark, sf_dir):
    path = files.write_parquet(bronze(spark, sf_dir).prices, scratch_path(spark, "prices"))
    return files.read_parquet(spark, path)


@register("read_parquet_pruned")
def q_read_parquet_pruned(spark, sf_dir):
    silver(spark, sf_dir)  # make sure it is written
    path, _table = _SILVER[_key(spark, sf_dir)]
    return files.read_parquet(spark, path, ["id", "date", "units"])


@register("publish_table")
def q_publish_table(spark, sf_dir):
    name = "fact_sales_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    return files.publish_table(gold.fact_sales_sql(silver(spark, sf_dir)), name,
                               scratch_path(spark, "fact-table"))


@register("table_versions")
def q_table_versions(spark, sf_dir):
    """Facts by store of three versions: every sale, then one that dies while it is written, then the
    sold days only.  The first is read through a frame that was opened before the others."""
    root = scratch_path(spark, "versions")
    fact = gold.fact_sales(silver(spark, sf_dir))
    versions.publish_version(fact, root)
    first = versions.open_version(spark, root)
    broken = fact.withColumn("units", F.when(F.dayofmonth("date") < 28, F.col("units")).otherwise(F.raise_error(F.lit("lost")).cast("int")))
    try:
        versions.publish_version(broken, root)
        raise AssertionError("a broken write was published")
    except PySparkException:
        unharmed = versions.open_version(spark, root)
    versions.publish_version(fact.where("units > 0"), root)
    opened = [("first", first), ("after the broken write", unharmed), ("second", versions.open_version(spark, root))]
    return reduce(DataFrame.unionByName, [df.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units").alias("units")).withColumn("read", F.lit(k)) for k, df in opened])


@register("upsert_years")
def q_upsert_years(spark, sf_dir):
    """Silver by year after corrected days came in: what the table holds, and how many files stayed."""
    s = silver(spark, sf_dir).select("id", "date", "units", "year")
    path = files.write_parquet(s, scratch_path(spark, "by-year"), partition_by=["year"])
    names = lambda: spark.read.parquet(path).select("year", F.input_file_name().alias("file")).distinct()
    before = files.read_parquet(spark, files.write_parquet(names(), scratch_path(spark, "names")))
    fixed = s.where("year = 1998 AND units > 0 OR year = 2000 AND month(date) = 2").withColumn("units", F.col("units") + 100)
    versions.upsert(spark, path, fixed, ["id", "date"], "year")
    stayed = names().join(before, ["year", "file"], "left_semi").groupBy("year").agg(F.lit(True).alias("files_stayed"))
    held = spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("units").alias("units"))
    return held.join(stayed, "year", "left").select("year", "n_rows", "units", F.coalesce("files_stayed", F.lit(False)).alias("files_stayed"))


@register("publish_view")
def q_publish_view(spark, sf_dir):
    return files.publish_view(gold.weekly_category_sales_sql(silver(spark, sf_dir)), "weekly_category_sales_v")


# ------------------------------------------------------------- 2.2 reshape ---
@register("unpivot_sales")
def q_unpivot_sales(spark, sf_dir):
    return _long(spark, sf_dir)


@register("unpivot_sales_sql")
def q_unpivot_sales_sql(spark, sf_dir):
    return reshape.unpivot_sales_sql(bronze(spark, sf_dir).sales)


@register("series_matrix")
def q_series_matrix(spark, sf_dir):
    days = bronze(spark, sf_dir).days
    dates = [days.start + dt.timedelta(days=i) for i in range(days.n_days)]
    wide = reshape.series_matrix(silver(spark, sf_dir).select("id", "date", "units"), dates)
    return _digest(wide, ["id"], [d.isoformat() for d in dates])


# --------------------------------------------------------------- 2.3 joins ---
@register("join_calendar")
def q_join_calendar(spark, sf_dir):
    return _with_calendar(spark, sf_dir)


@register("calendar_match_guard")
def q_calendar_match_guard(spark, sf_dir):
    return joins.calendar_match_guard(_long(spark, sf_dir), bronze(spark, sf_dir).calendar)


@register("join_prices")
def q_join_prices(spark, sf_dir):
    return _with_prices(spark, sf_dir)


@register("weights_reindex")
def q_weights_reindex(spark, sf_dir):
    s = silver(spark, sf_dir)
    sold = s.where(F.col("revenue") > 0).groupBy("id").agg(money(cents_sum("revenue")).alias("revenue"))
    return joins.weights_reindex(s.select("id").distinct(), sold)


# ------------------------------------------------ 2.4 projections, features ---
@register("snap_flag")
def q_snap_flag(spark, sf_dir):
    return feat.snap_flag(_with_calendar(spark, sf_dir)).select("id", "date", "state_id", "snap_flag")


@register("snap_flag_sql")
def q_snap_flag_sql(spark, sf_dir):
    return feat.snap_flag_sql(_with_calendar(spark, sf_dir)).select("id", "date", "state_id", "snap_flag")


@register("is_weekend")
def q_is_weekend(spark, sf_dir):
    return feat.is_weekend(_with_calendar(spark, sf_dir)).select("id", "date", "wday", "is_weekend")


@register("is_active")
def q_is_active(spark, sf_dir):
    return feat.is_active(_with_prices(spark, sf_dir)).select("id", "date", "sell_price", "is_active")


@register("revenue")
def q_revenue(spark, sf_dir):
    return feat.revenue(_with_prices(spark, sf_dir)).select("id", "date", "units", "sell_price", "revenue")


@register("clean_types")
def q_clean_types(spark, sf_dir):
    return feat.clean_types(feat.add_features(_with_prices(spark, sf_dir)))


@register("silver_sales_daily")
def q_silver(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return silver_plan.silver_sales_daily(b.sales, b.calendar, b.prices)


@register("silver_sales_daily_sql")
def q_silver_sql(spark, sf_dir):
    b = bronze(spark, sf_dir)
    return silver_plan.silver_sales_daily_sql(b.sales, b.calendar, b.prices)


@register("silver_profile")
def q_silver_profile(spark, sf_dir):
    return silver_plan.silver_profile(silver(spark, sf_dir))


@register("fact_sales")
def q_fact_sales(spark, sf_dir):
    return gold.fact_sales(silver(spark, sf_dir))


@register("fact_sales_sql")
def q_fact_sales_sql(spark, sf_dir):
    return gold.fact_sales_sql(silver(spark, sf_dir))


# ------------------------------------------------------- 2.5 aggregation ---
@register("dim_product")
def q_dim_product(spark, sf_dir):
    return gold.dim_product(silver(spark, sf_dir))


@register("dim_product_sql")
def q_dim_product_sql(spark, sf_dir):
    return gold.dim_product_sql(silver(spark, sf_dir))


@register("dim_store")
def q_dim_store(spark, sf_dir):
    return gold.dim_store(silver(spark, sf_dir))


@register("dim_calendar")
def q_dim_calendar(spark, sf_dir):
    return gold.dim_calendar(silver(spark, sf_dir))


@register("weekly_category_sales")
def q_weekly(spark, sf_dir):
    return gold.weekly_category_sales(silver(spark, sf_dir))


@register("weekly_category_sales_sql")
def q_weekly_sql(spark, sf_dir):
    return gold.weekly_category_sales_sql(silver(spark, sf_dir))


def _abc(spark, sf_dir) -> DataFrame:
    """Classes of the parts by their revenue over all of lineitem."""
    return gold.abc_from_revenue(fixtures.part_revenue(spark, sf_dir), unit=10_000)


@register("abc_summary")
def q_abc_summary(spark, sf_dir):
    return gold.abc_summary(_abc(spark, sf_dir), unit=10_000)


@register("revenue_weights")
def q_revenue_weights(spark, sf_dir):
    return fc.revenue_weights(silver(spark, sf_dir))


# ------------------------------------------------ 2.6 windows, ranking ---
@register("abc_classification")
def q_abc(spark, sf_dir):
    return _abc(spark, sf_dir)


@register("abc_percent_rank")
def q_abc_pr(spark, sf_dir):
    return gold.percent_rank_from_revenue(fixtures.part_revenue(spark, sf_dir), unit=10_000)


def _series(spark, sf_dir) -> DataFrame:
    return silver(spark, sf_dir).select("id", "date", "units")


@register("lag_features")
def q_lag(spark, sf_dir):
    return se.lag_features(_series(spark, sf_dir))


@register("rolling_mean_features")
def q_rolling(spark, sf_dir):
    return se.rolling_mean_features(_series(spark, sf_dir))


@register("diff_sq")
def q_diff_sq(spark, sf_dir):
    return se.diff_sq(_series(spark, sf_dir))


@register("series_first_sale")
def q_first_sale(spark, sf_dir):
    return se.series_first_sale(_series(spark, sf_dir))


@register("last_n_days")
def q_last_n_days(spark, sf_dir):
    return se.last_n_days(_series(spark, sf_dir), 90)


@register("tail_mean")
def q_tail_mean(spark, sf_dir):
    return se.tail_mean(_series(spark, sf_dir), 28)


@register("order_outputs")
def q_order_outputs(spark, sf_dir):
    return gold.order_outputs(gold.weekly_category_sales(silver(spark, sf_dir)), "weekly_category_sales")


def _evaluated(spark, sf_dir) -> DataFrame:
    s = silver(spark, sf_dir)
    axis = se.date_axis(s)
    frame = fc.baseline_frame(s, axis=axis)
    return mt.evaluate_models(fc.baseline_forecasts(frame), fc.revenue_weights(s, axis=axis))


@register("best_model")
def q_best(spark, sf_dir):
    return mt.best_model(mt.comparison_table(_evaluated(spark, sf_dir)))


# ------------------------------------------- 2.7 splits, baselines, metrics ---
@register("temporal_split")
def q_temporal_split(spark, sf_dir):
    return se.label_split(_series(spark, sf_dir), 28).drop("day_index")


@register("cutoff_split")
def q_cutoff_split(spark, sf_dir):
    train, test = se.cutoff_split(_series(spark, sf_dir), "date", cutoff(spark, sf_dir))
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def _forecasts(spark, sf_dir) -> DataFrame:
    return fc.baseline_forecasts(fc.baseline_frame(silver(spark, sf_dir)))


def _model_forecast(models):
    def run(spark, sf_dir):
        return _forecasts(spark, sf_dir).where(F.col("model").isin(*models)).select(
            "model", "id", "step", "date", "yhat")
    return run


register("forecast_zero")(_model_forecast(["zero"]))
register("forecast_naive")(_model_forecast(["naive"]))
register("forecast_seasonal_naive")(_model_forecast(["seasonal_naive_7"]))
register("forecast_moving_average")(_model_forecast(["moving_average_7", "moving_average_28"]))


_MODEL: dict[tuple, object] = {}
QUERY_ROUNDS = 20            # of the two queries below; the model's own default is 200, a tree takes some ten passes


def _demand_model(spark, sf_dir):
    """The model fitted on all training rows, once per application and folder; (model, its test rows)."""
    key = _key(spark, sf_dir)
    train, test = se.cutoff_split(fc.demand_features(silver(spark, sf_dir)), "date", cutoff(spark, sf_dir))
    if key not in _MODEL:
        _MODEL[key] = fc.train_demand_model(train, max_iter=QUERY_ROUNDS)
    return _MODEL[key], test


@register("train_demand_model")
def q_train_demand_model(spark, sf_dir):
    """Facts of the trained model that any engine can check: how many rows it was fitted on (all
    before the cut-off), its test rows and how many got a prediction, that no tree has more than
    31 leaves, and whether its mean squared error (the loss it is fitted to) is below that of
    predicting zero.  Absolute error would not do: on sparse series zero is its best constant."""
    model, test = _demand_model(spark, sf_dir)
    out = fc.predict_demand(model, test)
    return out.agg(
        F.lit(model.rows).cast("long").alias("n_train"), F.lit(max(t.leaves() for t in model.trees) <= 31).alias("leaves_kept"),
        F.count(F.lit(1)).alias("n_test"), F.count("predicted_units").alias("n_predicted"),
        (F.avg((F.col("units") - F.col("predicted_units")) ** 2) < F.avg(F.col("units") ** 2)).alias("beats_zero"))


@register("forecast_recursive")
def q_forecast_recursive(spark, sf_dir):
    """The trained model 90 steps ahead of the last date, as facts per store: its rows and series, the
    steps' sum, and how many rows have no prediction or one that can't be."""
    s = silver(spark, sf_dir)
    out = fc.forecasts_table(s, ("gbt",), trained=_demand_model(spark, sf_dir)[0])
    low, high = s.agg(F.min("units"), F.max("units")).first()
    wrong = ~F.coalesce(F.col("predicted_units").between(float(low) - 0.5 * (high - low), float(high)), F.lit(False))
    return out.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("item_id").alias("n_items"), F.sum("step").alias("sum_steps"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_if(wrong).alias("n_wrong"))


def _metric(col: str):
    def run(spark, sf_dir):
        return _evaluated(spark, sf_dir).select("model", col)
    return run


for _name, _col in [("metric_mae", "MAE"), ("metric_rmse", "RMSE"), ("metric_mape", "MAPE"),
                    ("metric_smape", "sMAPE"), ("metric_rmsse", "RMSSE"), ("metric_wrmsse", "WRMSSE")]:
    register(_name)(_metric(_col))


@register("evaluate_model")
def q_evaluate(spark, sf_dir):
    return _evaluated(spark, sf_dir)


@register("comparison_table")
def q_comparison(spark, sf_dir):
    return mt.comparison_table(_evaluated(spark, sf_dir))


# ------------------------------------------------------- 2.8 diagnostics ---
def _stats(spark, sf_dir) -> DataFrame:
    return dg.series_stats(silver(spark, sf_dir))


@register("intermittency_profile")
def q_intermittency(spark, sf_dir):
    return dg.intermittency_profile(silver(spark, sf_dir))


@register("series_lifecycle")
def q_lifecycle(spark, sf_dir):
    return dg.series_lifecycle(_stats(spark, sf_dir))


@register("launch_delay")
def q_launch_delay(spark, sf_dir):
    return dg.launch_delay(_stats(spark, sf_dir))


@register("pre_launch_zeros")
def q_pre_launch(spark, sf_dir):
    return dg.pre_launch_zeros(_stats(spark, sf_dir))


@register("demand_stats")
def q_demand_stats(spark, sf_dir):
    return dg.demand_stats(_stats(spark, sf_dir))


@register("classify_syntetos_boylan")
def q_classify(spark, sf_dir):
    return dg.demand_stats(_stats(spark, sf_dir)).select("id", "adi", "cv2", "demand_class")


@register("demand_class_summary")
def q_class_summary(spark, sf_dir):
    return dg.demand_class_summary(dg.demand_stats(_stats(spark, sf_dir)))


@register("weekday_seasonality")
def q_weekday(spark, sf_dir):
    return dg.weekday_seasonality(silver(spark, sf_dir))


@register("weekday_spread")
def q_spread(spark, sf_dir):
    return dg.weekday_spread(silver(spark, sf_dir))


@register("snap_lift")
def q_snap_lift(spark, sf_dir):
    return dg.snap_lift(silver(spark, sf_dir))


@register("modelling_hints")
def q_hints(spark, sf_dir):
    s = silver(spark, sf_dir)
    stats = dg.series_stats(s)
    return dg.modelling_hints(s, stats, dg.demand_stats(stats))


# ------------------------------------------------------- 2.9 data quality ---
def planted(silver: DataFrame) -> DataFrame:
    """Silver with defects of every kind that the checks look for, on fixed days of each month."""
    dom, store = F.dayofmonth("date"), F.col("store_id")
    bad = {
        "units": F.when((dom == 1) & (store == "TX_1"), F.lit(-1)).otherwise(F.col("units")),
        "sell_price": F.when(dom == 2, -F.col("sell_price")).otherwise(F.col("sell_price")),
        "is_active": F.when(dom == 3, F.lit(2)).otherwise(F.col("is_active")).cast("tinyint"),
        "item_id": F.when(~((dom == 4) & (store == "WI_1")), F.col("item_id")),
    }
    s = silver.withColumns(bad).where(~((dom == 6) & (store == "NY_1")))
    return s.unionByName(s.where((dom == 5) & (store == "CA_2")))


def _both(clean: DataFrame, defects: DataFrame) -> DataFrame:
    """A check's rows on the clean frame and on the one with planted defects."""
    return clean.withColumn("frame", F.lit("clean")).unionByName(defects.withColumn("frame", F.lit("planted")))


def _dq_silver(fn):
    def run(spark, sf_dir):
        s = silver(spark, sf_dir)
        return _both(fn(s), fn(planted(s)))
    return run


for _name, _fn in [("dq_no_fanout", dq.dq_no_fanout), ("dq_unique_grain", dq.dq_unique_grain),
                   ("dq_keys_not_null", dq.dq_keys_not_null), ("dq_units_non_negative", dq.dq_units_non_negative),
                   ("dq_price_positive", dq.dq_price_positive), ("dq_revenue_consistent", dq.dq_revenue_consistent),
                   ("dq_complete_series", dq.dq_complete_series), ("dq_binary_flags", dq.dq_binary_flags)]:
    register(_name)(_dq_silver(_fn))


@register("dq_schema_contract")
def q_dq_contract(spark, sf_dir):
    s = silver(spark, sf_dir)
    return _both(dq.dq_schema_contract(s), dq.dq_schema_contract(planted(s).withColumn("units", F.col("units").cast("long"))))


@register("dq_row_count_positive")
def q_dq_rows(spark, sf_dir):
    s = silver(spark, sf_dir)
    return _both(dq.dq_row_count_positive(s), dq.dq_row_count_positive(s.where("units < 0")))


@register("dq_fact_matches_silver")
def q_dq_fact(spark, sf_dir):
    s = silver(spark, sf_dir)
    return _both(dq.dq_fact_matches_silver(gold.fact_sales(s), s), dq.dq_fact_matches_silver(gold.fact_sales(planted(s)), s))


@register("dq_dim_product_unique")
def q_dq_dim(spark, sf_dir):
    s = silver(spark, sf_dir)
    return _both(dq.dq_dim_product_unique(gold.dim_product(s)), dq.dq_dim_product_unique(gold.dim_product(planted(s))))


@register("dq_weekly_reconciles")
def q_dq_weekly(spark, sf_dir):
    s = silver(spark, sf_dir)
    return _both(dq.dq_weekly_reconciles(gold.weekly_category_sales(s), s),
                 dq.dq_weekly_reconciles(gold.weekly_category_sales(planted(s)), s))


@register("dq_abc_covers_products")
def q_dq_abc_cover(spark, sf_dir):
    s = silver(spark, sf_dir)
    abc, dim = gold.abc_classification(s), gold.dim_product(s)
    lost = abc.where("item_id <> 'Brand#11'").withColumn("abc_class", F.when(F.col("abc_class") == "A", "D").otherwise(F.col("abc_class")))
    return _both(dq.dq_abc_covers_products(abc, dim), dq.dq_abc_covers_products(lost, dim))


@register("dq_abc_shares_sum_one")
def q_dq_abc_sum(spark, sf_dir):
    abc = _abc(spark, sf_dir)
    return _both(dq.dq_abc_shares_sum_one(abc), dq.dq_abc_shares_sum_one(abc.withColumn("revenue_share", F.col("revenue_share") / 2)))


@register("dq_abc_sorted")
def q_dq_abc_sorted(spark, sf_dir):
    abc = _abc(spark, sf_dir)
    return _both(dq.dq_abc_sorted(abc), dq.dq_abc_sorted(abc.withColumn("cumulative_share", -F.col("cumulative_share"))))


@register("dq_report")
def q_dq_report(spark, sf_dir):
    s = silver(spark, sf_dir)
    abc = gold.abc_classification(s)
    return dq.dq_report(s, gold.fact_sales(s), gold.dim_product(s), gold.weekly_category_sales(s), abc)


# ------------------------------------------------------ 2.10 serving, jobs ---
_FORECASTS: dict[tuple, str] = {}


def _stored_forecasts(spark, sf_dir) -> DataFrame:
    """The forecasts table of all baselines, written once and read back."""
    key = _key(spark, sf_dir)
    if key not in _FORECASTS:
        path = scratch_path(spark, "forecasts")
        fc.write_forecasts(silver(spark, sf_dir), path)
        _FORECASTS[key] = path
    return spark.read.parquet(_FORECASTS[key])


@register("forecasts_table")
def q_forecasts_table(spark, sf_dir):
    return _stored_forecasts(spark, sf_dir)


@register("forecast_lookup")
def q_forecast_lookup(spark, sf_dir):
    return fc.forecast_lookup(_stored_forecasts(spark, sf_dir), item_id=None, store_id=None, horizon=28,
                              model="moving_average_28")


@register("store_kpis")
def q_store_kpis(spark, sf_dir):
    s = silver(spark, sf_dir)
    return kpis.store_kpis(gold.fact_sales(s), gold.abc_classification(s))


_STATES: dict[tuple, tuple] = {}


def _states(spark, sf_dir):
    """The state after three batches of days were added one after the other, and the item codes."""
    key = _key(spark, sf_dir)
    if key not in _STATES:
        s, root = silver(spark, sf_dir), scratch_path(spark, "states")
        for batch in (F.col("year") <= 1996, F.col("year").between(1997, 1999), F.col("year") >= 2000):
            held = states.append_days(spark, root, s.where(batch))
        _STATES[key] = (held, versions.open_version(spark, f"{root}/codes"))
    return _STATES[key]


@register("weekly_from_states")
def q_weekly_from_states(spark, sf_dir):
    return states.weekly_category_sales(_states(spark, sf_dir)[0])


@register("abc_from_states")
def q_abc_from_states(spark, sf_dir):
    return states.abc_classification(_states(spark, sf_dir)[0])


@register("store_kpis_from_states")
def q_store_kpis_from_states(spark, sf_dir):
    return states.store_kpis(*_states(spark, sf_dir))


@register("distinct_items_from_states")
def q_distinct_items_from_states(spark, sf_dir):
    """Items sold per category and store over all weeks: a union of bitmaps, no count over the days."""
    return states.distinct_items(_states(spark, sf_dir)[0], ["cat_id", "store_id"])


@register("run_pipeline")
def q_run_pipeline(spark, sf_dir):
    res = run_pipeline(spark, _raw_dir(spark, sf_dir), scratch_path(spark, "work"))
    return _contents(spark, res.paths)


@register("gold_tables")
def q_gold_tables(spark, sf_dir):
    out = scratch_path(spark, "gold")
    names = write_gold(spark, silver(spark, sf_dir), out)
    return _contents(spark, {n: f"{out}/{n}.parquet" for n in names})
