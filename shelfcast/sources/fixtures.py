"""Bronze inputs projected from the driver's TPC-H-style tables.

The reference ingests three raw tables (wide daily sales, calendar, weekly
prices).  We derive the same three shapes from ``part``, ``supplier``,
``nation`` and ``lineitem`` so that every job reads the given tables and its
work grows with them:

* one product per brand (or per brand and type), category and department by the
  brand's number;
* one store per region of the supplying nation (five stores);
* units = quantity shipped per product, store and day, over all of ``lineitem``:
  the calendar runs from its first to its last ship date; every product is listed
  in every store (dense series grid);
* weekly price = the highest retail price of the product's parts sold in that
  store and week.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.joins import bounded_broadcast
from shelfcast.schemas import ID_COLS

# Fixed values of the projection (they define the test data, keep them as is).
FIRST_WEEK = 11101                 # wm_yr_wk of the first week; weeks start on Saturday
CATEGORIES = ["FOODS", "HOBBIES", "HOUSEHOLD"]          # by brand number mod 3
STORES = ["CA_1", "CA_2", "TX_1", "WI_1", "NY_1"]       # by region key 0..4
STATES = ["CA", "CA", "TX", "WI", "NY"]                 # NY has no SNAP column
EVENT_DAY = 25                     # day of month carrying the monthly event
EVENT_NAME = "MonthlyEvent"
EVENT_TYPE = "Cultural"
BRAND = ("p_brand",)               # columns of ``part`` that name a product
BRAND_TYPE = ("p_brand", "p_type")


@dataclass(frozen=True)
class Span:
    """The calendar: first day and number of days."""
    start: dt.date
    n_days: int

    @property
    def last(self) -> dt.date:
        return self.start + dt.timedelta(days=self.n_days - 1)

    @property
    def day_names(self) -> list[str]:
        return [f"d_{i + 1}" for i in range(self.n_days)]

    def week(self, date: Column) -> Column:
        """wm_yr_wk of a date."""
        saturday = self.start - dt.timedelta(days=(self.start.isoweekday() + 1) % 7)
        return (F.lit(FIRST_WEEK) + F.floor(F.datediff(date, F.lit(saturday)) / 7)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def span(spark: SparkSession, sf_dir: str) -> Span:
    """First to last ship date of the whole table (one aggregate, two scalars)."""
    day = F.col("l_shipdate").cast("date")
    row = table(spark, sf_dir, "lineitem").agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    if row["a"] is None:
        raise ValueError("lineitem has no ship date")
    return Span(row["a"], (row["b"] - row["a"]).days + 1)


def calendar(spark: SparkSession, days: Span) -> DataFrame:
    """Calendar keyed by day name ``d``; one row per day of the span."""
    i = F.col("id").cast("int")
    date = F.date_add(F.lit(days.start), i)
    dom = F.dayofmonth(date)
    return spark.range(days.n_days).select(
        date.alias("date"),
        F.concat(F.lit("d_"), (i + 1).cast("string")).alias("d"),
        days.week(date).alias("wm_yr_wk"),
        (F.dayofweek(date) % 7 + 1).cast("int").alias("wday"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        F.when(dom == EVENT_DAY, F.lit(EVENT_NAME)).alias("event_name_1"),
        F.when(dom == EVENT_DAY, F.lit(EVENT_TYPE)).alias("event_type_1"),
        (dom <= 10).cast("int").alias("snap_CA"),
        dom.between(5, 15).cast("int").alias("snap_TX"),
        (dom % 3 == 0).cast("int").alias("snap_WI"),
    )


def products(spark: SparkSession, sf_dir: str, grain: Sequence[str] = BRAND) -> DataFrame:
    """p_partkey, item_id, dept_id, cat_id and the retail price of each part."""
    brand_no = F.regexp_extract("p_brand", r"#(\d+)", 1).cast("int")
    cat = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]), brand_no % 3 + 1)
    dept = F.concat(cat, F.lit("_"), (brand_no % 2 + 1).cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat_ws("_", *grain).alias("item_id"),
        dept.alias("dept_id"),
        cat.alias("cat_id"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def _store_of_region(region: str):
    stores = F.array(*[F.lit(s) for s in STORES])
    states = F.array(*[F.lit(s) for s in STATES])
    return (F.element_at(stores, F.col(region) + 1).alias("store_id"),
            F.element_at(states, F.col(region) + 1).alias("state_id"))


def daily_sales(spark: SparkSession, sf_dir: str, grain: Sequence[str] = BRAND) -> DataFrame:
    """Sparse (item_id, region, date, qty, price) over all of ``lineitem``; price is
    the highest retail price sold.

    ``nation`` (25 rows by definition of the schema) is broadcast after its size is
    checked; ``supplier``, ``part`` and ``lineitem`` grow with the data and get no
    hint (AQE may broadcast from measured sizes or split a hot key).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("date"), "l_quantity")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(
        bounded_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), 10_000),
        F.col("s_nationkey") == F.col("n_nationkey"),
    ).select("s_suppkey", F.col("n_regionkey").alias("region"))
    part = products(spark, sf_dir, grain).select("p_partkey", "item_id", "price")
    return (
        li.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("item_id", "region", "date")
        .agg(F.sum("l_quantity").alias("qty"), F.max("price").alias("price"))
    )


def series_grid(spark: SparkSession, sf_dir: str, grain: Sequence[str] = BRAND) -> DataFrame:
    """Every product in every store: one row per series with the six id columns."""
    regions = F.array(*[F.lit(r) for r in range(len(STORES))])
    store_id, state_id = _store_of_region("region")
    return (
        products(spark, sf_dir, grain).select("item_id", "dept_id", "cat_id").distinct()
        .select("item_id", "dept_id", "cat_id", F.explode(regions).alias("region"))
        .select("region", F.concat("item_id", F.lit("_"), store_id).alias("id"),
                "item_id", "dept_id", "cat_id", store_id, state_id)
    )


def sales_wide(spark: SparkSession, sf_dir: str, days: Span, daily: DataFrame, grain: Sequence[str] = BRAND) -> DataFrame:
    """Raw wide sales: id columns + ``d_1 .. d_N`` integer units (0 when none).

    One aggregate gathers the days of a series (at most one entry per day); the day
    columns are read from one dense array, which is far cheaper to plan than a pivot
    with thousands of values."""
    day_no = F.datediff("date", F.lit(days.start)) + 1
    sparse = daily.groupBy("item_id", "region").agg(
        F.map_from_entries(F.collect_list(F.struct(day_no.alias("k"), F.col("qty").cast("int").alias("v")))).alias("m"))
    dense = F.expr(f"transform(sequence(1, {days.n_days}), i -> coalesce(try_element_at(m, i), 0))")
    wide = series_grid(spark, sf_dir, grain).join(sparse, ["item_id", "region"], "left").select(
        *ID_COLS, F.coalesce(dense, F.array_repeat(F.lit(0), days.n_days)).alias("u"))
    return wide.selectExpr(*ID_COLS, *[f"get(u, {i}) AS {d}" for i, d in enumerate(days.day_names)])


def prices(daily: DataFrame, days: Span) -> DataFrame:
    """Weekly price per (store, item): present only for weeks with a sale there."""
    store_id, _ = _store_of_region("region")
    return daily.groupBy(store_id, "item_id", days.week(F.col("date")).alias("wm_yr_wk")).agg(
        F.max("price").cast("double").alias("sell_price"))


def part_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per part over all of ``lineitem``: item_id, rev (in 1/10000, exact), total_units."""
    amount = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("item_id")).agg(
        (F.sum(amount) * 10_000).cast("long").alias("rev"), F.sum("l_quantity").cast("long").alias("total_units"))


@dataclass
class Bronze:
    sales: DataFrame
    calendar: DataFrame
    prices: DataFrame
    days: Span

    def as_dict(self) -> dict[str, DataFrame]:
        return {"bronze_sales": self.sales, "bronze_calendar": self.calendar,
                "bronze_prices": self.prices}


def bronze(spark: SparkSession, sf_dir: str, grain: Sequence[str] = BRAND) -> Bronze:
    days = span(spark, sf_dir)
    daily = daily_sales(spark, sf_dir, grain)
    return Bronze(sales_wide(spark, sf_dir, days, daily, grain), calendar(spark, days), prices(daily, days), days)
