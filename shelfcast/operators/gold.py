"""Gold: star schema and the weekly business view."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import sunday_week_start
from shelfcast.functions.numeric import cents_sum, money, round_half_up
from shelfcast.schemas import FACT_COLS


def dim_product(silver: DataFrame) -> DataFrame:
    """Distinct (item_id, dept_id, cat_id); unique on item only if the
    hierarchy holds (``dq_dim_product_unique``)."""
    return silver.select("item_id", "dept_id", "cat_id").distinct()


def dim_product_sql(silver: DataFrame) -> DataFrame:
    return silver.select("item_id", "cat_id").distinct()


def dim_store(silver: DataFrame) -> DataFrame:
    return silver.select("store_id", "state_id").distinct()


# The calendar dimension's columns in order.
DIM_CALENDAR_COLS = ["date", "d", "wm_yr_wk", "wday", "month", "year",
                     "event_name_1", "event_type_1", "is_weekend"]


def dim_calendar(silver: DataFrame) -> DataFrame:
    """First row per date (smallest id, i.e. keep-first over Silver sorted by
    (id, date)) plus ``is_event``.  One group per day: bounded, and the
    aggregate is combined map-side."""
    attrs = [c for c in DIM_CALENDAR_COLS if c != "date"]
    first = F.min_by(F.struct(*attrs), F.col("id")).alias("r")
    return silver.groupBy("date").agg(first).select(
        "date", *[F.col(f"r.{c}").alias(c) for c in attrs],
        F.col("r.event_name_1").isNotNull().cast("tinyint").alias("is_event"),
    )


def fact_sales(silver: DataFrame) -> DataFrame:
    """Eight columns of Silver at product x store x day grain (no id)."""
    return silver.select(*FACT_COLS)


def fact_sales_sql(silver: DataFrame) -> DataFrame:
    """SQL variant: keeps id, recomputes revenue, drops the flags."""
    return silver.select(
        "id", "item_id", "store_id", "date", "units", "sell_price",
        (F.col("units") * F.coalesce(F.col("sell_price"), F.lit(0.0))).alias("revenue"),
    )


def weekly_category_sales(silver: DataFrame) -> DataFrame:
    """By (cat_id, store_id, wm_yr_wk): units, revenue, mean units per
    product-day row and distinct items.  Null group keys are dropped, as the
    reference's groupby does.

    Two plain aggregations instead of ``countDistinct`` (which would add an
    Expand doubling the rows): the first collapses the days of one series in a
    week - with ``id`` among its keys it needs no exchange on the buckets - the second
    counts the items (``id`` is item and store, which ``dq_weekly_reconciles`` checks).
    """
    keys = ["cat_id", "store_id", "wm_yr_wk"]
    per_item = (
        silver.where(F.col("cat_id").isNotNull() & F.col("store_id").isNotNull()
                     & F.col("wm_yr_wk").isNotNull())
        .groupBy("id", *keys)
        .agg(
            F.sum("units").alias("u"),
            cents_sum("revenue").alias("r"),
            F.count("units").alias("n"),
            F.max("item_id").alias("item_id"),
        )
    )
    return per_item.groupBy(*keys).agg(
        F.sum("u").alias("total_units"),
        money(F.sum("r")).alias("total_revenue"),
        round_half_up(F.sum("u") / F.sum("n"), 6).alias("avg_daily_units"),
        F.count("item_id").alias("active_items"),
    )


def weekly_category_sales_sql(silver: DataFrame) -> DataFrame:
    """SQL variant: Sunday-start week date, revenue recomputed, no active_items."""
    rev = F.col("units") * F.coalesce(F.col("sell_price"), F.lit(0.0))
    return (
        silver.groupBy("cat_id", "store_id", sunday_week_start("date").alias("week"))
        .agg(
            F.sum("units").alias("total_units"),
            money(cents_sum(rev)).alias("total_revenue"),
            round_half_up(F.avg("units"), 6).alias("avg_daily_units"),
        )
    )


# ------------------------------------------------------------------- ABC ---

def item_revenue(silver: DataFrame) -> DataFrame:
    """Revenue (exact cents) and units per item."""
    return silver.groupBy("item_id").agg(
        cents_sum("revenue").alias("rev"),
        F.sum("units").alias("total_units"),
    )


def abc_classification(silver: DataFrame, parts: int | None = None) -> DataFrame:
    """Pareto classes of Silver's items (see ``abc_from_revenue``)."""
    return abc_from_revenue(item_revenue(silver), parts=parts)


def abc_from_revenue(rev: DataFrame, unit: int = 100, parts: int | None = None) -> DataFrame:
    """Pareto classes on cumulative revenue share.

    ``rev``: item_id, rev (exact, in 1/``unit``), total_units.  Items sorted by
    revenue descending (ties by item_id), running share over ROWS; A while the
    running revenue is <= 80 % of the total, B <= 95 %, else C (compared in
    integers, so 0.80 and 0.95 are inclusive and exact).  The item that crosses
    80 % is already B; a lone item is C; a zero total makes every item C.
    """
    from shelfcast.operators.prefix import running_sums

    runs = running_sums(rev, [("rev", False), ("item_id", True)], {"cum": "rev"}, parts=parts, with_total=True)
    value = lambda c: F.col(c) / F.lit(float(unit))
    total = F.col("cum_total")
    positive = total > 0
    klass = (F.when(positive & (F.col("cum") * 100 <= total * 80), "A")
             .when(positive & (F.col("cum") * 100 <= total * 95), "B")
             .otherwise("C"))
    return runs.select(
        "item_id",
        value("rev").alias("total_revenue"),
        "total_units",
        F.try_divide(value("rev"), value("cum_total")).alias("revenue_share"),
        F.try_divide(value("cum"), value("cum_total")).alias("cumulative_share"),
        klass.alias("abc_class"),
    )


def abc_percent_rank(silver: DataFrame, parts: int | None = None) -> DataFrame:
    """SQL variant over Silver's items (see ``percent_rank_from_revenue``)."""
    rev = silver.groupBy("item_id").agg(
        cents_sum(F.col("units") * F.coalesce(F.col("sell_price"), F.lit(0.0))).alias("rev"))
    return percent_rank_from_revenue(rev, parts=parts)


def percent_rank_from_revenue(rev: DataFrame, unit: int = 100, parts: int | None = None) -> DataFrame:
    """PERCENT_RANK over revenue descending; A <= 0.2, B <= 0.5.

    Equal revenues share a rank: rank = 1 + number of items with more revenue.
    Items are first collapsed to distinct revenues (a hot value costs one row) and
    ranked by a prefix count.  The class falls with the revenue, so the least revenue
    of A and of B (two scalars) decide every item, without a join.  A single item has
    rank 0 -> A.
    """
    from shelfcast.operators.prefix import running_sums

    values = rev.groupBy("rev").agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_sums(values, [("rev", False)], {"_run": "_c"}, parts=parts, with_total=True)
    above, den = F.col("_run") - F.col("_c"), F.col("_run_total") - 1
    # percent_rank = above / den; compare in integers: above <= 0.2 * den
    least = ranked.agg(F.min(F.when((den == 0) | (above * 5 <= den), F.col("rev"))).alias("a"),
                       F.min(F.when((den == 0) | (above * 2 <= den), F.col("rev"))).alias("b")).first()
    klass = F.when(F.col("rev") >= F.lit(least["a"]), "A").when(F.col("rev") >= F.lit(least["b"]), "B").otherwise("C")
    return rev.select("item_id", (F.col("rev") / F.lit(float(unit))).alias("total_revenue"), klass.alias("abc_class"))


def abc_summary(abc: DataFrame, unit: int = 100) -> DataFrame:
    """Items and revenue per class, with shares in percent rounded to one
    decimal half-to-even (pandas rounding).  At most three rows, so the
    totals are a window over the class table itself."""
    from shelfcast.functions.numeric import round_half_even

    per_class = abc.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.round(F.col("total_revenue") * F.lit(float(unit))).cast("long")).alias("_rev"),
    )
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return per_class.select(
        "abc_class", "n_items",
        round_half_even(F.col("n_items") / F.sum("n_items").over(every) * 100, 1).alias("pct_items"),
        round_half_even(F.try_divide(F.col("_rev") / F.lit(float(unit)), F.sum("_rev").over(every) / F.lit(float(unit))) * 100, 1).alias("pct_revenue"),
    )


# ------------------------------------------------------------ output order ---

# The order in which the reference writes each output.
OUTPUT_ORDER = {
    "dim_product": [("item_id", True)],
    "dim_store": [("store_id", True)],
    "dim_calendar": [("date", True)],
    "weekly_category_sales": [("cat_id", True), ("store_id", True), ("wm_yr_wk", True)],
    "silver_sales_daily": [("id", True), ("date", True)],
    "abc_classification": [("total_revenue", False), ("item_id", True)],
    "comparison_table": [("RMSSE", True), ("model", True)],
}


def order_outputs(df: DataFrame, table: str) -> DataFrame:
    """Sort at the output edge only (row order is not a property of a Spark
    table): a range-partitioned distributed sort, nulls last like pandas."""
    keys = OUTPUT_ORDER[table]
    return df.orderBy(*[F.col(c).asc_nulls_last() if asc else F.col(c).desc_nulls_last() for c, asc in keys])
