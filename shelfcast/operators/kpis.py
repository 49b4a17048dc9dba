"""Store KPIs: the data behind the reference API's KPI call, as a table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import cents_sum, money, round_half_up


def store_kpis(fact: DataFrame, abc: DataFrame) -> DataFrame:
    """Per store: total revenue, mean units over product-day rows, and the
    number of distinct items sold there (units > 0) whose chain-wide ABC
    class is A.

    The (store, item) pairs with sales are collapsed first (combined
    map-side), and only those meet the A items in a join on ``item_id``; the
    ABC table grows with the catalogue, so no broadcast hint - AQE picks one
    at run time if the measured side is small.
    """
    totals = fact.groupBy("store_id").agg(
        money(cents_sum("revenue")).alias("total_revenue"),
        round_half_up(F.avg("units"), 6).alias("avg_daily_units"),
    )
    sold = fact.where(F.col("units") > 0).select("store_id", "item_id").distinct()
    a_items = abc.where(F.col("abc_class") == "A").select("item_id")
    a_count = sold.join(a_items, "item_id").groupBy("store_id").agg(F.count(F.lit(1)).alias("abc_a_products"))
    return totals.join(a_count, "store_id", "left").select(
        "store_id", "total_revenue", "avg_daily_units",
        F.coalesce(F.col("abc_a_products"), F.lit(0).cast("bigint")).alias("abc_a_products"))
