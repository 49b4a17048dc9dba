"""Equi left joins of the Silver layer, and their guards."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.schemas import CALENDAR_COLS

# A calendar has one row per day: 200,000 rows are more than 500 years.
MAX_BROADCAST_ROWS = 200_000


def bounded_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a dimension only after checking its size; above ``max_rows``
    return it unhinted (a shuffle join).  The count runs on the small table
    only, never on the fact side."""
    n = dim.count()
    return F.broadcast(dim) if n <= max_rows else dim


def join_calendar(long_df: DataFrame, calendar: DataFrame, guard: bool = True,
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join on the day name ``d``; brings date and calendar attributes.

    The calendar has one row per day, so it is broadcast once its row count
    is checked.  With ``guard`` an unmatched day raises inside the same pass
    (no extra scan): the reference fails on a missing date too.
    """
    cal = bounded_broadcast(calendar.select(*CALENDAR_COLS), max_broadcast_rows)
    df = long_df.join(cal, "d", "left")
    if guard:
        df = df.withColumn(
            "date",
            F.coalesce(F.col("date"),
                       F.raise_error(F.concat(F.lit("no calendar row for day "), F.col("d"))).cast("date")),
        )
    return df


def calendar_misses(long_df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows whose day has no calendar entry (a left anti join)."""
    return long_df.join(bounded_broadcast(calendar.select("d")), "d", "left_anti")


def calendar_match_guard(long_df: DataFrame, calendar: DataFrame) -> DataFrame:
    """One-row check: how many long rows would get no date."""
    misses = calendar_misses(long_df, calendar)
    return misses.agg(F.count(F.lit(1)).alias("n_violations")).select(
        F.lit("calendar_match").alias("check"), "n_violations",
        (F.col("n_violations") == 0).alias("passed"),
    )


def join_prices(df: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join on (store_id, item_id, wm_yr_wk).  The price key must be
    unique (``dq_no_fanout`` catches a fan-out).  Both sides grow with the
    data, so no hint: sort-merge, or a broadcast chosen by AQE at run time
    from the measured size."""
    return df.join(prices.select("store_id", "item_id", "wm_yr_wk", "sell_price"),
                   ["store_id", "item_id", "wm_yr_wk"], "left")


def weights_reindex(series_ids: DataFrame, values: DataFrame, key: str = "id",
                    value: str = "revenue") -> DataFrame:
    """Align a per-series value to all series; absent -> 0."""
    return series_ids.select(key).join(values.select(key, value), key, "left").select(
        key, F.coalesce(F.col(value), F.lit(0).cast(values.schema[value].dataType)).alias(value)
    )
