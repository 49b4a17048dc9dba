"""Table schemas, column lists and the Silver contract."""
from __future__ import annotations

from pyspark.sql import types as T

ID_COLS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
DAY_PREFIX = "d_"

CALENDAR_COLS = [
    "d", "date", "wm_yr_wk", "wday", "month", "year",
    "event_name_1", "event_type_1", "snap_CA", "snap_TX", "snap_WI",
]

CALENDAR_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("d", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()),
    T.StructField("snap_WI", T.IntegerType()),
])

PRICES_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])


def sales_schema(day_cols: list[str]) -> T.StructType:
    """Wide sales: the six id strings, then one int per day column."""
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in ID_COLS]
        + [T.StructField(c, T.IntegerType()) for c in day_cols]
    )


# Silver: grain (id, date); the column order is part of the contract.
SILVER_COLS = [
    "id", "item_id", "dept_id", "cat_id", "store_id", "state_id",
    "date", "d", "wm_yr_wk", "wday", "month", "year",
    "units", "sell_price", "revenue",
    "event_name_1", "event_type_1", "snap_flag", "is_weekend", "is_active",
]

# The SQL variant keeps 16 columns (no dept_id, d, wm_yr_wk, revenue).
SILVER_SQL_COLS = [
    "id", "item_id", "cat_id", "store_id", "state_id", "date", "units",
    "wday", "month", "year", "event_name_1", "event_type_1", "snap_flag",
    "sell_price", "is_weekend", "is_active",
]

FACT_COLS = ["item_id", "store_id", "date", "units", "sell_price", "revenue",
             "snap_flag", "is_active"]

FLAG_COLS = ["snap_flag", "is_weekend", "is_active"]


# Silver contract: column -> (type, nullable, minimum or None).
SILVER_CONTRACT = {
    "id": (T.StringType(), False, None),
    "item_id": (T.StringType(), False, None),
    "store_id": (T.StringType(), False, None),
    "date": (T.DateType(), False, None),
    "units": (T.IntegerType(), False, 0),
    "sell_price": (T.DoubleType(), True, 0),
}
