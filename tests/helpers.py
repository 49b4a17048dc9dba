"""Hand-made frames for the edge-case tests."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

SILVER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("item_id", T.StringType()),
    T.StructField("dept_id", T.StringType()), T.StructField("cat_id", T.StringType()),
    T.StructField("store_id", T.StringType()), T.StructField("state_id", T.StringType()),
    T.StructField("date", T.DateType()), T.StructField("d", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()), T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()), T.StructField("year", T.IntegerType()),
    T.StructField("units", T.IntegerType()), T.StructField("sell_price", T.DoubleType()),
    T.StructField("revenue", T.DoubleType()), T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()), T.StructField("snap_flag", T.ByteType()),
    T.StructField("is_weekend", T.ByteType()), T.StructField("is_active", T.ByteType()),
])

START = dt.date(2000, 1, 1)


def silver_rows(series: dict[str, list[int]], price: float | None = 1.0, store="CA_1", state="CA",
                start: dt.date = START) -> list[tuple]:
    """Complete Silver rows for the given series (id -> daily units)."""
    rows = []
    for sid, units in series.items():
        item = sid.rsplit("_", 2)[0] if sid.count("_") >= 2 else sid
        for i, u in enumerate(units):
            d = start + dt.timedelta(days=i)
            wday = (d.isoweekday() % 7 + 1) % 7 + 1  # Sat=1, Sun=2, ...
            rev = None if u is None else u * (price or 0.0)
            rows.append((sid, item, "FOODS_1", "FOODS", store, state, d, f"d_{i + 1}", 11101 + i // 7,
                         wday, d.month, d.year, u, price, rev, None, None, 0,
                         1 if wday in (1, 2) else 0, 0 if price is None else 1))
    return rows


def silver_df(spark, series, **kw):
    return spark.createDataFrame(silver_rows(series, **kw), SILVER_SCHEMA)
