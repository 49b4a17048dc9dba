"""Row-level business features and the type cleaning of Silver."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# State -> SNAP column of the calendar.
SNAP_COLUMNS = {"CA": "snap_CA", "TX": "snap_TX", "WI": "snap_WI"}


def snap_flag_expr(unknown_as_null: bool = False):
    expr = None
    for state, col in SNAP_COLUMNS.items():
        cond = F.col("state_id") == state
        expr = F.when(cond, F.col(col)) if expr is None else expr.when(cond, F.col(col))
    return expr if unknown_as_null else expr.otherwise(F.lit(0))


def is_weekend_expr():
    """wday 1 = Saturday, 2 = Sunday; null wday -> 0."""
    return F.when(F.col("wday").isin(1, 2), 1).otherwise(0)


def is_active_expr():
    """A price that week means the item was on sale."""
    return F.when(F.col("sell_price").isNotNull(), 1).otherwise(0)


def revenue_expr():
    return F.col("units") * F.coalesce(F.col("sell_price"), F.lit(0.0))


def units_int_expr():
    """units as int; a null raises (as the int32 cast of the reference does)."""
    return F.coalesce(F.col("units").cast("int"),
                      F.raise_error(F.lit("null units cannot be stored as int")).cast("int"))


def snap_flag(df: DataFrame) -> DataFrame:
    """Local path: SNAP flag of the row's state; unknown state -> 0."""
    return df.withColumn("snap_flag", snap_flag_expr(False))


def snap_flag_sql(df: DataFrame) -> DataFrame:
    """SQL path: CASE without ELSE, unknown state -> NULL."""
    return df.withColumn("snap_flag", snap_flag_expr(True))


def is_weekend(df: DataFrame) -> DataFrame:
    return df.withColumn("is_weekend", is_weekend_expr())


def is_active(df: DataFrame) -> DataFrame:
    return df.withColumn("is_active", is_active_expr())


def revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", revenue_expr())


def _replace(df: DataFrame, new: dict) -> DataFrame:
    """One projection that adds or replaces columns (one plan step, however
    many columns: each extra DataFrame step re-analyses the whole plan)."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in new]
    return df.select(*keep, *[e.alias(n) for n, e in new.items()])


def add_features(df: DataFrame) -> DataFrame:
    """snap_flag, is_weekend, is_active and revenue in one projection."""
    return _replace(df, {"snap_flag": snap_flag_expr(False), "is_weekend": is_weekend_expr(),
                         "is_active": is_active_expr(), "revenue": revenue_expr()})


def clean_types(df: DataFrame) -> DataFrame:
    """Explicit types in one projection.  A null in ``units`` raises (as the
    int32 cast of the reference does); ANSI casts raise on overflow."""
    return _replace(df, {
        "date": F.col("date").cast("date"),
        "units": units_int_expr(),
        "sell_price": F.col("sell_price").cast("double"),
        "snap_flag": F.col("snap_flag").cast("tinyint"),
        "is_weekend": F.col("is_weekend").cast("tinyint"),
        "is_active": F.col("is_active").cast("tinyint"),
    })


def silver_columns() -> dict:
    """Features and types of every Silver column over the joined long rows,
    for a single final projection."""
    return {
        "id": F.col("id"), "item_id": F.col("item_id"), "dept_id": F.col("dept_id"),
        "cat_id": F.col("cat_id"), "store_id": F.col("store_id"), "state_id": F.col("state_id"),
        "date": F.col("date").cast("date"), "d": F.col("d"), "wm_yr_wk": F.col("wm_yr_wk"),
        "wday": F.col("wday"), "month": F.col("month"), "year": F.col("year"),
        "units": units_int_expr(), "sell_price": F.col("sell_price").cast("double"),
        "revenue": revenue_expr(), "event_name_1": F.col("event_name_1"),
        "event_type_1": F.col("event_type_1"),
        "snap_flag": snap_flag_expr(False).cast("tinyint"),
        "is_weekend": is_weekend_expr().cast("tinyint"),
        "is_active": is_active_expr().cast("tinyint"),
    }
