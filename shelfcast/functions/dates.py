"""Calendar expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def m5_wday(date) -> Column:
    """Day of week with 1 = Saturday, 2 = Sunday, ..., 7 = Friday."""
    return (F.dayofweek(_col(date)) % 7 + 1).cast("int")


def weekday_mon0(date) -> Column:
    """Day of week with 0 = Monday ... 6 = Sunday."""
    return F.weekday(_col(date)).cast("int")


def sunday_week_start(date) -> Column:
    """First day of the Sunday-start week (Spark's date_trunc('week') is Monday)."""
    return F.date_sub(_col(date), F.dayofweek(_col(date)) - 1)
