"""Per-series operations on the long (id, date, units) layout.

Series stay long: windows are partitioned by ``id``, so one shuffle on ``id``
serves every per-series computation, and a single series holds at most one
row per calendar day (the grain checked by ``dq_unique_grain``), which bounds
every window partition by the number of days.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import round_half_up

MAX_BROADCAST_DATES = 200_000       # ~550 years of days


@dataclass(frozen=True)
class DateAxis:
    """The series' columns in the reference's matrix: the distinct dates.

    Only scalars reach the driver (first, last and number of dates).  When the
    dates are gap-free (the usual case) the 0-based day index is a plain
    ``datediff``; otherwise it comes from a broadcast of the distinct-date
    table, whose size is the (checked) number of dates.
    """
    first: object
    last: object
    n_dates: int
    dense: bool
    dates: DataFrame | None = None

    def index(self, date_col: str = "date"):
        return F.datediff(F.col(date_col), F.lit(self.first)).cast("int")

    def with_index(self, df: DataFrame, date_col: str = "date", out: str = "day_index") -> DataFrame:
        if self.dense:
            return df.withColumn(out, self.index(date_col))
        dates = self.dates.withColumnRenamed("day_index", out).withColumnRenamed("date", date_col)
        # n_dates was counted: broadcast only below the bound, else a shuffle join
        return df.join(F.broadcast(dates) if self.n_dates <= MAX_BROADCAST_DATES else dates, date_col)


def date_axis(df: DataFrame, date_col: str = "date") -> DateAxis:
    row = df.agg(F.min(date_col).alias("a"), F.max(date_col).alias("b"),
                 F.countDistinct(date_col).alias("n")).first()
    if row["n"] == 0:
        raise ValueError("no dates")
    span = (row["b"] - row["a"]).days + 1
    if span == row["n"]:
        return DateAxis(row["a"], row["b"], int(row["n"]), True)
    # Bounded by the number of distinct dates (checked above), so one
    # ordered window over it is a small single task.
    dates = df.select(date_col).distinct().select(
        F.col(date_col).alias("date"),
        (F.row_number().over(Window.orderBy(date_col)) - 1).cast("int").alias("day_index"))
    return DateAxis(row["a"], row["b"], int(row["n"]), False, dates)


def by_series(id_col: str = "id", order: str = "date") -> Window:
    return Window.partitionBy(id_col).orderBy(order)


def temporal_split(long_df: DataFrame, horizon: int = 28, axis: DateAxis | None = None):
    """Last ``horizon`` dates are test, the rest train.  Raises when there are
    not more dates than the horizon.  Returns (train, test, axis)."""
    axis = axis or date_axis(long_df)
    if axis.n_dates <= horizon:
        raise ValueError(f"need more than {horizon} dates, have {axis.n_dates}")
    n_train = axis.n_dates - horizon
    df = axis.with_index(long_df)
    return df.where(F.col("day_index") < n_train), df.where(F.col("day_index") >= n_train), axis


def label_split(long_df: DataFrame, horizon: int = 28) -> DataFrame:
    """Every row with ``split`` = 'train' / 'test' (the two date ranges)."""
    train, test, _ = temporal_split(long_df, horizon)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def cutoff_split(df: DataFrame, date_col: str, cutoff: str):
    """Train ``date < cutoff``, test ``date >= cutoff``; null dates in neither."""
    c = F.lit(cutoff).cast("date")
    return df.where(F.col(date_col) < c), df.where(F.col(date_col) >= c)


def lag_features(df: DataFrame, lags=(7, 14, 28), id_col: str = "id") -> DataFrame:
    """``lag_k`` = units k rows earlier in the same series (no leak across series)."""
    w = by_series(id_col)
    return df.select("*", *[F.lag("units", k).over(w).alias(f"lag_{k}") for k in lags])


def rolling_mean_features(df: DataFrame, windows=(7, 28), id_col: str = "id") -> DataFrame:
    """Mean of the previous ``w`` rows, today excluded; null until ``w`` rows
    exist (pandas ``shift(1).rolling(w).mean()`` with min_periods = w)."""
    cols = []
    for w in windows:
        frame = by_series(id_col).rowsBetween(-w, -1)
        full = F.count("units").over(frame) == w
        cols.append(round_half_up(F.when(full, F.avg("units").over(frame)), 6).alias(f"rolling_mean_{w}"))
    return df.select("*", *cols)


def diff_sq(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Squared first difference along each series (null on its first row)."""
    d = (F.col("units") - F.lag("units", 1).over(by_series(id_col))).cast("bigint")
    return df.withColumn("diff_sq", d * d)


def series_first_sale(long_df: DataFrame, axis: DateAxis | None = None, id_col: str = "id") -> DataFrame:
    """0-based index of the first day with units > 0; -1 if the series never sold."""
    axis = axis or date_axis(long_df)
    df = axis.with_index(long_df)
    return df.groupBy(id_col).agg(
        F.coalesce(F.min(F.when(F.col("units") > 0, F.col("day_index"))), F.lit(-1)).alias("first_sale_index"))


def last_n_days(long_df: DataFrame, n: int = 90, axis: DateAxis | None = None) -> DataFrame:
    """Rows of the last ``n`` distinct dates."""
    axis = axis or date_axis(long_df)
    return axis.with_index(long_df).where(F.col("day_index") >= axis.n_dates - n).drop("day_index")


def tail_mean(long_df: DataFrame, window: int = 28, id_col: str = "id") -> DataFrame:
    """Per series: mean of its last ``window`` rows by date."""
    w = Window.partitionBy(id_col).orderBy(F.col("date").desc())
    return (long_df.select(id_col, "units", F.row_number().over(w).alias("_rn"))
            .where(F.col("_rn") <= window)
            .groupBy(id_col).agg(round_half_up(F.avg("units"), 6).alias("tail_mean")))
