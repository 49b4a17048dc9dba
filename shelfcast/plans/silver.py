"""Silver: product x store x day fact built from the three Bronze tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.numeric import round_half_up
from shelfcast.operators import features as feat
from shelfcast.operators.joins import MAX_BROADCAST_ROWS, bounded_broadcast, join_calendar
from shelfcast.operators.reshape import day_columns, day_values, literals
from shelfcast.schemas import CALENDAR_COLS, ID_COLS, SILVER_COLS, SILVER_SQL_COLS


BYTES_PER_ROW = 60               # of a Silver row in memory, roughly
BUCKET_BYTES = 128 << 20


def silver_buckets(sales: DataFrame) -> int:
    """Number of buckets for a wide sales table: its long rows by size, and at least one
    bucket per core that the session has."""
    rows = sales.count() * len(day_columns(sales))
    return max(sales.sparkSession.sparkContext.defaultParallelism, -(-rows * BYTES_PER_ROW // BUCKET_BYTES))


def week_positions(calendar: DataFrame, days: list[str]) -> tuple[list[int], list[int | None]]:
    """The calendar's weeks in order, and for each day name the 1-based position of its week.

    A calendar has one row per day; ``MAX_BROADCAST_ROWS`` is checked before it is read."""
    if calendar.count() > MAX_BROADCAST_ROWS:
        raise ValueError("the calendar is larger than any calendar of days")
    week = {r["d"]: r["wm_yr_wk"] for r in calendar.select("d", "wm_yr_wk").collect()}
    weeks = sorted({w for w in week.values() if w is not None})
    at = {w: i + 1 for i, w in enumerate(weeks)}
    return weeks, [at.get(week.get(d)) for d in days]


def with_prices(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> tuple[DataFrame, Column]:
    """Wide rows as ids, ``_days`` (the day columns as one array, so that what follows plans
    and moves a few columns) and ``_weeks``, their prices by week; and the prices of each day.

    Prices are folded to one row per (store, item) - at most one entry per week - and
    joined to the *wide* rows, so the long rows never move.  A week whose key has two
    prices keeps both and gives two Silver rows a day, as a join of the long rows would:
    ``dq_no_fanout`` sees it."""
    days = day_columns(sales)
    weeks, at = week_positions(calendar, days)
    key = ["store_id", "item_id"]
    # a key's weeks in order, with empty ones for those between that have no price: each entry
    # is placed once (looking every week up in a map would take the square of the weeks)
    place = sales.sparkSession.createDataFrame(
        list(zip(weeks, range(len(weeks)))), f"wm_yr_wk {prices.schema['wm_yr_wk'].dataType.simpleString()}, _at int")
    no_price = F.array().cast(f"array<{prices.schema['sell_price'].dataType.simpleString()}>")
    last = lambda i: F.coalesce(F.get("_all", i - 1)["_at"], F.lit(-1))
    folded = (prices.join(F.broadcast(place), "wm_yr_wk")
              .groupBy(*key, "_at").agg(F.collect_list("sell_price").alias("p"))
              .groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_at", "p"))).alias("_all"))
              .select(*key, F.flatten(F.transform("_all", lambda e, i: F.concat(
                  F.array_repeat(no_price, e["_at"] - last(i) - 1), F.array(e["p"])))).alias("_weeks")))
    per_day = F.transform(literals([p or 0 for p in at]), lambda p: F.when(p > 0, F.get("_weeks", p - 1)))
    ids = [c for c in sales.columns if c not in set(days)]
    wide = sales.select(*ids, day_values(days).alias("_days"))
    return wide.join(folded, key, "left"), per_day


def priced_long(sales: DataFrame, calendar: DataFrame, prices: DataFrame, id_cols: list[str],
                partitions: int | None = None) -> DataFrame:
    """Long rows (ids, d, units, sell_price), hash-partitioned by id.

    The wide rows are spread by ``id`` before anything is computed per day: they are few, the
    explode then uses every task, and the long rows stay laid out by series for the bucketed
    write."""
    wide, per_day = with_prices(sales, calendar, prices)
    n = partitions or int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = wide.repartition(n, "id")
    days = day_columns(sales)
    names = literals(days)
    zipped = F.arrays_zip(F.col("_days").alias("units"), per_day.alias("prices"))
    long_df = wide.select(*id_cols, F.posexplode(zipped).alias("_pos", "_cell")).select(
        *id_cols, F.element_at(names, F.col("_pos") + 1).alias("d"), F.col("_cell.units").alias("units"),
        F.col("_cell.prices").alias("_p"))
    # a cell has no price (one row with null), one, or a repeated key's several
    return long_df.select(*id_cols, "d", "units", F.explode_outer("_p").alias("sell_price"))


def silver_sales_daily(sales: DataFrame, calendar: DataFrame, prices: DataFrame,
                       partitions: int | None = None) -> DataFrame:
    """prices onto wide rows -> unpivot -> calendar join (guarded) -> features -> types.

    Returns the 20 Silver columns in contract order, hash-partitioned by id.
    Row order is not a property of a Spark table; writers sort within
    partitions by (id, date).
    """
    df = priced_long(sales, calendar, prices, ID_COLS, partitions)
    df = join_calendar(df, calendar, guard=True)
    cols = feat.silver_columns()
    return df.select(*[cols[c].alias(c) for c in SILVER_COLS])


def silver_sales_daily_sql(sales: DataFrame, calendar: DataFrame, prices: DataFrame) -> DataFrame:
    """The SQL variant: nulls dropped by UNPIVOT, unmatched days keep a null
    date, unknown state gives a NULL SNAP flag; 16 columns."""
    df = priced_long(sales, calendar, prices, [c for c in ID_COLS if c != "dept_id"]).where("units IS NOT NULL")
    df = df.join(bounded_broadcast(calendar.select(*CALENDAR_COLS)), "d", "left")
    exprs = {"snap_flag": feat.snap_flag_expr(True).cast("int"), "is_weekend": feat.is_weekend_expr(),
             "is_active": feat.is_active_expr()}
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in SILVER_SQL_COLS])


def _layout_path(path: str) -> str:
    return path.rstrip("/") + ".layout"


def publish_silver(silver: DataFrame, path: str, table: str, buckets: int) -> DataFrame:
    """Write Silver as a table bucketed by ``id`` at ``path``, and how many buckets it has
    beside it: whoever opens it later must know that, whatever their own settings are.

    Silver is already hash-partitioned by id into ``buckets`` partitions, which is
    exactly Spark's bucketing, so each task writes one bucket file and nothing is
    shuffled.  Inside a file the rows of a series are contiguous and in date order.
    Every later job that works per series reads the buckets as its partitions and skips
    the shuffle of the largest table.
    """
    spark = silver.sparkSession
    (silver.write.mode("overwrite").option("path", path)
     .bucketBy(buckets, "id").saveAsTable(table))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").json(_layout_path(path))
    return spark.table(table)


def open_silver(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Register an existing bucketed Silver folder (e.g. in a new session), with the
    schema and the number of buckets it was written with."""
    if not spark.catalog.tableExists(table):
        buckets = spark.read.schema("buckets int").json(_layout_path(path)).first()["buckets"]
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet CLUSTERED BY (id) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def silver_profile(silver: DataFrame) -> DataFrame:
    """Rows, columns, date range and share of priced (active) rows in one pass."""
    return silver.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        round_half_up(F.avg("is_active"), 6).alias("active_share"),
    ).select("n_rows", F.lit(len(silver.columns)).alias("n_columns"), "min_date", "max_date", "active_share")
