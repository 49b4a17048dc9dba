"""Gold: the six tables built from one Silver read."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.numeric import cents_sum
from shelfcast.operators import gold as g
from shelfcast.plans import manifest
from shelfcast.session import checkpoint_root

GOLD_TABLES = ["dim_product", "dim_store", "dim_calendar", "fact_sales",
               "weekly_category_sales", "abc_classification"]


def per_series(silver: DataFrame) -> DataFrame:
    """One row per id: its attributes, rows, units and revenue in cents.  No exchange on
    the buckets; written once to the shared checkpoint folder, for all that needs no days."""
    checkpoint_root(silver.sparkSession)
    attrs = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    return silver.groupBy("id", *attrs).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units").alias("units"), cents_sum("revenue").alias("rev"),
    ).checkpoint(eager=True)


def gold_tables(silver: DataFrame, series: DataFrame | None = None) -> dict[str, DataFrame]:
    """Lazy plans of the six Gold tables: the dimensions of products and stores and the
    classes come from the per-series table, the others from one (pruned) Silver input."""
    series = per_series(silver) if series is None else series
    revenue = series.groupBy("item_id").agg(F.sum("rev").alias("rev"), F.sum("units").alias("total_units"))
    return {
        "dim_product": g.dim_product(series),
        "dim_store": g.dim_store(series),
        "dim_calendar": g.dim_calendar(silver),
        "fact_sales": g.fact_sales(silver),
        "weekly_category_sales": g.weekly_category_sales(silver),
        "abc_classification": g.abc_from_revenue(revenue),
    }


def write_tables(spark: SparkSession, tables: dict[str, DataFrame], out_dir: str,
                 parallel: int = 4) -> dict[str, dict]:
    """Write independent tables (Parquet, overwrite) as concurrent Spark jobs and return
    each one's row count and fingerprint, observed while it is written.  Small jobs (the
    dimensions) no longer leave the cluster idle while they run one by one."""
    from concurrent.futures import ThreadPoolExecutor

    def write(item):
        name, df = item
        df, seen = manifest.observed(df)
        df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}.parquet")
        return name, seen.get

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(write, tables.items()))


def write_gold(spark: SparkSession, silver: DataFrame, gold_dir: str, parallel: int = 4) -> dict[str, dict]:
    """Write the six Gold tables; name -> row count and fingerprint."""
    return write_tables(spark, gold_tables(silver), gold_dir, parallel)
