"""Silver kept up to date as new raw sales files land.

The reference rebuilds Silver in batch.  The same transform runs unchanged on a
Structured Streaming source: wide sales files read with ``readStream`` are
unpivoted and joined with the static calendar and price tables (stream-static
left joins), and appended to the Silver folder.  ``availableNow`` processes
whatever has landed and stops, so the job can run on a schedule; the
``checkpoint`` folder, which every start of the job must name alike, makes each file
count once, also across restarts after a lost executor or driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.plans.silver import silver_sales_daily
from shelfcast.sources.files import csv_header, schema_from_header


def silver_stream(spark: SparkSession, landing_dir: str, calendar: DataFrame, prices: DataFrame,
                  out_path: str, checkpoint: str, sample_file: str | None = None,
                  available_now: bool = True):
    """Start the incremental Silver job; returns the ``StreamingQuery``.

    The stream needs its schema up front: it is generated from the header of
    ``sample_file`` (any raw sales CSV of the same layout) or of the landing
    folder itself.
    """
    schema = schema_from_header(csv_header(spark, sample_file or landing_dir))
    sales = spark.readStream.schema(schema).option("header", True).csv(landing_dir)
    silver = silver_sales_daily(sales, calendar, prices)
    writer = (silver.writeStream.format("parquet").outputMode("append")
              .option("path", out_path)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
