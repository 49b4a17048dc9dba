import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.plans.silver import silver_sales_daily
from shelfcast.session import scratch_path
from shelfcast.sources import fixtures
from shelfcast.streaming.incremental import silver_stream


def test_incremental_silver_equals_batch(spark):
    """Two landings, two availableNow runs on one checkpoint: every file is
    processed once and the result equals the batch Silver."""
    days = fixtures.Span(dt.date(2000, 1, 1), 10)
    cal = fixtures.calendar(spark, days)
    names = ", ".join(f"{d} int" for d in days.day_names)
    rows = [(f"I{i}_{st}", f"I{i}", "D_1", "D", st, st[:2], *[(i * d) % 4 for d in range(10)])
            for i in range(6) for st in ("CA_1", "TX_1")]
    sales = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, " + names)
    prices = spark.createDataFrame([("CA_1", "I2", 11101, 2.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    landing, ckpt, out = (scratch_path(spark, n) for n in ("landing", "ckpt", "silver-stream"))
    ca1 = F.col("store_id") == "CA_1"
    sales.where(ca1).write.option("header", True).csv(landing)
    silver_stream(spark, landing, cal, prices, out, checkpoint=ckpt).awaitTermination(300)
    assert spark.read.parquet(out).count() == 60
    sales.where(~ca1).write.mode("append").option("header", True).csv(landing)
    silver_stream(spark, landing, cal, prices, out, checkpoint=ckpt).awaitTermination(300)
    streamed = spark.read.parquet(out)
    batch = silver_sales_daily(sales, cal, prices)
    assert streamed.count() == 120
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_a_start_without_its_checkpoint_is_refused(spark):
    with pytest.raises(TypeError):
        silver_stream(spark, "x", None, None, "y")
