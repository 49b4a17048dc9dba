import datetime as dt
import os
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcast.plans.pipeline import PipelineError, run_pipeline
from shelfcast.session import scratch_path
from shelfcast.sources import bronze as bz
from shelfcast.sources import files, fixtures


def test_csv_null_tokens(spark):
    path = scratch_path(spark, "csv")
    if "://" in path and not path.startswith("file:"):
        pytest.skip("needs a local checkpoint folder to hand-write a CSV")
    local = path.replace("file:", "")
    os.makedirs(local)
    with open(f"{local}/calendar.csv", "w") as f:
        f.write("date,d,wm_yr_wk,wday,month,year,event_name_1,event_type_1,snap_CA,snap_TX,snap_WI\n")
        f.write("2011-01-29,d_1,11101,1,1,2011,NA,,0,0,0\n")
    plain = files.read_raw_csv(spark, f"{path}/calendar.csv").first()
    assert plain.event_name_1 == "NA" and plain.event_type_1 is None
    tok = files.read_raw_csv(spark, f"{path}/calendar.csv", null_tokens=files.PANDAS_NULL_TOKENS).first()
    assert tok.event_name_1 is None and tok.wm_yr_wk == 11101 and str(tok.date) == "2011-01-29"


def test_malformed_numbers_and_foreign_headers_raise(spark, tmp_path):
    head = "store_id,item_id,wm_yr_wk,sell_price\n"
    (tmp_path / "bad.csv").write_text(head + "CA_1,A,11101,cheap\n")
    for tokens in (None, files.PANDAS_NULL_TOKENS):
        with pytest.raises(Exception):
            files.read_raw_csv(spark, f"file:{tmp_path}/bad.csv", null_tokens=tokens).collect()
    (tmp_path / "na.csv").write_text(head + "CA_1,A,11101,NaN\nCA_1,B,11101,2.5\n")
    got = files.read_raw_csv(spark, f"file:{tmp_path}/na.csv", null_tokens=files.PANDAS_NULL_TOKENS).collect()
    assert sorted((r.item_id, r.sell_price) for r in got) == [("A", None), ("B", 2.5)]
    two = tmp_path / "two"
    two.mkdir()
    (two / "a.csv").write_text(head + "CA_1,A,11101,1.0\n")
    (two / "b.csv").write_text("item_id,store_id,wm_yr_wk,sell_price\nA,CA_1,11102,1.0\n")
    with pytest.raises(Exception):
        files.read_raw_csv(spark, f"file:{two}").collect()


def test_paths_are_looked_up_where_spark_reads(spark, tmp_path):
    assert bz.exists(spark, str(tmp_path)) and bz.exists(spark, f"file:{tmp_path}")
    assert not bz.exists(spark, f"{tmp_path}/nope")


def test_shared_folder_is_demanded_on_a_cluster(monkeypatch):
    from shelfcast import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


DAYS = fixtures.Span(dt.date(2000, 1, 1), 40)


def _tables(spark):
    """Twelve series over 40 days, a calendar and some prices."""
    names = ", ".join(f"{d} int" for d in DAYS.day_names)
    rows = [(f"I{i}_{st}", f"I{i}", f"{c}_1", c, st, st[:2], *[(i * d) % 5 for d in range(40)])
            for i in range(4) for c in [("FOODS", "HOBBIES")[i % 2]] for st in ("CA_1", "TX_1", "NY_1")]
    sales = spark.createDataFrame(rows, "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, " + names)
    prices = spark.createDataFrame([(st, f"I{i}", 11101 + w, 1.5 + i) for st in ("CA_1", "TX_1") for i in range(4) for w in range(6)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    return {"bronze_sales": sales, "bronze_calendar": fixtures.calendar(spark, DAYS), "bronze_prices": prices}


def _raw(spark, skip=()):
    raw = scratch_path(spark, "raw")
    bz.write_raw({k: v for k, v in _tables(spark).items() if k not in skip}, raw)
    return raw


def test_empty_after_filter_raises_and_writes_nothing(spark):
    raw = _raw(spark)
    out = scratch_path(spark, "bronze")
    with pytest.raises(ValueError, match="empty"):
        bz.ingest_bronze(spark, raw, out, cat="NONE")
    assert not os.path.exists(out.replace("file:", ""))


def test_missing_policy(spark):
    raw = _raw(spark, skip=("bronze_prices",))
    with pytest.raises(FileNotFoundError):
        bz.ingest_bronze(spark, raw, scratch_path(spark, "b"))
    res = bz.ingest_bronze(spark, raw, scratch_path(spark, "b"), on_missing="skip")
    assert res.skipped == ["bronze_prices"] and set(res.rows) == {"bronze_calendar", "bronze_sales"}
    with pytest.raises(FileNotFoundError):
        bz.ingest_bronze(spark, tempfile.mkdtemp() + "/nope", scratch_path(spark, "b"))


def test_subset_filter_pushed_down(spark):
    raw = _raw(spark)
    frames, _ = bz.read_bronze_sources(spark, raw, cat="FOODS", store="CA_1")
    plan = frames["bronze_sales"]._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "EqualTo(store_id,CA_1)" in plan
    assert frames["bronze_sales"].count() == 2
    assert frames["bronze_calendar"].count() == 40


def test_pipeline_restart_gives_same_gold(spark):
    raw = _raw(spark)
    work = scratch_path(spark, "work")
    first = run_pipeline(spark, raw, work)
    assert set(first.seconds) == {"bronze", "silver", "gold"}
    abc1 = spark.read.parquet(first.paths["abc_classification"]).collect()
    again = run_pipeline(spark, raw, work, start_at="silver")
    assert set(again.seconds) == {"silver", "gold"}
    abc2 = spark.read.parquet(again.paths["abc_classification"]).collect()
    assert sorted(abc1) == sorted(abc2)
    assert first.rows["silver_sales_daily"] == first.rows["fact_sales"] == 12 * 40
    with pytest.raises(ValueError):
        run_pipeline(spark, raw, work, start_at="platinum")
    with pytest.raises(PipelineError) as e:
        run_pipeline(spark, raw + "-missing", scratch_path(spark, "w2"))
    assert e.value.layer == "bronze"


RESTART = """
import sys
sys.path.insert(0, {repo!r})
from shelfcast.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=7)
spark.sparkContext.setCheckpointDir({ckpt!r})
from shelfcast.plans.pipeline import load_silver, run_pipeline
res = run_pipeline(spark, "none", {work!r}, start_at="gold")
s = load_silver(spark, {work!r})
hits = [s.where(s.id == f"I{{i}}_{{st}}").count() for i in range(4) for st in ("CA_1", "TX_1", "NY_1")]
rows = sorted(map(str, spark.read.parquet(res.paths["abc_classification"]).collect()))
print("RESULT", hits, rows)
"""


def test_restart_at_gold_in_a_new_process(spark, tmp_path):
    """Another process with other shuffle settings sees the same Silver and Gold."""
    work = scratch_path(spark, "work")
    first = run_pipeline(spark, _raw(spark), work)
    want = sorted(map(str, spark.read.parquet(first.paths["abc_classification"]).collect()))
    code = RESTART.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), ckpt=str(tmp_path / "ck"), work=work)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=tmp_path,
                         env={**os.environ, "SHELFCAST_DRIVER_MEMORY": "2g"})
    line = [x for x in out.stdout.splitlines() if x.startswith("RESULT")]
    assert line, out.stderr[-2000:]
    assert line[0] == f"RESULT {[40] * 12} {want}"


def test_publish_table_and_view(spark):
    df = fixtures.calendar(spark, DAYS)
    t = files.publish_table(df, "cal_test_tbl", scratch_path(spark, "tbl"))
    assert t.count() == 40
    v = files.publish_view(df.where(F.col("wday") == 1), "cal_test_view")
    assert v.count() == 6
    pruned = files.read_parquet(spark, files.write_parquet(df, scratch_path(spark, "p")), ["d", "date"])
    assert "ReadSchema: struct<d:string,date:date>" in pruned._jdf.queryExecution().executedPlan().toString() \
        or pruned.columns == ["d", "date"]


def test_bucketed_silver_needs_no_shuffle_per_series(spark):
    """Silver is written bucketed by id: per-series windows and aggregates read
    the buckets as partitions (no Exchange), also after re-registering."""
    from shelfcast.operators import forecast as fc
    from shelfcast.operators import diagnostics as dg
    from shelfcast.plans.pipeline import load_silver
    raw = _raw(spark)
    work = scratch_path(spark, "work")
    run_pipeline(spark, raw, work)
    silver = load_silver(spark, work)
    for df in (fc.baseline_frame(silver), dg.series_stats(silver)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan
    assert silver.count() == 12 * 40
    buckets = [f for f in os.listdir(f"{work}/silver/silver_sales_daily.parquet".replace("file:", "")) if f.startswith("part-")]
    assert len(buckets) <= spark.sparkContext.defaultParallelism
