"""The driver contract: entry(), and oracle agreement for a sample of queries."""
import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SAMPLE = ["silver_sales_daily", "weekly_category_sales", "abc_classification", "abc_percent_rank",
          "evaluate_model", "comparison_table", "demand_class_summary", "dq_report", "store_kpis",
          "rolling_mean_features", "forecast_lookup"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()[:10]
    return None if v is None else repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"cat_id", "store_id", "wm_yr_wk", "total_units", "total_revenue",
                               "avg_daily_units", "active_items"}


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    core = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert core <= set(o)


@pytest.mark.parametrize("name", SAMPLE)
def test_oracle_agrees(spark, sf_small, name):
    con = duckdb.connect()
    for t in os.listdir(sf_small):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{sf_small}/{t}')")
    df = E.queries()[name](spark, sf_small)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, df.collect()) == _rows(dcols, cur.fetchall())
