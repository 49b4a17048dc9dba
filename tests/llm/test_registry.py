"""Registered SQL is text, belongs to a query and gives its rows."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from shelfcast.llm.queries import ORACLES, QUERIES


def test_thirteen_operators_and_the_pipeline():
    ops = {k for k in E.queries() if k.startswith("op") and k[2:].split("_")[0].isdigit()}
    assert sorted(int(k[2:].split("_")[0]) for k in ops) == list(range(1, 14))
    assert "pipeline" in E.queries()


def test_sql_is_text_of_registered_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert all(isinstance(sql, str) for sql in E.oracle_sql().values())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_rows_of_the_query(spark, sf_small, name):
    con = duckdb.connect()
    for t in os.listdir(sf_small):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{sf_small}/{t}')")
    df = QUERIES[name](spark, sf_small)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    want = sorted(map(repr, cur.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == want
