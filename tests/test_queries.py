import os

import duckdb
import pytest

import __spark_entry__ as entry
from tidemill.plans import catalog_queries, core_queries, reference_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = core_queries.QUERIES | reference_queries.QUERIES | catalog_queries.QUERIES
SQL = core_queries.SQL | reference_queries.SQL | catalog_queries.SQL


def plain(v):
    return repr(round(v, 6)) if isinstance(v, float) else None if v is None else str(v)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    assert rows or name in ("exact_duplicates", "marks_again", "faceted_search", "filtered_markets")  # the smallest tables have none
    if name in SQL:
        con = duckdb.connect()
        con.execute("set timezone = 'UTC'")
        for file in os.listdir(FOLDER):
            con.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
        found = con.sql(SQL[name])
        columns = found.columns
        theirs = sorted((tuple(plain(r[columns.index(c)]) for c in sorted(columns)) for r in found.fetchall()), key=str)
        assert sorted(columns) == sorted(frame.columns)
        assert sorted((tuple(plain(r[c]) for c in sorted(columns)) for r in rows), key=str) == theirs


def test_entry(spark):
    assert entry.entry(spark).columns == ["snapshot_date", "uid", "change_kind"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
