import os

import pytest

import duckdb

from tidemill.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    assert rows
    if name in SQL:
        con = duckdb.connect()
        for file in os.listdir(FOLDER):
            con.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
        found = con.sql(SQL[name])
        order = sorted(found.columns)
        assert order == sorted(frame.columns)
        theirs = sorted((tuple(str(r[found.columns.index(c)]) for c in order) for r in found.fetchall()), key=str)
        assert sorted((tuple(str(r[c]) for c in order) for r in rows), key=str) == theirs
