"""Every query against its SQL, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check import digest



@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, sf, db, name):
    df = contract.queries()[name](spark, sf)
    rows = df.collect()
    assert rows
    if name in contract.oracle_sql():
        cursor = db.execute(contract.oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert digest(df.columns, rows)[:2] == digest(columns, cursor.fetchall())[:2]


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
