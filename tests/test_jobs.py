"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from chunkloom.jobs.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect())))
    assert sorted(c[0] for c in db.execute(f"describe {ORACLE_SQL[name]}").fetchall()) == columns
    wanted = db.execute("select " + ", ".join(f'"{c}"' for c in columns) + f" from ({ORACLE_SQL[name]})").fetchall()
    assert rows == sorted(map(repr, wanted))
