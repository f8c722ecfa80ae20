"""Queries that walk from tile 0, on a graph that reaches farther than their SQL does."""

import datetime

import duckdb
import pytest

from chunkloom.jobs.registry import ORACLE_SQL, QUERIES
from chunkloom.operators.graphs import depths

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


@pytest.mark.parametrize("name", ["anchor_depths", "spanning_tree_parents"])
def test_a_chain_longer_than_the_sql_goes(spark, tmp_path, name):
    rows = [(8 * tile, 8, 1, 1, 25.0, 1.0, 0.0, 0.05, "A", "F", datetime.datetime(2024, 1, 1)) for tile in range(30)]
    spark.createDataFrame(rows, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES[name](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    columns = sorted(got.columns)
    wanted = con.execute("select " + ", ".join(columns) + f" from ({ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(wanted)


def test_depths_without_a_bound_reach_all(spark):
    edges = spark.createDataFrame([(i, i + 1, True) for i in range(30)], "fixed long, moving long, accepted boolean")
    assert depths(edges, 0).count() == 31 and depths(edges, 0, within=24).count() == 25
