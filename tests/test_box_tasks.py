"""Overlapping boxes are compared in many tasks, however small their file."""

import pytest

from chunkloom.jobs.registry import QUERIES


@pytest.mark.parametrize("name", ["cross_view_pairs", "box_overlap_pairs"])
def test_cells_are_dealt_to_tasks(spark, name):
    found = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
