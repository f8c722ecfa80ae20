"""Nearest points by cells against brute force, and their plans."""

import random

import pytest

from chunkloom.operators.measures import nearest_distance

POINT = "id long, source long, px long, py long"


@pytest.mark.parametrize("whole", [False, True])
def test_dense_sparse_and_repeated_points(spark, whole):
    rnd = random.Random(7)
    rows = [(rnd.randrange(2), rnd.randrange(40), rnd.randrange(40)) for _ in range(500)] + [(0, 5000, 5000), (0, 5050, 5000), (1, -9000, 3), (2, 1, 1), (None, 3, 3), (None, 3, 3), (0, None, 3)]
    rows = [(i, *r) for i, r in enumerate(rows)] + [(1000, 3, 8, 8), (1000, 3, 8, 8), (1001, 3, 8, 12)]
    wanted = {}
    for i, s, x, y in rows:
        far = [(x - u) ** 2 + (y - v) ** 2 for j, t, u, v in rows if j != i and s is not None and s == t and x is not None and u is not None]
        far = [d for d in far if whole or d <= 64 * 64]
        wanted[i] = min(far, default=None)
    got = nearest_distance(spark.createDataFrame(rows, POINT), 64, whole).collect()
    assert sorted((r["id"], r["d2"]) for r in got if r["d2"] is not None) == sorted((i, wanted[i]) for i, *_ in rows if wanted[i] is not None)
    assert len(got) == len(rows)


@pytest.mark.parametrize("name", ["nearest_point_distance", "bead_quality_flags"])
def test_no_growing_table_is_broadcast(spark, name):
    from chunkloom.jobs.registry import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
