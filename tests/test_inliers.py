"""Sets that agree, searched for many pairs at once."""

import random

import numpy as np
import pytest

from chunkloom.operators import inliers as I

ROW = "fixed long, moving long, id long, z double, y double, x double, weight double"


@pytest.mark.parametrize("m", [1, 2, 5, 9, 20])
def test_many_pairs_as_one_by_one(m):
    rnd = np.random.default_rng(m)
    shifts, bounds = rnd.integers(0, 7, (60, m, 3)).astype(float), np.array([1.5, 3.0, 2.0])
    shifts[0, 0, 1] = np.nan
    for found, own in zip(I.agreeing_sets(shifts, bounds), shifts):
        assert list(np.flatnonzero(found)) == list(I.largest_agreeing(own, bounds))


def test_pairs_cross_batches_and_calls_are_few(spark, monkeypatch):
    rnd = random.Random(3)
    rows = [(i // 9, i // 9 + i % 2, i, rnd.uniform(0, 4), rnd.uniform(0, 4), rnd.uniform(0, 4), rnd.uniform(-1, 1)) for i in range(400)] + [(None, 1, 1, 0.0, 0.0, 0.0, 1.0), (None, 1, 2, 0.0, 0.0, None, None)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        frame = I.marked(spark.createDataFrame(rows, ROW), (1.5, 2.0, 2.5), 3, 0.1)
        got = frame.collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "FlatMapGroups" not in frame._jdf.queryExecution().executedPlan().toString()  # no Python call for each pair
    pairs = {}
    for r in rows:
        pairs.setdefault(r[:2], []).append(r)
    wanted = {}
    for own in pairs.values():
        chosen = I.largest_agreeing(np.array([r[3:6] for r in own], float), np.array([1.5, 2.0, 2.5]))
        for k, r in enumerate(own):
            few = len(chosen) < 3
            wanted[r[:3]] = ("downweighted" if few else "inlier" if k in chosen else "outlier", None if r[6] is None else max(r[6], 0) * 0.1 if few else r[6] if k in chosen else 0.0)
    assert {(r["fixed"], r["moving"], r["id"]): (r["status"], r["weight"]) for r in got} == wanted
    with pytest.raises(Exception, match="more than 120"):
        I.marked(spark.createDataFrame([(1, 2, i, 0.0, 0.0, 0.0, 1.0) for i in range(121)], ROW), (1, 1, 1), 3, 0.1).collect()
