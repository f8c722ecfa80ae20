"""Quantile lines against every line through two points, and on a planted envelope."""

import numpy as np
import pytest

from chunkloom.operators.quantile_lines import quantile_lines

ROWS = "key string, x double, y double"


def loss(points, slope, offset, share):
    off = [y - slope * x - offset for x, y in points]
    return sum(share * r if r > 0 else (share - 1) * r for r in off)


def best(points, share):
    lines = [((d - b) / (c - a), b - (d - b) / (c - a) * a) for a, b in points for c, d in points if a < c]
    return min((round(loss(points, *line, share), 7), round(line[0], 7), round(line[1], 7)) for line in lines)


def test_lines_against_every_pair_of_points(spark):
    rng = np.random.default_rng(4)
    sets = {f"k{i}": [(float(a), float(b)) for a, b in zip(rng.integers(-4, 5, 25), rng.integers(-9, 10, 25))] for i in range(6)}
    sets["line"] = [(float(x), 3.0 * x - 1) for x in range(5)] * 4
    table = spark.createDataFrame([(k, *p) for k, own in sets.items() for p in own] + [("one", 2.0, 1.0), ("one", 2.0, 4.0), (None, 1.0, 1.0), ("one", None, 1.0)], ROWS)
    got = {r["key"]: r for r in quantile_lines(table, 0.3).collect()}
    for key, own in sets.items():
        want = best(own, 0.3)
        assert (got[key]["loss"], got[key]["slope"]) == (pytest.approx(want[0], abs=1e-5), pytest.approx(want[1], abs=1e-6)), key
        assert got[key]["n"] == len(own) and loss(own, got[key]["slope"], got[key]["offset"], 0.3) == pytest.approx(want[0], abs=1e-5)
    assert (got["one"]["slope"], got["one"]["offset"], got["one"]["n"]) == (0.0, 1.0, 2)
    assert quantile_lines(table.limit(0), 0.3).count() == 0


def test_planted_envelope(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(100, 2000, 4000)
    y = 0.8 * x + 20 + rng.exponential(50.0, x.size)
    line = quantile_lines(spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y)], ROWS), 0.05).first()
    assert line["slope"] == pytest.approx(0.8, abs=0.01) and line["offset"] == pytest.approx(20 - 50 * np.log(0.95), abs=4)
    assert np.mean(y < line["slope"] * x + line["offset"]) == pytest.approx(0.05, abs=0.005)
