"""Fits on small inputs with known results."""

import math

import numpy as np
import pytest

from chunkloom.operators import fits, graphs


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_huber_line_withstands_an_outlier(spark):
    points = [(1, x, 2 * x + 1) for x in range(12)] + [(1, 5, 400)] + [(2, 3, 7)]
    found = {r["tile"]: r for r in fits.huber_lines(spark.createDataFrame(points, "tile long, x long, y long"), 1e-9, 1.0, 25).collect()}
    assert found[1]["slope"] == pytest.approx(2, abs=0.2) and found[1]["n"] == 13
    assert found[2]["slope"] * 3 + found[2]["offset"] == pytest.approx(7, abs=1e-3)


def test_fits_of_nothing(spark):
    assert fits.huber_lines(spark.createDataFrame([], "tile long, x long, y long"), 1.0, 1.0, 2).count() == 0
    assert fits.peeled_lines(spark.createDataFrame([], "tile long, x long, y double"), 1.0, 2).count() == 0
    assert fits.entropy_thresholds(spark.createDataFrame([], "channel string, bin long, n long"), 2).count() == 0
    assert fits.tile_shifts(spark.createDataFrame([], "fixed long, moving long, axis int, shift double, weight double"), 0, 1.0, 9.0, 2, 0.1).count() == 0


EDGE = "fixed long, moving long, axis int, shift double, weight double"
TRUE = {0: 0.0, 1: 2.0, 2: -1.0, 3: 4.0}


def consistent():
    return [(a, b, 0, TRUE[b] - TRUE[a], 1.0) for a in TRUE for b in TRUE if a < b]


def test_tile_shifts_recover_positions(spark):
    found = fits.tile_shifts(spark.createDataFrame(consistent(), EDGE), 0, 5.0, 10.0, 40, 1e-4)
    assert {r["tile"]: pytest.approx(r["at"], abs=0.01) for r in found.collect()} == TRUE


def test_clamped_shifts(spark):
    found = dict(rows(fits.tile_shifts(spark.createDataFrame([(0, 1, 0, 50.0, 1.0)], EDGE), 0, 100.0, 3.0, 6), "tile", "at"))
    assert found == {0: 0.0, 1: 3.0}


def test_outlying_edges_are_left_out(spark):
    edges = consistent() + [(1, 3, 0, 90.0, 1.0)]
    found, kept = fits.shifts_without_outliers(spark.createDataFrame(edges, EDGE), 0, 2.0, 20.0, 30, 5.0)
    assert kept.count() == len(edges) - 1 and kept.where("shift = 90").isEmpty()
    assert {r["tile"]: pytest.approx(r["at"], abs=0.05) for r in found.collect()} == TRUE


def test_peel_matches_refitting(spark):
    rng = np.random.default_rng(3)
    x, y = np.arange(9), 3 * np.arange(9) + rng.normal(0, 0.1, 9)
    y[2] += 20
    left_out = []
    keep = list(range(9))
    for _ in range(4):
        off = []
        for i in keep:
            rest = [k for k in keep if k != i]
            off.append(abs(y[i] - np.polyval(np.polyfit(x[rest], y[rest], 1), x[i])))
        if max(off) <= 2:
            break
        left_out.append(keep.pop(int(np.argmax(off))))
    found = fits.peeled_lines(spark.createDataFrame([(1, int(a), float(b)) for a, b in zip(x, y)], "tile long, x long, y double"), 2.0, 4).first()
    assert left_out == [2] and (found["n"], found["left_out"]) == (8, 1)
    assert found["slope"] == pytest.approx(np.polyfit(x[keep], y[keep], 1)[0])


def test_little_support_peels_nothing(spark):
    points = [(1, 0, 0.0), (1, 1, 50.0), (1, 2, 0.0), (2, 4, 1.0)]
    assert rows(fits.peeled_lines(spark.createDataFrame(points, "tile long, x long, y double"), 1.0, 3), "tile", "n", "left_out") == [(1, 3, 0), (2, 1, 0)]


def test_threshold_lies_between_two_modes(spark):
    bins = [("a", b, 100) for b in (2, 3, 4, 40, 41, 42)] + [("one", 7, 5)]
    found = dict(rows(fits.entropy_thresholds(spark.createDataFrame(bins, "channel string, bin long, n long"), 20), "channel", "threshold"))
    assert 4.5 < found["a"] < 40 and found["one"] == 7.5


def test_minor_angle_is_across_the_long_side(spark):
    level = [(0, 0, x, 1, 1) for x in range(9)]
    steep = [(0, k, k, 2, 1) for k in range(9)]
    square = [(0, y, x, 3, 1) for y in range(2) for x in range(2)]
    found = {r["label"]: r["angle"] for r in fits.minor_angles(spark.createDataFrame(level + steep + square, "z int, y int, x int, label long, v long")).collect()}
    assert found[1] == pytest.approx(math.pi / 2) and found[2] == pytest.approx(-math.pi / 4) and found[3] is None


def test_geodesics_take_the_shorter_way_round(spark):
    links = spark.createDataFrame([(0, 1, 9), (0, 2, 1), (2, 3, 1), (3, 1, 1), (1, 4, 2), (4, 5, 9), (0, 0, 0)], "a long, b long, length long")
    found = fits.geodesics(links, spark.createDataFrame([(0,), (0,)], "node long"), 6)
    assert rows(found, "source", "node", "distance") == [(0, 0, 0), (0, 1, 3), (0, 2, 1), (0, 3, 2), (0, 4, 5)]


def test_smoothing_ignores_other_tracks_and_far_points(spark):
    points = [("a", 1, 0, 1.0, 1.0), ("a", 2, 5, 3.0, 1.0), ("a", 3, 500, 9.0, 1.0), ("b", 1, 0, 7.0, 0.0)]
    found = {(t, k): dz for t, k, dz in rows(fits.smoothed(spark.createDataFrame(points, "track string, tile long, at long, dz double, score double"), 5), "track", "tile", "dz")}
    w = math.exp(-0.5)
    assert found[("a", 3)] == 9.0 and found[("b", 1)] == 7.0 and found[("a", 1)] == pytest.approx((1 + 3 * w) / (1 + w))


def test_largest_face_component_at_a_tie(spark):
    faces = spark.createDataFrame([(5, 6, 7), (6, 7, 8), (1, 2, 3), (2, 3, 4), (20, 21, 22), (9, 9, 1)], "v0 long, v1 long, v2 long")
    assert rows(graphs.largest_face_component(faces), "v0", "v1", "v2") == [(1, 2, 3), (2, 3, 4)]
