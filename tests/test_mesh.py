"""Nearest triangles: what the descent shuffles, and meshes on both sides of 0."""

import random

import pytest

from chunkloom.operators import mesh
from chunkloom.operators.joins import among
from chunkloom.operators.mesh import AXES, CORNERS, closest_triangles, sides

POINT, SHAPE = "id long, px double, py double, pz double", "face long, " + ", ".join(f"{c}{k} double" for c in CORNERS for k in AXES)


def made(n):
    rnd = random.Random(n)
    shapes = []
    for face in range(n):
        place = [rnd.randrange(-200, 200) for _ in AXES]
        shapes.append((face, *[float(p + rnd.randrange(9)) for _ in CORNERS for p in place]))
    return shapes, [(i, *[float(rnd.randrange(-400, 400)) for _ in AXES]) for i in range(60)]


def test_boxes_of_cells_stay_where_they_are(spark):
    """A point's rows meet with the numbers of cells alone: the cells' children are in no exchange but the broadcasts."""
    shapes, points = made(300)
    found = closest_triangles(spark.createDataFrame(points, POINT), spark.createDataFrame(shapes, SHAPE), 12.0)
    left, inputs = [found._jdf.queryExecution().optimizedPlan()], []
    while left:
        node = left.pop()
        if node.nodeName() == "Window":
            inputs.append(node.child().output().toString())
        left += [node.children().apply(k) for k in range(node.children().size())]
    assert inputs and not any("children" in columns for columns in inputs)


def test_vertices_bound_the_distance(spark):
    shapes, points = made(300)
    found = {r["id"]: r for r in closest_triangles(spark.createDataFrame(points, POINT), spark.createDataFrame(shapes, SHAPE), 12.0).collect()}
    assert set(found) == {p[0] for p in points}
    for i, *p in points:
        corners = min(sum((p[k] - s[1 + 3 * c + k]) ** 2 for k in range(3)) for s in shapes for c in range(3))
        assert found[i]["d2"] <= corners
        s = shapes[found[i]["face"]]
        at = [sum(found[i][f"b{c}"] * s[1 + 3 * c + k] for c in range(3)) for k in range(3)]
        assert sum((a - b) ** 2 for a, b in zip(p, at)) == pytest.approx(found[i]["d2"])


def least(points, shapes):
    """(squared distance to the nearest vertex, least face at ties) for each point; for shapes whose three corners are one place."""
    return {i: min((sum((p[k] - s[1 + k]) ** 2 for k in range(3)), s[0]) for s in shapes) for i, *p in points}


@pytest.mark.parametrize("span, chunk, pairs", [(65_536, 32_768, 65_536), (20, 7, 30)])
def test_blocks_chunks_and_slices_give_the_same(spark, monkeypatch, span, chunk, pairs):
    """Points far from a mesh, that all meet its one end, are dealt to many tasks, and find what brute force finds."""
    monkeypatch.setattr(mesh, "SPAN", span)
    monkeypatch.setattr(mesh, "CHUNK", chunk)
    monkeypatch.setattr(mesh, "PAIRS", pairs)
    rnd = random.Random(span)
    spots = [tuple(float(rnd.randrange(-60, 60)) for _ in AXES) for _ in range(150)]
    shapes = [(face, *spot, *spot, *spot) for face, spot in enumerate(spots * 2)]
    shapes += [(1000, *[float("nan")] * 9), (1001, *[None] * 9), (1002, float("inf"), *[0.0] * 8)]
    points = [(i, *[float(rnd.randrange(-90, 90)) for _ in AXES]) for i in range(40)] + [(100 + i, 3.0, 1e6 + i, 2.0) for i in range(40)]
    points += [(500, 0.0, None, 0.0), (501, float("nan"), 0.0, 0.0)]
    frame = spark.createDataFrame(points, POINT)
    found = closest_triangles(frame, spark.createDataFrame(shapes, SHAPE), 12.0)
    assert {r["id"]: (r["d2"], r["face"]) for r in found.collect()} == least(points[:-2], shapes[:-3])
    assert closest_triangles(frame, spark.createDataFrame([], SHAPE), 12.0).collect() == []


def test_points_at_one_end_of_a_mesh_take_many_tasks(spark, monkeypatch):
    """No task holds all points that meet one block, and no point's rows hold triangles."""
    monkeypatch.setattr(mesh, "CHUNK", 50)
    solved = mesh._solved
    counts = spark.sparkContext.accumulator(0)

    def counted(own, kept):
        run = solved(own, kept)

        def counting(points, block):
            assert points.num_rows <= 100
            counts.add(1)
            return run(points, block)

        return counting

    monkeypatch.setattr(mesh, "_solved", counted)
    shapes, _ = made(300)
    points = [(i, float(i % 400), 1e6 + i, 0.0) for i in range(1000)]
    found = closest_triangles(spark.createDataFrame(points, POINT), spark.createDataFrame(shapes, SHAPE), 12.0)
    assert found.count() == 1000 and counts.value >= 15


@pytest.mark.parametrize("bits", [1 << 26, 1 << 18])
def test_rows_among_keys(spark, monkeypatch, bits):
    from chunkloom.operators import joins

    monkeypatch.setattr(joins, "BITS", bits)
    rnd = random.Random(3)
    keys = sorted({rnd.randrange(-(1 << 40), 1 << 40) for _ in range(300)} | {0, 1, 32_767, 32_768, bits - 1, bits})
    rows = [(k, -7, i) for i, k in enumerate(keys)] + [(-7, k, i) for i, k in enumerate(keys)] + [(None, -7, -7), (None, keys[0], None)]
    others = [(rnd.randrange(1 << 41, 1 << 42), -7, -7) for _ in range(2000)]
    found = {tuple(r) for r in among(spark.createDataFrame(rows + others, "a long, b long, c int").repartition(3), spark.createDataFrame([(k,) for k in keys], "k long")).collect()}
    assert found >= set(rows) - {(None, -7, -7)} and (None, -7, -7) not in found
    assert len(found & set(others)) < 2000 * 2 * len(keys) / bits * 2 + 10


def test_rims_are_those_of_the_whole_mesh(spark):
    """A tetrahedron has no rim, an open sheet has one; equal faces count once."""
    spots = {0: (0, 0, 0), 1: (10, 0, 0), 2: (0, 10, 0), 3: (0, 0, 10), 4: (100, 0, 0), 5: (110, 0, 0), 6: (100, 10, 0), 7: (110, 10, 0)}
    corners = [(0, 2, 1), (0, 1, 3), (0, 3, 2), (1, 2, 3), (4, 5, 6), (5, 7, 6), (4, 5, 6)]
    faces = spark.createDataFrame([(f, *c, *[float(x) for v in c for x in spots[v]]) for f, c in enumerate(corners)], "face long, v0 long, v1 long, v2 long, " + SHAPE.split(", ", 1)[1])
    points = [(0, 5.0, -1.0, -1.0), (1, -1.0, -1.0, -1.0), (2, 2.0, 2.0, 1.0), (3, 105.0, -3.0, 0.0), (4, 105.0, 5.0, -1.0), (5, 113.0, 14.0, 0.0), (6, 102.0, 2.0, -1.0)]
    found = closest_triangles(spark.createDataFrame(points, POINT), faces, 12.0, ("px", "py", "pz", "v0", "v1", "v2", *mesh.PLACED))
    rows = {r["id"]: (r["rim"], r["inside"]) for r in sides(found, faces, 25.0).collect()}
    assert rows == {0: (False, False), 1: (False, False), 2: (False, True), 3: (True, False), 4: (False, True), 5: (True, False), 6: (False, True)}
