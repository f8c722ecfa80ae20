"""Nearest triangles of a mesh.

Triangles are numbered along a curve through the grid cells of their centres, and dealt by ranges of it to blocks of
about SPAN. A block is one row: its triangles in that order, its box, and some of its vertices. Points meet the blocks
whose box is no farther than the nearest of all blocks' vertices, and a task takes CHUNK points and one block, however
many points meet it. There a tree of boxes over the triangles, WIDE to a node, is descended: the nearest triangle that
a greedy walk finds bounds the distance, and what lies farther goes unopened. No triangle is copied for a point, and
the driver sees the boxes and vertices of blocks alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chunkloom.functions.scratch import cut
from chunkloom.operators.joins import among
from chunkloom.operators.measures import mesh_boundary

AXES = ("x", "y", "z")
CORNERS = ("a", "b", "c")
PLACED = [f"{c}{k}" for c in CORNERS for k in AXES]
#: Triangles of a block, and points of a task.
SPAN, CHUNK = 65_536, 32_768
#: Children of a node; points that descend together; pairs of points and nodes that are looked at together.
WIDE, STEP, PAIRS = 8, 2048, 65_536
#: Vertices of a block that bound distances, besides the outermost ones.
SPREAD = 58
#: Room for the rounding of distances, of the distance and of a block's longest edge, squared.
ROOM, LEAST_ROOM = 1 + 1e-9, 1e-12
FEATURES = pa.array(["edge", "face", "vertex"])


def _dot(u, v):
    return u[0] * v[0] + u[1] * v[1] + u[2] * v[2]


def _minus(u, v):
    return [p - q for p, q in zip(u, v)]


def _at(name: str) -> list[Column]:
    return [F.col(f"{name}{k}") for k in AXES]


def _places(p: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, int, Callable]]:
    """(squared distance, number of the feature, barycentric weights) of what a triangle can have next to a point: its face, edges and vertices; infinite where there is no such place.

    At whole-number coordinates the distance to a shared edge or vertex comes out the same from each of its triangles.
    A triangle without an area has no face.
    """
    corners = at[:3], at[3:6], at[6:]
    a, b, c = corners
    u, v, w = _minus(b, a), _minus(c, a), _minus(p, a)
    uu, uv, vv, wu, wv = _dot(u, u), _dot(u, v), _dot(v, v), _dot(w, u), _dot(w, v)
    area = uu * vv - uv * uv
    s, t = vv * wu - uv * wv, uu * wv - uv * wu
    height = _dot([u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]], w)
    yield np.where((s > 0) & (t > 0) & (area - s - t > 0), height * height / area, np.inf), 1, lambda: ((area - s - t) / area, s / area, t / area)
    zero, one = np.zeros(len(s)), np.ones(len(s))
    for i, j in ((0, 1), (1, 2), (2, 0)):
        edge, off = _minus(corners[j], corners[i]), _minus(p, corners[i])
        length, along = _dot(edge, edge), _dot(edge, off)
        apart = np.where((along > 0) & (along < length), (_dot(off, off) * length - along * along) / length, np.inf)
        yield apart, 0, lambda i=i, j=j, length=length, along=along: [(length - along) / length if k == i else along / length if k == j else zero for k in range(3)]
    for i in range(3):
        off = _minus(p, corners[i])
        yield _dot(off, off), 2, lambda i=i: [one if k == i else zero for k in range(3)]


def _nearest_places(p: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The least of _places() by squared distance, then feature, then weights."""
    found = None
    for d2, feature, weights in _places(p, at):
        new = [d2, np.full(len(d2), feature), *weights()]
        if found is None:
            found = new
            continue
        less, same = np.zeros(len(d2), bool), np.ones(len(d2), bool)
        for x, y in zip(new, found):
            less |= same & (x < y)
            same &= x == y
        found = [np.where(less, x, y) for x, y in zip(new, found)]
    return found


def _levels(low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Boxes of a tree over boxes (3, n) in order, from these on up to a single one."""
    levels = [(low, high)]
    while levels[-1][0].shape[1] > 1:
        low, high = levels[-1]
        first = np.arange(0, low.shape[1], WIDE)
        levels.append((np.minimum.reduceat(low, first, axis=1), np.maximum.reduceat(high, first, axis=1)))
    return levels


def _apart(low: np.ndarray, high: np.ndarray, p: np.ndarray) -> np.ndarray:
    off = np.maximum(np.maximum(low - p, p - high), 0.0)
    return _dot(off, off)


def _descended(levels: list, p: np.ndarray, bound: np.ndarray, visit: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """visit(points, leaves) for all pairs within the squared distances of bound, which it may lower; pairs come by point and may repeat."""

    def apart(level: int, i: np.ndarray, node: np.ndarray) -> np.ndarray:
        low, high = levels[level]
        return _apart(low.take(node, axis=1), high.take(node, axis=1), p.take(i, axis=1))

    def opened(level: int, i: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        child = (node[:, None] * WIDE + np.arange(WIDE)).ravel()
        there = child < levels[level - 1][0].shape[1]
        return np.repeat(i, WIDE)[there], child[there]

    top, every = len(levels) - 1, np.arange(p.shape[1])
    node = np.zeros(len(every), np.int64)
    for level in range(top, 1, -1):
        child = np.minimum(node[:, None] * WIDE + np.arange(WIDE), levels[level - 1][0].shape[1] - 1)
        d = apart(level - 1, np.repeat(every, WIDE), child.ravel()).reshape(child.shape)
        node = child[every, d.argmin(axis=1)]
    visit(*(opened(1, every, node) if top else (every, node)))
    left = [(top, every, np.zeros(len(every), np.int64))]
    while left:
        level, i, node = left.pop()
        if len(i) > PAIRS:
            left += [(level, i[k : k + PAIRS], node[k : k + PAIRS]) for k in range(0, len(i), PAIRS)]
            continue
        near = apart(level, i, node) <= bound[i]
        i, node = i[near], node[near]
        if not len(i):
            continue
        if level:
            left.append((level - 1, *opened(level, i, node)))
        else:
            visit(i, node)


def _firsts(i: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's row."""
    rows = list(batches)
    if not sum(b.num_rows for b in rows):
        return
    held = pa.Table.from_batches(rows).sort_by("key")
    part, held = held["part"][0].as_py(), held.drop_columns(["part", "key"]).combine_chunks()
    vertices = np.stack([held[n].to_numpy() for n in PLACED]).reshape(3, 3, -1).transpose(1, 2, 0).reshape(3, -1)
    spread = np.linspace(0, vertices.shape[1] - 1, SPREAD).astype(np.int64)
    some = vertices[:, np.concatenate([vertices.argmin(axis=1), vertices.argmax(axis=1), spread])]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(held)
    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([some.tobytes()], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["part", "some", "data"])


def _met(blocks: list[tuple[int, bytes]]):
    """Points with the blocks that can hold their nearest triangle, and the squared distance that it has at most."""
    parts = np.array([part for part, _ in blocks])
    some = np.stack([np.frombuffer(data).reshape(3, -1) for _, data in blocks], 1)
    levels = _levels(some.min(axis=2), some.max(axis=2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, STEP):
                rows = batch.slice(first, STEP)
                p = np.stack([rows.column(f"p{k}").to_numpy(zero_copy_only=False) for k in AXES])
                bound, pairs = np.full(p.shape[1], np.inf), []

                def visit(i: np.ndarray, block: np.ndarray) -> None:
                    for k in range(0, len(i), STEP):
                        own = i[k : k + STEP]
                        off = some[:, block[k : k + STEP]] - p[:, own, None]
                        at, reach = _firsts(own), _dot(off, off).min(axis=1) * ROOM
                        bound[own[at]] = np.minimum(bound[own[at]], np.minimum.reduceat(reach, at))
                    pairs.append((i, block))

                _descended(levels, p, bound, visit)
                i, block = (np.concatenate(c) for c in zip(*pairs))
                i, block = np.divmod(np.unique(i * len(parts) + block), len(parts))
                near = _apart(*(side.take(block, axis=1) for side in levels[0]), p.take(i, axis=1)) <= bound[i]
                i, block = i[near], block[near]
                found = rows.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([*found.columns, pa.array(bound[i]), pa.array(parts[block])], names=[*found.schema.names, "bound", "part"])

    return run


def _solved(own: list[str], kept: list[str]):
    """The nearest of a block's triangles for points that meet it."""

    def run(points: pa.Table, block: pa.Table) -> pa.Table:
        held = pa.ipc.open_stream(block["data"][0].as_py()).read_all().combine_chunks()
        at = np.stack([held[n].to_numpy() for n in PLACED])
        corners = at.reshape(3, 3, -1)
        levels = _levels(corners.min(axis=0), corners.max(axis=0))
        room = LEAST_ROOM * max(float(_dot(e, e).max()) for e in (corners[1] - corners[0], corners[2] - corners[1], corners[0] - corners[2]))
        order = pc.sort_indices(held["face"]).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        every = np.stack([points[f"p{k}"].to_numpy() for k in AXES])
        best, first = np.full(every.shape[1], np.inf), np.full(every.shape[1], len(order))
        for k in range(0, every.shape[1], STEP):
            p, bound, near, least = every[:, k : k + STEP], points["bound"].to_numpy()[k : k + STEP] * ROOM, best[k : k + STEP], first[k : k + STEP]

            def visit(i: np.ndarray, t: np.ndarray) -> None:
                # The vertices are soon looked at, and leave few triangles.
                q, corners = p.take(i, axis=1), at.take(t, axis=1)
                offs, start = [_minus(q, corners[j : j + 3]) for j in (0, 3, 6)], _firsts(i)
                reach = np.fmin.reduceat(reduce(np.fmin, (_dot(off, off) for off in offs)), start)
                bound[i[start]] = np.minimum(bound[i[start]], reach * ROOM + room)
                near_by = np.flatnonzero(_apart(*(side.take(t, axis=1) for side in levels[0]), q) <= bound[i])
                i, t = i[near_by], t[near_by]
                if not len(i):
                    return
                d2 = reduce(np.fmin, (place[0] for place in _places(q.take(near_by, axis=1), corners.take(near_by, axis=1))))
                start = _firsts(i)
                low = np.fmin.reduceat(d2, start)
                tied = np.where(d2 == np.repeat(low, np.diff(start, append=len(i))), rank[t], len(rank))
                who, low_rank = i[start], np.minimum.reduceat(tied, start)
                better = (low < near[who]) | ((low == near[who]) & (low_rank < least[who]))
                who = who[better]
                near[who], least[who] = low[better], low_rank[better]
                bound[who] = np.minimum(bound[who], near[who] * ROOM + room)

            with np.errstate(all="ignore"):
                _descended(levels, p, bound, visit)
        there = np.flatnonzero(np.isfinite(best))
        face = order[first[there]]
        with np.errstate(all="ignore"):
            d2, feature, *weights = _nearest_places(every.take(there, axis=1), at.take(face, axis=1))
        rows, taken = points.select(own).take(pa.array(there)), held.select(kept).take(pa.array(face))
        columns = {**{c: rows[c] for c in rows.column_names}, **{c: taken[c] for c in kept}, "d2": d2, "feature": FEATURES.take(pa.array(feature)), **{f"b{j}": w for j, w in enumerate(weights)}}
        return pa.table(columns)

    return run


def _spread(c: Column) -> Column:
    """21 bits, with two zeros after each."""
    for shift, mask in ((32, 0x1F00000000FFFF), (16, 0x1F0000FF0000FF), (8, 0x100F00F00F00F00F), (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def closest_triangles(points: DataFrame, triangles: DataFrame, cell: float, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, face, d2, feature, b0, b1, b2, and columns keep of the point or the triangle) of points (id, px, py, pz): the nearest of triangles (face, ax, ay, az, bx, ... cz), the least face at ties.

    cell: the edge of the finest cells; triangles of one have no order among them. Rows with null or non-finite
    coordinates take no part; equal triangles count once, by their least face. Points may repeat, also their ids. No
    triangles: no rows. Triangles are read three times, so what is costly is better written before.
    """
    usable = lambda columns: reduce(Column.__and__, [F.abs(F.col(c).cast("double")) < float("inf") for c in columns])  # noqa: E731  (not a number is above infinity)
    places = [f"p{k}" for k in AXES]
    kept = ["face", *(c for c in keep if c not in places)]
    shapes = triangles.where(usable(PLACED)).select(*[c for c in kept if c not in PLACED], *[F.col(n).cast("double").alias(n) for n in PLACED])
    ends = [f(f"a{k}").alias(f"{e}{k}") for k in AXES for e, f in (("lo", F.min), ("hi", F.max))]
    whole = shapes.agg(F.count("*").alias("n"), *ends).first()
    own = points.where(usable(places)).select(F.monotonically_increasing_id().alias("n"), "id", *[F.col(c).cast("double").alias(c) for c in places])
    known = ["n", "id", *(c for c in keep if c in places)]
    types = {f.name: f for f in [*own.schema.fields, *shapes.schema.fields]}
    result = StructType([types[c] for c in (*known, *kept)]).add("d2", "double").add("feature", "string").add("b0", "double").add("b1", "double").add("b2", "double")
    columns = ["id", "face", "d2", "feature", "b0", "b1", "b2", *keep]
    if not whole["n"]:
        return points.sparkSession.createDataFrame([], result).select(*columns)
    # Numbers that don't fit 21 bits only put cells next to others.
    size = max(cell, max(whole[f"hi{k}"] - whole[f"lo{k}"] for k in AXES) / (1 << 20))
    corner = {k: [F.col(f"{c}{k}") for c in CORNERS] for k in AXES}
    place = [_spread(F.floor(((F.least(*corner[k]) + F.greatest(*corner[k])) / 2 - whole[f"lo{k}"]) / size).cast("long").bitwiseAND((1 << 21) - 1)) for k in AXES]
    key = place[0].bitwiseOR(F.shiftleft(place[1], 1)).bitwiseOR(F.shiftleft(place[2], 2))
    dealt = shapes.withColumn("key", key).repartitionByRange(-(-whole["n"] // SPAN), "key", "face").withColumn("part", F.spark_partition_id().cast("long"))
    blocks = cut(dealt.mapInArrow(_packed, "part long, some binary, data binary"))
    boxes = sorted((r["part"], bytes(r["some"])) for r in blocks.select("part", "some").collect())
    pairs = cut(own.mapInArrow(_met(boxes), StructType(own.schema.fields[:]).add("bound", "double").add("part", "long")))
    many = pairs.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).cast("long").alias("chunks"))
    many = points.sparkSession.createDataFrame(many.collect(), many.schema)  # a row a block
    near = pairs.join(F.broadcast(many), "part").withColumn("chunk", F.pmod(F.xxhash64("n"), "chunks"))
    held = blocks.select("part", "data").join(F.broadcast(many), "part").select("part", "data", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    found = near.groupBy("part", "chunk").cogroup(held.groupBy("part", "chunk")).applyInArrow(_solved(known, kept), result)
    # A row a block that a point meets.
    order = W.partitionBy("n").orderBy("d2", F.col("face").asc_nulls_last())
    return found.withColumn("turn", F.row_number().over(order)).where("turn = 1").select(*columns)


def sides(found: DataFrame, faces: DataFrame, most: float) -> DataFrame:
    """(id, depth, rim, inside) for the nearest places of closest_triangles(): whether points lie within `most` under a surface.

    found keeps px, py, pz and v0, v1, v2, ax, ... cz; triangles have an outward normal by the order of their corners.
    Edges that one of faces (v0, v1, v2) uses are rims, equal faces counting once, and a place on such an edge, or at
    one of its vertices, is on the rim and not inside. Only faces at vertices that bear such places are counted.
    """
    ends = F.transform(F.filter(F.array(*[F.struct(F.col(f"b{k}").alias("b"), F.col(f"v{k}").alias("v")) for k in range(3)]), lambda c: c["b"] > 0), lambda c: c["v"])
    known = cut(found.withColumns({"e0": F.array_min(ends), "e1": F.array_max(ends)}))
    borne = known.where("feature <> 'face'").select(F.explode(F.array("e0", "e1")).alias("vertex"))
    rims = cut(mesh_boundary(among(faces.select("v0", "v1", "v2"), borne).distinct()))
    edges = rims.select(F.least("a", "b").alias("e0"), F.greatest("a", "b").alias("e1"), F.lit(True).alias("edge"))
    corners = rims.select(F.explode(F.array("a", "b")).alias("e0")).distinct().withColumn("corner", F.lit(True))
    known = known.join(edges, ["e0", "e1"], "left").join(corners, "e0", "left")
    rim = F.when(F.col("feature") == "edge", F.col("edge").isNotNull()).when(F.col("feature") == "vertex", F.col("corner").isNotNull()).otherwise(False)
    u, v, w = _minus(_at("b"), _at("a")), _minus(_at("c"), _at("a")), _minus(_at("p"), _at("a"))
    normal = [u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]]
    # The place lies in the triangle's plane, so any corner gives the same height.
    under = _dot(normal, w) <= 0
    return known.select("id", F.sqrt("d2").alias("depth"), rim.alias("rim"), (under & ~rim & (F.sqrt("d2") <= most)).alias("inside"))
