"""Constraint graphs: components, rejection reasons, pair summaries, set comparisons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.operators.joins import hot_left_join

ROUNDS = 60
#: Edges whose components are found in one task.
EDGES = 500_000


def _found(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of edges and the least node of each one's component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(i):
        np.minimum.at(root, root[i], root[j])
        np.minimum.at(root, root[j], root[i])
        while not np.array_equal(root, root[root]):
            root = root[root]
        apart = root[i] != root[j]
        i, j = root[i[apart]], root[j[apart]]
    return nodes, nodes[root]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if held:
        a, b = (np.concatenate([batch.column(c).to_numpy() for batch in held]) for c in ("u", "v"))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _found(a, b)], names=["node", "root"])


def components(edges: DataFrame, name: str = "parts") -> DataFrame:
    """(node, root) for each node of edges (a, b), whole numbers: root is the least node that links reach. Null ends and loops are left out.

    Edges are dealt by ranges to parts of about EDGES, and each finds its own components. A node in several parts links
    their roots there, and these links, mostly few, make a graph in turn; where they are many, it is contracted by
    stars. A node has a row a part at most, and no task holds more than a part.
    """
    near = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    held = cut(near.select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v")), name)
    total = held.count()
    many = max(1, -(-total // EDGES))
    if many == 1:  # coalesced, as a session may deal more ranges than are asked for
        return cut(held.coalesce(1).mapInArrow(_within, "node long, root long"), name)
    local = cut(held.repartitionByRange(many, "v", "u").mapInArrow(_within, "node long, root long"), name)
    order = W.partitionBy("node").orderBy("root")
    placed = cut(local.select("node", "root", F.first("root").over(order).alias("least"), F.row_number().over(order).alias("k")), name)
    links = cut(placed.where("root <> least").select(F.col("root").alias("a"), F.col("least").alias("b")).distinct(), name)
    roots = (components if links.count() * 2 <= total else star_components)(links, name).withColumnRenamed("node", "least")
    own = placed.where("k = 1").select("node", "least")
    # Nodes of large components share their part's root.
    named = own.groupBy("least").agg(F.count("*").alias("n")).join(roots, "least", "left")
    return hot_left_join(own, named, "least", "node", 2 * total).select("node", F.coalesce("root", "least").alias("root"))


def star_components(edges: DataFrame, name: str = "star") -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the least node that links reach. Null ends and loops are left out.

    Alternating star contractions: each round points every node's larger neighbours to the least neighbour (large
    star), then every node and its smaller neighbours to the least one (small star), so the number of rounds grows with
    the logarithm of the nodes. A node's neighbours are only aggregated to their minimum, and the minima of nodes with
    many neighbours are broadcast to them: no task holds a node.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    now = cut(now, name)
    total, before = now.count(), None
    for _ in range(ROUNDS):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = hot_left_join(both, least, "u", "v", 2 * total).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        ends = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = hot_left_join(large, down, "u", "v", 2 * total).select(F.explode(ends).alias("e"))
        now = cut(small.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), name)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        total, before = state[0], state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def pair_summary(edges: DataFrame) -> DataFrame:
    """Accepted and rejected counts of each pair of tiles, and the accepted shifts' mean, median, population deviation, least, most and range."""
    kept = F.when(F.col("accepted"), F.col("shift"))
    return edges.groupBy("fixed", "moving").agg(
        F.sum(F.col("accepted").cast("long")).alias("accepted"),
        F.sum((~F.col("accepted")).cast("long")).alias("rejected"),
        (F.sum(kept) / F.count(kept)).alias("mean"),
        F.median(kept).alias("median"),
        F.round(F.stddev_pop(kept), 9).alias("deviation"),
        F.min(kept).alias("least"),
        F.max(kept).alias("most"),
        (F.max(kept) - F.min(kept)).alias("span"),
    )


def reason_counts(edges: DataFrame) -> DataFrame:
    """Rows by axis and the first gate that failed (accepted: none did)."""
    return edges.groupBy("axis", F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


def all_reasons(edges: DataFrame) -> DataFrame:
    """Rows by the list of all gates that failed."""
    gates = F.array_compact(F.array(F.when(F.col("score") < 2, "low_score"), F.when(F.abs("shift") > 20, "large_shift"), F.when(F.col("fixed") == F.col("moving"), "same_tile")))
    return edges.groupBy(F.array_join(gates, "+").alias("reasons")).agg(F.count("*").alias("n"))


def edge_constraints(edges: DataFrame) -> DataFrame:
    """For each pair and axis the median accepted shift, how many there are, and their weight by score."""
    return edges.where("accepted").groupBy("fixed", "moving", "axis").agg(F.median("shift").alias("shift"), F.count("*").alias("n"), F.sum("score").alias("weight"))


def dropped_edges(measured: DataFrame, used: DataFrame) -> DataFrame:
    """Pairs that were measured and not used."""
    return measured.select("fixed", "moving").distinct().join(used.select("fixed", "moving").distinct(), ["fixed", "moving"], "left_anti")


def degrees(edges: DataFrame) -> DataFrame:
    """(tile, degree): distinct other tiles that accepted edges reach."""
    both = edges.where("accepted").select(F.col("fixed").alias("tile"), F.col("moving").alias("other")).union(edges.where("accepted").select("moving", "fixed"))
    return both.where(F.col("tile") != F.col("other")).distinct().groupBy("tile").agg(F.count("*").alias("degree"))


def with_overrides(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """edges with (fixed, moving, accept) laid over the measured decision."""
    return edges.join(overrides, ["fixed", "moving"], "left").withColumn("accepted", F.coalesce("accept", "accepted")).drop("accept")


def depths(edges: DataFrame, anchor: int, most: int = 10 * ROUNDS, within: int | None = None) -> DataFrame:
    """(node, depth): tiles that accepted edges reach from the anchor, by the fewest edges; with `within`, those at most so many edges away.

    One round a depth: the frontier's neighbours that are not yet known. More than `most` rounds are an error.
    """
    kept = edges.where("accepted")
    links = cut(kept.select("fixed", "moving").union(kept.select("moving", "fixed")).distinct())
    spark = edges.sparkSession
    known = frontier = spark.range(1).select(F.lit(anchor).cast("long").alias("node"), F.lit(0).alias("depth"))
    for depth in range(1, most):
        if within is not None and depth > within:
            return known
        near = links.join(frontier, links["fixed"] == frontier["node"]).select(F.col("moving").alias("node")).distinct()
        frontier = cut(near.join(known.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return known
        known = cut(known.union(frontier))
    raise RuntimeError(f"tiles lie {most} edges or more from the anchor")


def anchors(edges: DataFrame) -> DataFrame:
    """(axis, tile, weight): the tile with the greatest sum of accepted scores along each axis, the least at ties."""
    kept = edges.where("accepted")
    both = kept.select("axis", F.col("fixed").alias("tile"), "score").union(kept.select("axis", "moving", "score"))
    sums = both.groupBy("axis", "tile").agg(F.sum("score").alias("weight"))
    return sums.groupBy("axis").agg(F.max(F.struct("weight", (-F.col("tile")).alias("k"))).alias("m")).select("axis", (-F.col("m.k")).alias("tile"), "m.weight")


def tree_parents(edges: DataFrame, anchor: int, within: int | None = None) -> DataFrame:
    """(node, parent): a spanning tree of the tiles that depths() finds; the parent is the least tile one edge nearer to the anchor."""
    kept = edges.where("accepted")
    links = kept.select(F.col("fixed").alias("node"), F.col("moving").alias("parent")).union(kept.select("moving", "fixed"))
    found = depths(edges, anchor, within=within)
    near = found.select(F.col("node").alias("parent"), (F.col("depth") + 1).alias("depth"))
    return links.join(found, "node").join(near, ["parent", "depth"]).groupBy("node").agg(F.min("parent").alias("parent"))


def largest_face_component(faces: DataFrame) -> DataFrame:
    """The faces (v0, v1, v2) of the component with the most faces, of the least vertex at ties; faces that repeat a vertex go."""
    kept = faces.where((F.col("v0") != F.col("v1")) & (F.col("v1") != F.col("v2")) & (F.col("v0") != F.col("v2")))
    found = components(kept.select(F.col("v0").alias("a"), F.col("v1").alias("b")).union(kept.select("v1", "v2")))
    named = kept.join(found, kept["v0"] == found["node"]).drop("node")
    best = named.groupBy("root").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "root").limit(1)
    return named.join(best.select("root"), "root", "left_semi").select(*faces.columns)
