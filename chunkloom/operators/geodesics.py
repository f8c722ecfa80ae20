"""Distances along links within a radius, from every source.

Sources are dealt to blocks in order of their nodes. Rounds over (block, node) find what lies within the radius of a
block's sources taken together; then each block gets the links around it and finds the distances from its own sources.
So what is shuffled grows with the nodes around blocks, and no row of the result, which has one for each source and
node near it, goes through a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.operators.joins import shuffled
from chunkloom.operators.ranges import numbered

#: Sources of a block, sources solved at once in it, and steps along links that they take at once, if they are several.
SOURCES, TOGETHER, STEPS = 4096, 512, 2_000_000


def _least(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with its least value."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys[first], values[first]


def _reached(sources: np.ndarray, start: np.ndarray, to: np.ndarray, length: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Keys (number of the source times the nodes, plus the node) and distances of what sources reach; None where several sources take too many steps at once."""
    n = len(start) - 1
    known, distance = np.arange(len(sources)) * n + sources, np.zeros(len(sources), length.dtype)
    front, at = known, distance
    while len(front):
        node = front % n
        many = start[node + 1] - start[node]
        total = int(many.sum())
        if total > STEPS and len(sources) > 1:
            return None
        link = np.repeat(start[node] - (np.cumsum(many) - many), many) + np.arange(total)
        ahead = np.repeat(at, many) + length[link]
        near = ahead <= radius
        front, at = _least((np.repeat(front - node, many) + to[link])[near], ahead[near])
        place = np.minimum(np.searchsorted(known, front), len(known) - 1)
        met = known[place] == front
        nearer = met & (at < distance[place])
        distance[place[nearer]] = at[nearer]
        new = ~met
        known, distance = np.concatenate([known, front[new]]), np.concatenate([distance, at[new]])
        order = np.argsort(known, kind="stable")
        known, distance = known[order], distance[order]
        front, at = front[new | nearer], at[new | nearer]
    return known, distance


def _solve(radius: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's links (a, b, length), and its sources: those have no length."""
        held = pa.Table.from_batches(list(batches))
        own = held["length"].is_null().to_numpy()
        a, b, length = held["a"].to_numpy(), held["b"].to_numpy(), held["length"].filter(pa.array(~own)).to_numpy()
        nodes, place = np.unique(np.concatenate([a, b[~own]]), return_inverse=True)
        sources, ends = np.sort(place[: len(a)][own]), place[: len(a)][~own]
        order = np.argsort(ends, kind="stable")
        start, to, length = np.searchsorted(ends[order], np.arange(len(nodes) + 1)), place[len(a) :][order], length[order]
        groups = [sources[i : i + TOGETHER] for i in range(0, len(sources), TOGETHER)]
        while groups:
            group = groups.pop()
            found = _reached(group, start, to, length, radius)
            if found is None:
                groups += [group[: len(group) // 2], group[len(group) // 2 :]]
            else:
                key, distance = found
                yield pa.RecordBatch.from_arrays([pa.array(nodes[group[key // len(nodes)]]), pa.array(nodes[key % len(nodes)]), pa.array(distance)], names=["source", "node", "distance"])

    return solve


def geodesics(links: DataFrame, sources: DataFrame, radius: int) -> DataFrame:
    """(source, node, distance): nodes that links (a, b, length) reach from each source within the radius.

    Nodes are whole numbers, and lengths have to be positive.
    """
    kind = "double" if links.schema["length"].dataType.typeName() in ("double", "float", "decimal") else "long"
    near = links.where((F.col("a") != F.col("b")) & (F.col("length") <= radius)).select(*[F.col(c).cast("long").alias(c) for c in "ab"], F.col("length").cast(kind).alias("length"))
    both = cut(near.union(near.select("b", "a", "length")).groupBy("a", "b").agg(F.min("length").alias("length")))
    total = both.count()
    own = numbered(sources.select(F.lit(0).alias("one"), F.col("node").cast("long").alias("node")).where("node is not null").distinct(), "one", "node")
    own = cut(own.select(F.floor((F.col("number") - 1) / SOURCES).alias("block"), "node"))
    known = front = own.withColumn("distance", F.lit(0).cast(kind))
    while True:
        # Only nodes whose distance from the block fell in the round before are gone on from.
        ahead = front.join(shuffled(both, total), F.col("node") == F.col("a")).select("block", F.col("b").alias("node"), (F.col("distance") + F.col("length")).alias("distance")).where(F.col("distance") <= radius)
        least = ahead.groupBy("block", "node").agg(F.min("distance").alias("distance"))
        front = cut(least.join(known.withColumnRenamed("distance", "old"), ["block", "node"], "left").where(F.col("old").isNull() | (F.col("distance") < F.col("old"))).drop("old"))
        if front.isEmpty():
            break
        known = cut(known.unionByName(front).groupBy("block", "node").agg(F.min("distance").alias("distance")))
    around = known.join(shuffled(both, total), F.col("node") == F.col("a")).where(F.col("distance") + F.col("length") <= radius).select("block", "a", "b", "length")
    held = around.union(own.select("block", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(None).cast(kind).alias("length")))
    # The links are few for the rows that they give, so they stay in as many tasks as a shuffle has.
    tasks = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return held.repartition(tasks, "block").groupBy("block").applyInArrow(_solve(radius), f"source long, node long, distance {kind}")
