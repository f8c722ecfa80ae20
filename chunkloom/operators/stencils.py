"""Label volumes by neighbourhoods: voxels are dealt to blocks with a halo, and each block is a small array.

A block holds its own voxels and a halo of its neighbours', so a task's memory depends on the block alone, and a round
costs one shuffle in which most voxels travel once. Voxels that aren't listed are background; outside the volume's
shape there is nothing, which counts neither as background nor as a label.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.operators.graphs import components
from chunkloom.operators.ranges import numbered

BLOCK = (16, 32, 32)
OFFSETS = [(z, y, x) for z in (-1, 0, 1) for y in (-1, 0, 1) for x in (-1, 0, 1) if (z, y, x) != (0, 0, 0)]
FACES = [(0, 0, 1), (0, 1, 0), (1, 0, 0)]
_SCHEMA = "z int, y int, x int, label long"


def moved(a: np.ndarray, offset: tuple[int, int, int], fill: int) -> np.ndarray:
    """a with each place holding what lies at `offset` from it."""
    out = np.full_like(a, fill)
    to = tuple(slice(max(0, -o), n - max(0, o)) for o, n in zip(offset, a.shape))
    come = tuple(slice(max(0, o), n - max(0, -o)) for o, n in zip(offset, a.shape))
    out[to] = a[come]
    return out


def by_blocks(voxels: DataFrame, shape: tuple[int, int, int], halo: int, kernel: Callable[[np.ndarray], np.ndarray], block: tuple[int, int, int] = BLOCK, before: bool = False) -> DataFrame:
    """(z, y, x, label): kernel's result for the blocks of voxels (z, y, x, label), labels over 0 only; with `before`, a column of what the label was.

    kernel gets a block with its halo, -1 outside the volume, and gives an array of that shape, of which the block's
    own part is kept. Blocks without a voxel in them or their halo have no result. Each place has at most one voxel,
    and halo is at most the block's edge.
    """
    own = [F.floor(F.col(a) / b) for a, b in zip("zyx", block)]
    readers = []
    for a, b, k in zip("zyx", block, own):
        low, high = F.when(F.col(a) % b < halo, k - 1), F.when(F.col(a) % b >= b - halo, k + 1)
        readers.append(F.array_compact(F.array(k, low, high)))
    rows = voxels.where("label > 0").select(*[F.col(a).cast("int").alias(a) for a in "zyx"], F.col("label").cast("long").alias("label"), *[r.alias(f"r{a}") for a, r in zip("zyx", readers)])
    for a in "zyx":
        rows = rows.withColumn(f"k{a}", F.explode(f"r{a}")).where(f"k{a} >= 0").drop(f"r{a}")

    def solve(key: tuple[pa.Scalar, ...], held: pa.Table) -> pa.Table:
        first = [k.as_py() * b - halo for k, b in zip(key, block)]
        size = [b + 2 * halo for b in block]
        a = np.zeros(size, np.int64)
        for axis in range(3):
            at = np.arange(first[axis], first[axis] + size[axis])
            index = [slice(None)] * 3
            index[axis] = (at < 0) | (at >= shape[axis])
            a[tuple(index)] = -1
        a[tuple(held[c].to_numpy() - f for c, f in zip("zyx", first))] = held["label"].to_numpy()
        inner = tuple(slice(halo, halo + b) for b in block)
        found = kernel(a)[inner]
        place = np.nonzero(found > 0)
        out = pa.table([*[pa.array((p + f + halo).astype(np.int32)) for p, f in zip(place, first)], pa.array(found[place])], names=["z", "y", "x", "label"])
        return out.append_column("before", pa.array(a[inner][place])) if before else out

    return rows.groupBy("kz", "ky", "kx").applyInArrow(solve, _SCHEMA + (", before long" if before else ""))


def volume_shape(voxels: DataFrame) -> tuple[int, int, int]:
    most = voxels.agg(*[F.max(a) for a in "zyx"]).first()
    return tuple(0 if m is None else m + 1 for m in most)


def smoothed(a: np.ndarray, fill: int, margin: int, least: int) -> np.ndarray:
    """One round of smoothing: see smoothed_labels()."""
    same, empty, others = (np.zeros(a.shape, np.int64) for _ in range(3))
    low, high = np.full(a.shape, np.iinfo(np.int64).max), np.zeros(a.shape, np.int64)
    for offset in OFFSETS:
        near = moved(a, offset, -1)
        same += near == a
        empty += near == 0
        other = (near > 0) & (near != a)
        others += other
        low = np.where(other, np.minimum(low, near), low)
        high = np.where(other, np.maximum(high, near), high)
    out = a.copy()
    inside, one = a > 0, (others > 0) & (low == high)
    out[inside & (same < 26) & (others == 0) & (empty > same)] = 0
    flip = inside & one & (same + others >= least) & (others > same + margin)
    out[flip] = high[flip]
    hole = (a == 0) & one & (others >= fill)
    out[hole] = high[hole]
    return out


def smoothed_labels(voxels: DataFrame, shape: tuple[int, int, int], rounds: int = 1, fill: int = 18, margin: int = 1, least: int = 4, block: tuple[int, int, int] = BLOCK) -> DataFrame:
    """voxels (z, y, x, label) after rounds of smoothing by the 26 neighbours; places where more than two labels meet stay.

    A labelled voxel beside no other label with more background around it than its own label becomes background. One
    beside exactly one other label, with at least `least` labelled neighbours, takes it where that has more neighbours
    than its own and `margin`. Background with at least `fill` neighbours of one label, and none of others, takes it.
    """
    for _ in range(rounds):
        voxels = cut(by_blocks(voxels, shape, 1, lambda a: smoothed(a, fill, margin, least), block))
    return voxels


def thin(a: np.ndarray, radius: int) -> np.ndarray:
    """The labels of voxels that an opening of their label by `radius` steps removes, else 0."""
    core = a
    for _ in range(radius):
        whole = core > 0
        for offset in OFFSETS:
            whole &= moved(core, offset, -1) == core
        core = np.where(whole, core, 0)
    kept = np.zeros(a.shape, bool)
    reach = range(-radius, radius + 1)
    for offset in [(z, y, x) for z in reach for y in reach for x in reach]:
        kept |= moved(core, offset, 0) == a
    return np.where((a > 0) & ~kept, a, 0)


def thin_parts(voxels: DataFrame, shape: tuple[int, int, int], radius: int, block: tuple[int, int, int] = BLOCK) -> DataFrame:
    """voxels (z, y, x, label) that lie in parts of their label that a cube of 2 * radius + 1 doesn't fit into."""
    return by_blocks(voxels, shape, 2 * radius, lambda a: thin(a, radius), block)


def _roots(a: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each labelled voxel the least index of those it touches through faces within its label; 0 for others."""
    root = np.where(a > 0, index, 0)
    while True:
        least = root
        for z, y, x in FACES:
            for offset in ((z, y, x), (-z, -y, -x)):
                near = moved(a, offset, -1) == a
                least = np.where(near & (a > 0), np.minimum(least, moved(root, offset, 0)), least)
        if (least == root).all():
            return root
        root = least


def _pieces(voxels: DataFrame, shape: tuple[int, int, int], block: tuple[int, int, int]) -> tuple[DataFrame, DataFrame]:
    """(z, y, x, label, node) of voxels, node being the first place of the piece within the block, and (node, named) of all nodes."""
    width = shape[1] * shape[2]

    def kernel(a: np.ndarray) -> np.ndarray:
        return _roots(a, np.arange(1, a.size + 1).reshape(a.shape))

    local = by_blocks(voxels, shape, 0, kernel, block, before=True)
    # The least index within a block is the first of its places in order of (z, y, x), too.
    at = F.col("label") - 1
    steps = [F.floor(at / (block[1] * block[2])), F.floor(at / block[2]) % block[1], at % block[2]]
    z, y, x = (F.floor(F.col(a) / b) * b + k for a, b, k in zip("zyx", block, steps))
    held = cut(local.select("z", "y", "x", F.col("before").alias("label"), (z * width + y * shape[2] + x).cast("long").alias("node")))
    edges = None
    for offset, b, a in zip(FACES[::-1], block, "zyx"):
        rim = held.where((F.col(a) + 1) % b == 0).select(*[(F.col(c) + o).alias(c) for c, o in zip("zyx", offset)], "label", F.col("node").alias("a"))
        met = rim.join(held.where(F.col(a) % b == 0).withColumnRenamed("node", "b"), ["z", "y", "x", "label"]).select("a", "b")
        edges = met if edges is None else edges.unionByName(met)
    joined = components(cut(edges.distinct()))
    pieces = held.select("label", "node").distinct().join(joined, "node", "left")
    pieces = cut(pieces.select("label", "node", F.coalesce("root", "node").alias("root")))
    first = pieces.groupBy("label").agg(F.min("root").alias("first"))
    extra = pieces.select("label", "root").distinct().join(first, "label").where("root <> first").select("label", "root")
    largest = voxels.agg(F.max("label")).first()[0] or 0
    order = extra.select(F.lit(0).alias("one"), F.struct("label", "root").alias("at"))
    order = numbered(order, "one", "at").select("at.label", "at.root", (F.col("number") + largest).alias("new"))
    return held, pieces.join(order, ["label", "root"], "left").select("node", F.coalesce("new", "label").alias("named"))


def relabelled(voxels: DataFrame, shape: tuple[int, int, int], block: tuple[int, int, int] = BLOCK) -> DataFrame:
    """voxels (z, y, x, label) with a label for each piece of a label that hangs together through faces: its first piece in order of (z, y, x) keeps the label, others get numbers above the largest label.

    Pieces are found within blocks first; only pairs of pieces that touch across blocks make a graph.
    """
    held, names = _pieces(voxels, shape, block)
    return held.join(names, "node").select("z", "y", "x", F.col("named").alias("label"))


def piece_sizes(voxels: DataFrame, shape: tuple[int, int, int], block: tuple[int, int, int] = BLOCK) -> DataFrame:
    """(label, piece, n): how many voxels of a label relabelled() gives each number; voxels are counted by block's piece before names are joined."""
    held, names = _pieces(voxels, shape, block)
    counts = held.groupBy("label", "node").agg(F.count("*").alias("n"))
    return counts.join(names, "node").groupBy("label", F.col("named").alias("piece")).agg(F.sum("n").alias("n"))
