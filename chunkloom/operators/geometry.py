"""Boxes, blocks and intervals: overlap joins by grid cells, merged windows, halos."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.operators.ranges import running, with_parts

def cells(lo: Column, hi: Column, width: int) -> Column:
    """The grid cells that the half-open interval [lo, hi) meets; none for an empty one."""
    return F.when(hi > lo, F.sequence(F.floor(lo / width), F.floor((hi - 1) / width))).otherwise(F.array().cast("array<bigint>"))


def box_pairs(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """(a, b, overlap_x, overlap_y): pairs of boxes with positive overlap in both axes, a < b.

    Boxes are dealt to the grid cells they meet, so only boxes with a common cell are compared; a pair counts in the
    cell that holds the corner of its intersection, so that it occurs once. Cells are dealt to as many tasks as a
    shuffle has, as there are far more pairs than boxes: small files neither bring the boxes into few tasks, nor whole
    to all of them.
    """
    tasks = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = boxes.withColumn("cx", F.explode(cells(F.col("lo"), F.col("hi"), width))).withColumn("cy", F.explode(cells(F.col("y_lo"), F.col("y_hi"), height))).repartition(tasks, "cx", "cy").hint("merge")
    other = dealt.select("cx", "cy", *[F.col(c).alias(f"o_{c}") for c in boxes.columns])
    x0, x1 = F.greatest("lo", "o_lo"), F.least("hi", "o_hi")
    y0, y1 = F.greatest("y_lo", "o_y_lo"), F.least("y_hi", "o_y_hi")
    met = dealt.join(other, ["cx", "cy"]).where((F.col("id") < F.col("o_id")) & (x1 > x0) & (y1 > y0))
    once = met.where((F.floor(x0 / width) == F.col("cx")) & (F.floor(y0 / height) == F.col("cy")))
    return once.select(F.col("id").alias("a"), F.col("o_id").alias("b"), (x1 - x0).alias("overlap_x"), (y1 - y0).alias("overlap_y"), F.col("source"), F.col("o_source").alias("other_source"))


def active_counts(boxes: DataFrame) -> DataFrame:
    """(source, pos, active): how many boxes of a source cover each position where one starts or ends (sweep line)."""
    steps = boxes.select("source", F.explode(F.array(F.struct(F.col("lo").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("hi").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    change = steps.groupBy("source", "e.pos").agg(F.sum("e.d").alias("d"))
    return running(change, "source", "pos", "d").select("source", "pos", F.col("through").alias("active"))


def merged_windows(boxes: DataFrame) -> DataFrame:
    """(source, start, stop, members): intervals of a source joined while the next starts at or before the reach so far.

    Intervals are dealt to ranges of their starts; the reach of all ranges before is at most one row a range.
    """
    placed = with_parts(boxes.select("source", "id", "lo", "hi"), "source", "lo")
    tops = placed.groupBy("source", "part").agg(F.max("hi").alias("top"))
    past = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select("source", "part", F.max("top").over(past).alias("past"))
    order = W.partitionBy("source", "part").orderBy("lo", "hi", "id").rowsBetween(W.unboundedPreceding, -1)
    reach = F.greatest(F.max("hi").over(order), F.col("past"))  # greatest skips nulls
    starts = placed.join(tops, ["source", "part"]).withColumn("reach", reach).where(F.col("reach").isNull() | (F.col("lo") > F.col("reach")))
    # Each start belongs to the last window that began at or before it.
    begun = starts.select("source", "lo", F.lit(1).cast("long").alias("one")).distinct()
    marks = placed.groupBy("source", "lo").agg(F.max("hi").alias("hi"), F.count("*").alias("n")).join(begun, ["source", "lo"], "left")
    k = running(marks.withColumn("one", F.coalesce("one", F.lit(0).cast("long"))), "source", "lo", "one")
    return k.groupBy("source", "through").agg(F.min("lo").alias("start"), F.max("hi").alias("stop"), F.sum("n").alias("members")).drop("through")


def block_reads(voxels: DataFrame, size: tuple[int, int, int], halo: int) -> DataFrame:
    """(kz, ky, kx, z0, z1, y0, y1, x0, x1, held): blocks with voxels, and their read ranges with a clipped halo."""
    shape = voxels.agg(*[(F.max(c) + 1).alias(f"n{c}") for c in "zyx"])
    at = [F.floor(F.col(c) / s).cast("int").alias(f"k{c}") for c, s in zip("zyx", size)]
    blocks = voxels.groupBy(*at).agg(F.count("*").alias("held"))
    # One row with the volume's shape.
    both = blocks.join(F.broadcast(shape))
    ranges = [e for c, s in zip("zyx", size) for e in (F.greatest(F.lit(0), F.col(f"k{c}") * s - halo).alias(f"{c}0"), F.least(F.col(f"n{c}"), (F.col(f"k{c}") + 1) * s + halo).alias(f"{c}1"))]
    return both.select("kz", "ky", "kx", *ranges, "held")


def neighbour_blocks(blocks: DataFrame) -> DataFrame:
    """(axis, kz, ky, kx, held, next_held): each block with its successor along each axis, where both are there."""
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("axis"), *[(F.col(f"k{c}") + (1 if i == k else 0)).alias(f"n{c}") for k, c in enumerate("zyx")]) for i in range(3)]))
    ahead = blocks.select("kz", "ky", "kx", "held", step.alias("s")).select("kz", "ky", "kx", "held", "s.*")
    other = blocks.select(*[F.col(f"k{c}").alias(f"n{c}") for c in "zyx"], F.col("held").alias("next_held"))
    return ahead.join(other, ["nz", "ny", "nx"]).select("axis", "kz", "ky", "kx", "held", "next_held")


def chunk_grid(shape: DataFrame, chunk: tuple[int, int, int]) -> DataFrame:
    """(volume, z0, z1, y0, y1, x0, x1): row-major chunk bounds of each volume (volume, nz, ny, nx), clipped."""
    out = shape
    for c, s in zip("zyx", chunk):
        n = F.col(f"n{c}")
        out = out.withColumn(f"{c}0", F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1, F.lit(s).cast("long"))))).withColumn(f"{c}1", F.least(F.col(f"{c}0") + s, n.cast("long")))
    return out.select("volume", *[f"{c}{e}" for c in "zyx" for e in "01"])


def nearest_level(positions: DataFrame, levels: DataFrame, spacing: int) -> DataFrame:
    """(id, index, off): each position's nearest index at another spacing, halves to even, within the level's range."""
    index = F.bround(F.col("lo") / spacing, 0).cast("long")
    clipped = F.least(F.greatest(index, F.lit(0)), F.col("count") - 1)
    return positions.join(levels, "source").select("id", clipped.alias("index"), (F.col("lo") - clipped * spacing).alias("off"))
