"""Seeded samples, crops, grids and folds. The order of a sample is that of a digest of its key, so it is the same on any cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def digest(*keys: Column, seed: str) -> Column:
    """A digest of keys under a seed, whose order is as good as random."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[k.cast("string") for k in keys]).cast("binary"))


def uniform_planes(stacks: DataFrame, n: int, seed: str) -> DataFrame:
    """n planes (stack, z) of stacks (stack, planes), each plane of any stack with the same chance, without replacement."""
    planes = stacks.where(F.col("planes") > 0).select("stack", F.explode(F.sequence(F.lit(0).cast("long"), F.col("planes") - 1)).alias("z"))
    return planes.orderBy(digest(F.col("stack"), F.col("z"), seed=seed), "stack", "z").limit(n)


def random_crops(rows: DataFrame, cell: list[Column], n: int, seed: str) -> DataFrame:
    """Up to n rows (id, ...) of those that are first in their cell by digest, in the order of digests."""
    own = rows.withColumn("d", digest(F.col("id"), seed=seed))
    first = own.groupBy(*[c.alias(f"c{i}") for i, c in enumerate(cell)]).agg(F.min_by("id", F.struct("d", "id")).alias("id"), F.min("d").alias("d"))
    return first.orderBy("d", "id").limit(n).select("id", *[f"c{i}" for i in range(len(cell))])


def patch_grid(boxes: DataFrame, size: int, across: int, most: int) -> DataFrame:
    """(id, k, y, x): up to `most` patches a box, row by row, of `across` x `across` even starts that coincide where a box is small."""
    starts = lambda extent: F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda i: F.floor(F.greatest(extent - size, F.lit(0)) * i / (across - 1))))
    grid = F.flatten(F.transform(starts(F.col("height")), lambda y: F.transform(starts(F.col("width")), lambda x: F.struct(y.alias("y"), x.alias("x")))))
    return boxes.select("id", F.posexplode(F.slice(grid, 1, most)).alias("k", "p")).select("id", "k", "p.y", "p.x")


def content_crops(voxels: DataFrame, size: int, n: int) -> DataFrame:
    """(z, ky, kx, held, v): each plane's n blocks with most foreground, then most signal, then the first."""
    blocks = voxels.groupBy("z", F.floor(F.col("y") / size).alias("ky"), F.floor(F.col("x") / size).alias("kx")).agg(F.count_if(F.col("label") > 0).alias("held"), F.sum("v").alias("v"))
    best = F.array_sort(F.collect_list(F.struct((-F.col("held")).alias("h"), (-F.col("v")).alias("s"), "ky", "kx")))  # one entry for each block of a plane
    return blocks.groupBy("z").agg(F.slice(best, 1, n).alias("b")).select("z", F.explode("b").alias("b")).select("z", "b.ky", "b.kx", (-F.col("b.h")).alias("held"), (-F.col("b.s")).alias("v"))


def chunk_batches(indices: DataFrame, chunk: int, least: int) -> DataFrame:
    """(stack, batch, first, last, n) of indices (stack, i): batches in order, closed at the end of a chunk once they hold `least`.

    A fold over the sizes of a stack's chunks, not over its indices.
    """
    chunks = indices.groupBy("stack", F.floor(F.col("i") / chunk).alias("c")).agg(F.count("*").alias("n"), F.min("i").alias("first"), F.max("i").alias("last"))
    own = chunks.groupBy("stack").agg(F.array_sort(F.collect_list(F.struct("c", "n", "first", "last"))).alias("s"))
    kind = "array<struct<first:bigint,last:bigint,n:bigint>>"

    def add(done: Column, c: Column) -> Column:
        top = F.element_at(done, -1)
        new = F.struct(c["first"].cast("bigint").alias("first"), c["last"].cast("bigint").alias("last"), c["n"].alias("n"))
        more = F.struct(top["first"].alias("first"), c["last"].cast("bigint").alias("last"), (top["n"] + c["n"]).alias("n"))
        return F.when((F.size(done) > 0) & (top["n"] < least), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(more))).otherwise(F.concat(done, F.array(new)))

    return own.select("stack", F.posexplode(F.aggregate("s", F.array().cast(kind), add)).alias("batch", "b")).select("stack", "batch", "b.first", "b.last", "b.n")


def crop_ranges(voxels: DataFrame, size: int, low: float, high: float, most_empty: float) -> DataFrame:
    """(z, crops, low, high): means over a plane's crops of their quantiles; crops with more background than `most_empty` are left out."""
    q = F.percentile("v", F.array(F.lit(low), F.lit(high)))
    crops = voxels.groupBy("z", F.floor(F.col("y") / size).alias("cy"), F.floor(F.col("x") / size).alias("cx")).agg(q.alias("q"), F.avg((F.col("label") == 0).cast("double")).alias("empty"))
    kept = crops.where(F.col("empty") <= most_empty)
    return kept.groupBy("z").agg(F.count("*").alias("crops"), F.avg(F.col("q")[0]).alias("low"), F.avg(F.col("q")[1]).alias("high"))


def levels(ranges: DataFrame, step: int) -> DataFrame:
    """(id, level): from `low` to `high` in tenths by `step` tenths, the end included where the steps reach it."""
    return ranges.where(F.col("high") >= F.col("low")).select("id", F.explode(F.sequence("low", "high", F.lit(step).cast("long"))).alias("k")).select("id", (F.col("k") / 10).alias("level"))
