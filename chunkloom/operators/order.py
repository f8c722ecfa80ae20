"""Sampling, ranking and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.operators.geometry import merged_windows
from chunkloom.operators.ranges import numbered, running

def top_signal(rows: DataFrame, group: str, signal: str, key: str, n: int) -> DataFrame:
    """The n rows of each group with most signal, ties to the smaller key."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(F.desc(signal), key))).where(F.col("rank") <= n)


def largest_remainder(groups: DataFrame, budget: int) -> DataFrame:
    """(group, n, seats): `budget` shared in proportion to n, leftovers to the largest remainders, ties to the smaller group.

    groups is an aggregate with one row a group.
    """
    total = F.sum("n").over(W.partitionBy())
    parts = groups.withColumn("total", total).withColumn("seats", F.floor(F.col("n") * budget / F.col("total"))).withColumn("rest", F.col("n") * budget % F.col("total"))
    left = F.lit(budget) - F.sum("seats").over(W.partitionBy())
    order = F.row_number().over(W.orderBy(F.desc("rest"), "group"))
    return parts.withColumn("left", left).withColumn("order", order).select("group", "n", (F.col("seats") + (F.col("order") <= F.col("left")).cast("long")).alias("seats"))


def evenly_spaced(ranges: DataFrame, n: int) -> DataFrame:
    """(id, pick): n whole positions from start to stop - 1, rounded half to even; fewer where they coincide."""
    step = (F.col("stop") - 1 - F.col("start")) / (n - 1)
    picks = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.bround(F.col("start") + step * i, 0).cast("long"))
    return ranges.where(F.col("stop") > F.col("start")).select("id", F.explode(F.array_distinct(picks)).alias("pick"))


def with_context(picks: DataFrame, step: int, reach: int, count: Column) -> DataFrame:
    """(id, z): picks and their neighbours up to `reach` steps away, within 0 and count, each once."""
    near = F.transform(F.sequence(F.lit(-reach), F.lit(reach)), lambda k: F.least(F.greatest(F.col("pick") + k * step, F.lit(0)), count - 1))
    return picks.select("id", F.explode(near).alias("z")).distinct()


def round_robin(rows: DataFrame, source: str, key: str) -> DataFrame:
    """rows with `turn`: the first of every source, then the second, and so on; sources in order within a turn."""
    return numbered(rows, source, key, "turn")


def strata(rows: DataFrame, position: str, group: str, n: int) -> DataFrame:
    """One row of each of n equal strata of a group's positions: the one with the least hash of its position."""
    ends = rows.groupBy(group).agg(F.min(position).alias("first"), (F.max(position) + 1).alias("past"))
    placed = rows.join(ends, group).withColumn("stratum", F.floor((F.col(position) - F.col("first")) * n / (F.col("past") - F.col("first"))))
    first = F.struct((F.col(position) * 2654435761 % 4294967296).alias("h"), F.col(position).alias("p"))
    return placed.groupBy(group, "stratum").agg(F.min(first)["p"].alias("pick"))


def pair_folds(rows: DataFrame, key: str, folds: int) -> DataFrame:
    """rows with `fold`: whole keys stay together, by a digest of the key."""
    return rows.withColumn("fold", F.conv(F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 8), 16, 10).cast("long") % folds)


def snake(tiles: DataFrame) -> DataFrame:
    """tiles (row, col) with `place` within the row: even rows left to right, odd rows right to left."""
    toward = F.when(F.col("row") % 2 == 0, F.col("col")).otherwise(-F.col("col"))
    return tiles.withColumn("place", F.row_number().over(W.partitionBy("row").orderBy(toward)) - 1)


def last_writer(tiles: DataFrame) -> DataFrame:
    """(y, x, owner, v): the value of the tile written last at each pixel."""
    return tiles.groupBy("y", "x").agg(F.max("tile").alias("owner"), F.max_by("v", "tile").alias("v"))


def seam_pixels(owners: DataFrame) -> DataFrame:
    """(y, x, owner): pixels with another owner among their four neighbours."""
    step = F.explode(F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))]))
    ahead = owners.select((F.col("y")).alias("y0"), F.col("x").alias("x0"), F.col("owner").alias("mine"), step.alias("s"))
    near = ahead.select("y0", "x0", "mine", (F.col("y0") + F.col("s.dy")).alias("y"), (F.col("x0") + F.col("s.dx")).alias("x"))
    return near.join(owners.select("y", "x", "owner"), ["y", "x"]).where(F.col("owner") != F.col("mine")).select(F.col("y0").alias("y"), F.col("x0").alias("x"), F.col("mine").alias("owner")).distinct()


def modal_size(boxes: DataFrame) -> DataFrame:
    """(source, width, height, n): the most common size of each source, ties to the smaller."""
    sizes = boxes.groupBy("source", (F.col("hi") - F.col("lo")).alias("width"), (F.col("y_hi") - F.col("y_lo")).alias("height")).agg(F.count("*").alias("n"))
    return sizes.withColumn("k", F.row_number().over(W.partitionBy("source").orderBy(F.desc("n"), "width", "height"))).where("k = 1").drop("k")


def greedy_stabbing(boxes: DataFrame) -> DataFrame:
    """(source, plane): the fewest planes that hit every half-open interval [lo, hi) of a source.

    Intervals that no chain of overlaps joins need no common plane, so each chain is a fold of its own: in order of the
    ends, with the last plane as state, one sorted pass a chain.
    """
    held = boxes.where(F.col("hi") > F.col("lo"))
    # Chains overlap, while merged windows may only touch: ends are made inclusive.
    chains = merged_windows(held.withColumn("hi", F.col("hi") - 1)).select("source", F.col("start").alias("_start"))
    marks = chains.select("source", F.col("_start").alias("lo"), F.lit(1).cast("long").alias("one"))
    ends = held.groupBy("source", "lo").agg(F.array_sort(F.collect_set("hi")).alias("his")).join(marks, ["source", "lo"], "left")
    dealt = running(ends.withColumn("one", F.coalesce("one", F.lit(0).cast("long"))), "source", "lo", "one").withColumnRenamed("through", "chain")
    last = dealt.select("source", "chain", "lo", F.explode("his").alias("hi")).groupBy("source", "chain", "hi").agg(F.max("lo").alias("lo"))
    rows = last.groupBy("source", "chain").agg(F.array_sort(F.collect_list(F.struct("hi", "lo"))).alias("rows"))
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("found"))

    def step(s: Column, r: Column) -> Column:
        plane = (r["hi"] - 1).cast("bigint")
        return F.when(s["last"] >= r["lo"], s).otherwise(F.struct(plane.alias("last"), F.concat(s["found"], F.array(plane)).alias("found")))

    return rows.select("source", F.explode(F.aggregate("rows", start, step)["found"]).alias("plane"))
