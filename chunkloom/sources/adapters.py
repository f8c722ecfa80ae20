"""Logical relations over the given tables, as DataFrames and as SQL of the same rows.

Measurements are whole numbers (hundredths), so that sums are exact in any order. Every relation grows with its table:
planes, bands and tiles are numbered by keys, so there are more of them in a larger table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Orders in a plane of the label volume, in a tile's constraints, and in an overlap band.
PLANE, TILE, BAND = 200, 8, 400
#: Steps from a tile to the tiles it is measured against.
STEPS = (1, 5, 25, 125, 625, 3125, 15625, 0)


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(z, y, x, label, v): a label volume with regions of 2 x 4 x 4, 64 in two planes; label 0 is background."""
    z, y, x = F.floor(F.col("l_orderkey") / PLANE).cast("int"), (F.col("l_partkey") % 32).cast("int"), (F.col("l_suppkey") % 32).cast("int")
    rows = table(spark, sf_dir, "lineitem").select(z.alias("z"), y.alias("y"), x.alias("x"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"), (F.col("l_partkey") + F.col("l_suppkey") + F.col("l_orderkey")).alias("k"))
    region = 1 + F.floor(F.col("z") / 2) * 64 + F.floor(F.col("y") / 4) * 8 + F.floor(F.col("x") / 4)
    return rows.groupBy("z", "y", "x").agg(F.max("v").alias("v"), F.sum("k").alias("k")).select("z", "y", "x", F.when(F.col("k") % 3 == 0, 0).otherwise(region).cast("long").alias("label"), "v")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(channel, v): intensities by channel."""
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("channel"), F.round(F.col("value") * 100).cast("long").alias("v"))


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(band, a, b): labels of two blocks at each pixel of their overlap."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.floor(F.col("l_orderkey") / BAND).alias("band"), (F.col("l_suppkey") % 12).alias("a"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c"))
    other = F.when(F.col("c") % 4 > 0, (F.col("a") + 5) % 12).otherwise(F.col("c") % 12)
    return lines.join(orders, "l_orderkey").select("band", "a", other.alias("b"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(fixed, moving, axis, shift, score, accepted, reason): measured constraints between tiles."""
    score = F.round(F.col("l_tax") * 100).cast("long")
    shift = F.round(F.col("l_quantity")).cast("long") - 25
    fixed = F.floor(F.col("l_orderkey") / TILE)
    step = F.element_at(F.array(*[F.lit(k).cast("long") for k in STEPS]), (F.col("l_partkey") % 8 + 1).cast("int"))
    rows = table(spark, sf_dir, "lineitem").select(fixed.alias("fixed"), (fixed + step).alias("moving"), (F.col("l_linenumber") % 3).cast("int").alias("axis"), shift.alias("shift"), score.alias("score"))
    reason = F.when(F.col("score") < 2, "low_score").when(F.abs("shift") > 20, "large_shift").when(F.col("fixed") == F.col("moving"), "same_tile")
    return rows.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(v0, v1, v2): triangles of a mesh of many pieces, 200 or so over 40 vertices each."""
    piece = F.floor(F.col("l_orderkey") / 50) * 64
    corners = [F.col("l_partkey") % 40, F.col("l_suppkey") % 37, F.col("l_orderkey") * 7 % 31]
    return table(spark, sf_dir, "lineitem").select(*[(piece + c).alias(f"v{i}") for i, c in enumerate(corners)])


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lo, hi, y_lo, y_hi, source): boxes in two axes, half-open."""
    k, s = F.col("p_partkey"), F.col("p_size").cast("long")
    return table(spark, sf_dir, "part").select(k.alias("id"), ((k * 37) % 9973).alias("lo"), ((k * 37) % 9973 + s).alias("hi"), ((k * 91) % 997).alias("y_lo"), ((k * 91) % 997 + s * 2).alias("y_hi"), (k % 5).alias("source"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tile, track, dz, score, valid): measurements of channels."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("tile"), F.col("l_returnflag").alias("track"), (F.round("l_quantity").cast("long") - 25).alias("dz"), F.round(F.col("l_discount") * 100).cast("long").alias("score"), (F.col("l_linestatus") == "F").alias("valid"))


SQL = {
    "voxels": f"""select z, y, x, (case when k % 3 = 0 then 0 else 1 + (z // 2) * 64 + (y // 4) * 8 + (x // 4) end)::bigint as label, v
  from (select (l_orderkey // {PLANE})::int as z, (l_partkey % 32)::int as y, (l_suppkey % 32)::int as x, max(round(l_extendedprice * 100)::bigint) as v, sum(l_partkey + l_suppkey + l_orderkey) as k from lineitem group by 1, 2, 3)""",
    "samples": "select event_type as channel, round(value * 100)::bigint as v from events",
    "bands": f"""select l_orderkey // {BAND} as band, l_suppkey % 12 as a, case when o_custkey % 4 > 0 then (l_suppkey % 12 + 5) % 12 else o_custkey % 12 end as b
  from lineitem join orders on o_orderkey = l_orderkey""",
    "edges": f"""select *, reason is null as accepted from (select *, case when score < 2 then 'low_score' when abs(shift) > 20 then 'large_shift' when fixed = moving then 'same_tile' end as reason
  from (select l_orderkey // {TILE} as fixed, l_orderkey // {TILE} + ({list(STEPS)}::bigint[])[l_partkey % 8 + 1] as moving, (l_linenumber % 3)::int as axis, round(l_quantity)::bigint - 25 as shift, round(l_tax * 100)::bigint as score from lineitem))""",
    "faces": "select l_orderkey // 50 * 64 + l_partkey % 40 as v0, l_orderkey // 50 * 64 + l_suppkey % 37 as v1, l_orderkey // 50 * 64 + l_orderkey * 7 % 31 as v2 from lineitem",
    "boxes": "select p_partkey as id, (p_partkey * 37) % 9973 as lo, (p_partkey * 37) % 9973 + p_size as hi, (p_partkey * 91) % 997 as y_lo, (p_partkey * 91) % 997 + p_size * 2 as y_hi, p_partkey % 5 as source from part",
    "tracks": "select l_suppkey as tile, l_returnflag as track, round(l_quantity)::bigint - 25 as dz, round(l_discount * 100)::bigint as score, l_linestatus = 'F' as valid from lineitem",
}
