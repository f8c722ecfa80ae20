"""Acquisition manifests and registrations of tiles: gates over whole tables before something is published."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.operators import records as R
from chunkloom.operators.graphs import components

#: A tile inside a plane of face-adjacent tiles has four candidate neighbours; one with fewer lies on the edge.
INNER = 4
POLICIES = ("edges", "allow", "exclude")


def standing(tiles: DataFrame, constraints: DataFrame, pairs: DataFrame, anchors: DataFrame, group: str) -> DataFrame:
    """(group, tile, neighbours, connected, edge) for each of tiles (group, tile), numbers of tiles that differ between groups.

    connected: accepted constraints (fixed, moving, accepted) lead to an anchor (tile). neighbours: distinct tiles that
    pairs (fixed, moving) link it with. All groups are solved at once.
    """
    roots = components(constraints.where("accepted").select(F.col("fixed").alias("a"), F.col("moving").alias("b"))).select(F.col("node").alias("tile"), "root")
    own = tiles.join(roots, "tile", "left").withColumn("root", F.coalesce("root", "tile"))
    held = own.join(anchors.select("tile"), "tile", "left_semi").select("root").distinct().withColumn("connected", F.lit(True))
    both = pairs.select(F.col("fixed").alias("tile"), F.col("moving").alias("other")).union(pairs.select("moving", "fixed")).where("tile <> other")
    degree = both.distinct().groupBy("tile").agg(F.count("*").alias("neighbours"))
    out = own.join(held, "root", "left").join(degree, "tile", "left")
    n = F.coalesce("neighbours", F.lit(0).cast("long"))
    return out.select(group, "tile", n.alias("neighbours"), F.coalesce("connected", F.lit(False)).alias("connected"), (n < INNER).alias("edge"))


def outcomes(states: DataFrame, group: str) -> DataFrame:
    """(group, tiles, connected, inner_gaps, outcome): `connected`; `edges`, where only tiles of the edge are apart; else `refused`."""
    sums = states.groupBy(group).agg(F.count("*").alias("tiles"), F.count_if("connected").alias("connected"), F.count_if(~F.col("connected") & ~F.col("edge")).alias("inner_gaps"))
    return sums.withColumn("outcome", F.when(F.col("connected") == F.col("tiles"), "connected").when(F.col("inner_gaps") == 0, "edges").otherwise("refused"))


@dataclass(frozen=True)
class Registration:
    """What was published: rows, tiles given, tiles that the anchor reaches, and whether tiles of the edge were let through."""

    rows: int
    tiles: int
    connected: int
    edges_allowed: bool


def publish_registration(tiles: DataFrame, constraints: DataFrame, pairs: DataFrame, anchor: int, root: str, policy: str = "edges") -> Registration:
    """Publish tiles (tile, z, y, x; others stay) with an identity affine each, positions and affines as one version.

    The optimised place is each tile's stage position, so that affines are identities. Tiles that accepted constraints
    don't connect with the anchor are an error, unless all of them lie on the edge; `allow` keeps and `exclude` leaves
    out all of them. A tile given twice, a constraint or pair of a tile that isn't given, an anchor that isn't given,
    and a root with a version are errors. Nothing is published then.
    """
    if policy not in POLICIES:
        raise ValueError(f"the policy has to be one of {POLICIES}")
    spark = tiles.sparkSession
    if not R.versions(spark, root).isEmpty():
        raise FileExistsError(f"something is published under {root}")
    keyed = tiles.select(F.lit(0).alias("all"), "tile")
    if not keyed.groupBy("tile").count().where("count > 1 or tile is null").isEmpty():
        raise ValueError("a tile occurs twice or has no number")
    ends = [t.select(F.col(c).alias("tile")) for t in (constraints, pairs) for c in ("fixed", "moving")]
    named = ends[0].union(ends[1]).union(ends[2]).union(ends[3])
    start = spark.range(1).select(F.lit(anchor).cast("long").alias("tile"))
    if not named.union(start).join(keyed, "tile", "left_anti").isEmpty():
        raise ValueError("constraints, pairs or the anchor name a tile that has no position")
    states = cut(standing(keyed, constraints, pairs, start, "all"), "standing")
    found = outcomes(states, "all").first()
    if policy == "edges" and found["outcome"] == "refused":
        raise ValueError(f"{found['connected']} of {found['tiles']} tiles are connected, and {found['inner_gaps']} of the others don't lie on the edge")
    kept = states.where("connected") if policy == "exclude" else states
    unit = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(4)]) for i in range(3)])
    rows = tiles.join(kept.select("tile", "connected"), "tile").withColumn("affine", unit)
    return Registration(R.publish(rows, root), found["tiles"], found["connected"], policy == "edges" and found["outcome"] == "edges")


def manifest(files: DataFrame, required: str) -> DataFrame:
    """(side, axes, shape, spacing, channels, tiles, bytes) of files (side, tile, axes, shape, spacing, channels, bytes).

    Once the rows are read, these are errors: files of a side that differ in axes, shape, spacing or channels, a side
    with a channel twice or without the required one, and a number of channels other than the shape's.
    """
    layout = F.struct("axes", "shape", "spacing", "channels")
    sides = files.groupBy("side").agg(F.min(layout).alias("low"), F.max(layout).alias("high"), F.count("*").alias("tiles"), F.sum("bytes").alias("bytes"))
    channels = F.col("low.channels")
    declared = F.when(F.contains("low.axes", F.lit("C")), F.get("low.shape", F.instr("low.axes", "C") - 1)).otherwise(1)
    fault = (
        F.when(~F.col("low").eqNullSafe(F.col("high")), "files differ in layout")
        .when(F.size(F.array_distinct(channels)) < F.size(channels), "a channel occurs twice")
        .when(~F.array_contains(channels, required), f"there is no channel {required}")
        .when(declared != F.size(channels), "axes and channels disagree")
    )
    whole = F.when(fault.isNull(), True).otherwise(F.raise_error(F.concat(F.lit("side "), F.col("side").cast("string"), F.lit(": "), fault)).cast("boolean"))
    return sides.where(whole).select("side", "low.*", "tiles", "bytes")


def differences(held: DataFrame, found: DataFrame) -> DataFrame:
    """Rows that occur more often in one of two tables with the same columns, with `change` (gone or new) and how many times more; nulls are alike.

    One grouped sum, where exceptAll both ways takes two.
    """
    rows = held.withColumn("change", F.lit(-1)).unionByName(found.withColumn("change", F.lit(1)))
    n = rows.groupBy(*held.columns).agg(F.sum("change").alias("n")).where("n <> 0")
    return n.select(*held.columns, F.when(F.col("n") < 0, "gone").otherwise("new").alias("change"), F.abs("n").alias("n"))


def require_same(held: DataFrame, found: DataFrame) -> None:
    """An error that counts the rows gone and new, unless both tables hold the same rows equally often."""
    n = {r["change"]: r["n"] for r in differences(held, found).groupBy("change").agg(F.sum("n").alias("n")).collect()}
    if n:
        raise ValueError(f"the manifest no longer matches: {n.get('gone', 0)} rows are gone and {n.get('new', 0)} are new")
