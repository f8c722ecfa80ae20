"""Jobs over acquisition manifests and registrations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.scratch import folder
from chunkloom.jobs.base import Jobs
from chunkloom.operators import records as R
from chunkloom.operators import registration as G
from chunkloom.sources import adapters as A

JOBS = Jobs()


def _place(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


_STATES = """also used as (select {group} as g, fixed, moving, accepted and score >= {least} as kept from edges),
tiles as (select g, fixed as tile from used union select g, moving from used),
links as (select g, fixed as a, moving as b from used where kept union select g, moving, fixed from used where kept),
reach as (select g, min(tile) as tile from tiles group by 1 union select l.g, l.b from reach r join links l on l.g = r.g and l.a = r.tile),
near as (select g, fixed as tile, moving as other from used where fixed <> moving union select g, moving, fixed from used where fixed <> moving),
degree as (select g, tile, count(*) as neighbours from near group by 1, 2),
states as (select g, tile, coalesce(neighbours, 0) as neighbours, r.tile is not null as connected from tiles left join degree using (g, tile) left join reach r using (g, tile))
"""


@JOBS.add(
    _STATES.format(group="axis", least="2 + 3 * axis")
    + """select g as axis, count(*) as tiles, count(*) filter (where connected) as connected, count(*) filter (where not connected and neighbours < 4) as at_edge,
  case when bool_and(connected) then 'connected' when bool_and(connected or neighbours < 4) then 'edges' else 'refused' end as outcome from states group by 1""",
    "edges",
)
def registration_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of the registration along each axis, each with its own least score; the first tile is the anchor."""
    edges = A.edges(spark, sf_dir).withColumn("accepted", F.col("accepted") & (F.col("score") >= 2 + 3 * F.col("axis")))
    number = lambda c: (F.col(c) * 3 + F.col("axis")).alias(c)
    own = edges.select("axis", number("fixed"), number("moving"), "accepted")
    tiles = own.select("axis", F.col("fixed").alias("tile")).union(own.select("axis", "moving")).distinct()
    states = G.standing(tiles, own, own, tiles.groupBy("axis").agg(F.min("tile").alias("tile")), "axis")
    found = G.outcomes(states, "axis")
    return found.select("axis", "tiles", "connected", (F.col("tiles") - F.col("connected") - F.col("inner_gaps")).alias("at_edge"), "outcome")


@JOBS.add(
    _STATES.format(group="0", least="7") + "select tile, tile % 7 / 4 as z, tile // 25 / 4 as y, tile % 25 / 4 as x, 1.0::double as determinant, 0.0::double as shift from states where connected",
    "edges",
)
def canonical_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published positions and identity affines of the tiles that the first tile reaches."""
    edges, root = A.edges(spark, sf_dir), _place(spark, "canonical")
    used = edges.withColumn("accepted", F.col("accepted") & (F.col("score") >= 7))
    tiles = used.select(F.col("fixed").alias("tile")).union(used.select("moving")).distinct()
    placed = tiles.select("tile", (F.col("tile") % 7 / 4).alias("z"), (F.floor(F.col("tile") / 25) / 4).alias("y"), (F.col("tile") % 25 / 4).alias("x"))
    G.publish_registration(placed, used, used, tiles.agg(F.min("tile")).first()[0], root, "exclude")
    rows = R.latest(spark, root, "tile long, z double, y double, x double, affine array<array<double>>")
    a = lambda i, j: F.col("affine")[i][j]
    # Affines are diagonal.
    return rows.select("tile", "z", "y", "x", (a(0, 0) * a(1, 1) * a(2, 2)).alias("determinant"), (a(0, 3) + a(1, 3) + a(2, 3)).alias("shift"))


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of acquisitions: a tile a box, a side a source, with two to four channels a side."""
    labels = F.slice(F.array(*[F.lit(c) for c in ("561", "488", "640", "405")]), 1, (2 + F.col("source") % 3).cast("int"))
    shape = F.array(2 + F.col("source") % 3, F.lit(8).cast("long"), 64 + F.col("source"), F.lit(64).cast("long"))
    spacing = F.array(F.lit(1.0), F.lit(0.25), F.lit(0.25))
    return A.boxes(spark, sf_dir).select(F.col("source").alias("side"), F.col("id").alias("tile"), F.lit("CZYX").alias("axes"), shape.alias("shape"), spacing.alias("spacing"), labels.alias("channels"), (F.col("hi") - F.col("lo")).alias("bytes"), F.array("lo", "y_lo").alias("stage"))


_FILES = "side long, tile long, axes string, shape array<long>, spacing array<double>, channels array<string>, bytes long, stage array<long>"


@JOBS.add(
    """select source as side, array_to_string((['561', '488', '640', '405'])[1 : 2 + source % 3], ',') as channels, (2 + source % 3) * 8 * (64 + source) * 64 as cells, count(*) as tiles, sum(hi - lo)::bigint as bytes
from boxes group by 1, 2, 3""",
    "boxes",
)
def acquisition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layout of each side, from the records of its files, which have to agree."""
    path = _place(spark, "files")
    _files(spark, sf_dir).write.json(path)
    sides = G.manifest(spark.read.schema(_FILES).json(path), "561")
    cells = F.aggregate("shape", F.lit(1).cast("long"), lambda p, n: p * n)
    return sides.select("side", F.array_join("channels", ",").alias("channels"), cells.alias("cells"), "tiles", "bytes")


@JOBS.add(
    """also held as (select source as side, id as tile, hi - lo as bytes, lo, y_lo from boxes),
later as (select side, tile, bytes + (tile % 97 = 0)::int as bytes, lo, y_lo from held union all select side, tile, bytes + (tile % 97 = 0)::int, lo, y_lo from held where tile % 89 = 0)
select side, 'gone' as change, count(*) as n, sum(tile)::bigint as tiles from (select * from held except all select * from later) group by 1
union all select side, 'new', count(*), sum(tile)::bigint from (select * from later except all select * from held) group by 1""",
    "boxes",
)
def acquisition_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published manifest against files of which some have grown and some are listed twice."""
    root, files = _place(spark, "manifest"), _files(spark, sf_dir)
    R.publish(files, root)
    grown = files.withColumn("bytes", F.col("bytes") + (F.col("tile") % 97 == 0).cast("int"))
    found = G.differences(R.latest(spark, root, _FILES), grown.union(grown.where("tile % 89 = 0")))
    return found.groupBy("side", "change").agg(F.sum("n").alias("n"), F.sum(F.col("tile") * F.col("n")).alias("tiles"))


for _name in ("registration_outcomes", "canonical_registration"):
    JOBS.sql[_name] = JOBS.sql[_name].replace("with edges", "with recursive edges", 1)
