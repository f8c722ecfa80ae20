"""Geometry jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import geometry as G
from chunkloom.sources import adapters as A

JOBS = Jobs()


_PAIRS = """select a.id as a, b.id as b, least(a.hi, b.hi) - greatest(a.lo, b.lo) as overlap_x, least(a.y_hi, b.y_hi) - greatest(a.y_lo, b.y_lo) as overlap_y
from boxes a join boxes b on a.id < b.id and a.lo < b.hi and b.lo < a.hi and a.y_lo < b.y_hi and b.y_lo < a.y_hi"""


@JOBS.add(_PAIRS, "boxes")
def box_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.box_pairs(A.boxes(spark, sf_dir), 64, 128).select("a", "b", "overlap_x", "overlap_y")


@JOBS.add(f"{_PAIRS} where a.source <> b.source and least(a.hi, b.hi) - greatest(a.lo, b.lo) >= 8", "boxes")
def cross_view_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = G.box_pairs(A.boxes(spark, sf_dir), 64, 128)
    return found.where((F.col("source") != F.col("other_source")) & (F.col("overlap_x") >= 8)).select("a", "b", "overlap_x", "overlap_y")


@JOBS.add(
    """select source, pos, sum(d) over (partition by source order by pos)::bigint as active from (select source, pos, sum(d) as d from (select source, lo as pos, 1 as d from boxes union all select source, hi, -1 from boxes) group by 1, 2)""",
    "boxes",
)
def active_interval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.active_counts(A.boxes(spark, sf_dir))


@JOBS.add(
    """also marked as (select *, case when lo > max(hi) over w or max(hi) over w is null then 1 else 0 end as new from boxes window w as (partition by source order by lo, hi, id rows between unbounded preceding and 1 preceding)),
numbered as (select *, sum(new) over (partition by source order by lo, hi, id) as k from marked)
select source, min(lo) as start, max(hi) as stop, count(*) as members from numbered group by source, k""",
    "boxes",
)
def merged_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.merged_windows(A.boxes(spark, sf_dir))


_BLOCKS = "also blocks as (select (z // 3)::int as kz, (y // 10)::int as ky, (x // 10)::int as kx, count(*) as held from voxels group by 1, 2, 3)"


@JOBS.add(
    f"""{_BLOCKS}, shape as (select max(z) + 1 as nz, max(y) + 1 as ny, max(x) + 1 as nx from voxels)
select kz, ky, kx, greatest(0, kz * 3 - 1) as z0, least(nz, kz * 3 + 4) as z1, greatest(0, ky * 10 - 1) as y0, least(ny, ky * 10 + 11) as y1, greatest(0, kx * 10 - 1) as x0, least(nx, kx * 10 + 11) as x1, held from blocks, shape""",
    "voxels",
)
def block_read_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.block_reads(A.voxels(spark, sf_dir), (3, 10, 10), 1)


@JOBS.add(
    f"""{_BLOCKS} select axis, p.kz, p.ky, p.kx, p.held, q.held as next_held from blocks p, (values (0, 1, 0, 0), (1, 0, 1, 0), (2, 0, 0, 1)) s(axis, dz, dy, dx)
join blocks q on q.kz = p.kz + dz and q.ky = p.ky + dy and q.kx = p.kx + dx""",
    "voxels",
)
def neighbour_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.neighbour_blocks(G.block_reads(A.voxels(spark, sf_dir), (3, 10, 10), 1))


@JOBS.add(
    """also shapes as (select p_partkey as volume, p_size::bigint as nz, (p_size * 3 % 17)::bigint as ny, (p_size * 5 % 23)::bigint as nx from part)
select volume, z0, least(z0 + 16, nz) as z1, y0, least(y0 + 8, ny) as y1, x0, least(x0 + 8, nx) as x1
from shapes, lateral (select unnest(range(0, nz, 16)) as z0), lateral (select unnest(range(0, ny, 8)) as y0), lateral (select unnest(range(0, nx, 8)) as x0)""".replace("also ", "with ", 1),
)
def chunk_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    return G.chunk_grid(A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("volume"), size.alias("nz"), (size * 3 % 17).alias("ny"), (size * 5 % 23).alias("nx")), (16, 8, 8))


@JOBS.add(
    """also levels as (select source, max(hi) // 7 as n from boxes group by 1),
placed as (select id, lo, least(greatest(round_even(lo / 7, 0)::bigint, 0), n - 1) as index from boxes join levels using (source))
select id, index, lo - index * 7 as off from placed""",
    "boxes",
)
def nearest_level_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = A.boxes(spark, sf_dir)
    levels = boxes.groupBy("source").agg(F.floor(F.max("hi") / 7).alias("count"))
    return G.nearest_level(boxes, levels, 7)
