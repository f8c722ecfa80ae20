"""Ranking and sampling jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import order as O
from chunkloom.sources import adapters as A

JOBS = Jobs()


@JOBS.add("select source, id, hi - lo as size, row_number() over (partition by source order by hi - lo desc, id)::int as rank from boxes qualify rank <= 5", "boxes")
def top_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.boxes(spark, sf_dir).withColumn("size", F.col("hi") - F.col("lo"))
    return O.top_signal(rows, "source", "size", "id", 5).select("source", "id", "size", "rank")


@JOBS.add(
    """also groups as (select channel as "group", count(*) as n from samples group by 1),
parts as (select *, (n * 101) // sum(n) over () as seats, (n * 101) % sum(n) over () as rest from groups)
select "group", n, (seats + case when row_number() over (order by rest desc, "group") <= 101 - sum(seats) over () then 1 else 0 end)::bigint as seats from parts""",
    "samples",
)
def largest_remainder_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = A.samples(spark, sf_dir).groupBy(F.col("channel").alias("group")).agg(F.count("*").alias("n"))
    return O.largest_remainder(groups, 101)


@JOBS.add("select distinct id, round_even(lo + (hi - 1 - lo) / 6 * i, 0)::bigint as pick from boxes, range(0, 7) r(i) where hi > lo", "boxes")
def evenly_spaced_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.evenly_spaced(A.boxes(spark, sf_dir).select("id", F.col("lo").alias("start"), F.col("hi").alias("stop")), 7)


@JOBS.add("select distinct id, least(greatest(lo % 50 + k * 3, 0), 49)::bigint as z from boxes, range(-2, 3) r(k)", "boxes")
def context_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks = A.boxes(spark, sf_dir).select("id", (F.col("lo") % 50).alias("pick"))
    return O.with_context(picks, 3, 2, F.lit(50)).select("id", F.col("z").cast("long").alias("z"))


@JOBS.add("select source, id, row_number() over (partition by source order by id)::int as turn from boxes", "boxes")
def round_robin_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.round_robin(A.boxes(spark, sf_dir), "source", "id").select("source", "id", F.col("turn").cast("int").alias("turn"))


@JOBS.add(
    """also ends as (select source, min(lo) as a, max(lo) + 1 as b from boxes group by 1),
placed as (select source, lo, floor((lo - a) * 9 / (b - a))::bigint as stratum from boxes join ends using (source))
select source, stratum, lo as pick from placed qualify row_number() over (partition by source, stratum order by lo * 2654435761 % 4294967296, lo) = 1""",
    "boxes",
)
def stratified_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.strata(A.boxes(spark, sf_dir), "lo", "source", 9)


@JOBS.add("select id, ('0x' || substr(md5(id::varchar), 1, 8))::bigint % 5 as fold from boxes", "boxes")
def source_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.pair_folds(A.boxes(spark, sf_dir), "id", 5).select("id", "fold")


_TILES = "also tiles as (select distinct y // 4 as row, x as col from voxels)"


@JOBS.add(f"{_TILES} select row::bigint as row, col, (row_number() over (partition by row order by case when row % 2 = 0 then col else -col end) - 1)::int as place from tiles", "voxels")
def snake_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = A.voxels(spark, sf_dir).select(F.floor(F.col("y") / 4).alias("row"), F.col("x").alias("col")).distinct()
    return O.snake(tiles)


_OWNERS = "also owners as (select y, x, max(z) as owner, arg_max(v, z) as v from voxels where label > 0 group by 1, 2)"


@JOBS.add(f"{_OWNERS} select * from owners", "voxels")
def last_writer_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.last_writer(A.voxels(spark, sf_dir).where(F.col("label") > 0).withColumnRenamed("z", "tile"))


@JOBS.add(
    f"""{_OWNERS} select p.y, p.x, p.owner from owners p where exists (select 1 from owners q where q.owner <> p.owner and abs(p.y - q.y) + abs(p.x - q.x) = 1)""", "voxels"
)
def seam_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.seam_pixels(O.last_writer(A.voxels(spark, sf_dir).where(F.col("label") > 0).withColumnRenamed("z", "tile")))


@JOBS.add(
    "select source, hi - lo as width, y_hi - y_lo as height, count(*) as n from boxes group by 1, 2, 3 qualify row_number() over (partition by source order by n desc, width, height) = 1", "boxes"
)
def modal_box_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.modal_size(A.boxes(spark, sf_dir))


@JOBS.add(
    """also sorted as (select source, lo, hi, row_number() over (partition by source order by hi, lo) as k from boxes where hi > lo),
walk(source, k, plane, fresh) as (
  select source, k, hi - 1, true from sorted where k = 1
  union all
  select s.source, s.k, case when w.plane >= s.lo then w.plane else s.hi - 1 end, w.plane < s.lo from walk w join sorted s on s.source = w.source and s.k = w.k + 1)
select distinct source, plane from walk where fresh""",
    "boxes",
)
def stabbing_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.greedy_stabbing(A.boxes(spark, sf_dir))


JOBS.sql["stabbing_planes"] = JOBS.sql["stabbing_planes"].replace("with boxes", "with recursive boxes", 1)
