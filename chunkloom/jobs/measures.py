"""Gate, profile and neighbourhood jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import measures as M
from chunkloom.sources import adapters as A

JOBS = Jobs()
_POINTS = "also points as (select id, source, lo as px, y_lo as py, hi - lo as peak from boxes)"
_NEAR = """(select a.id, min((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)) as d2 from points a join points b on a.source = b.source and a.id <> b.id
  and (a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py) <= 4096 group by 1)"""
_PROFILE = "also profile as (select tile as key, dz as bin, sum(score)::bigint as v from tracks group by 1, 2)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.boxes(spark, sf_dir).select("id", "source", F.col("lo").alias("px"), F.col("y_lo").alias("py"), (F.col("hi") - F.col("lo")).alias("peak"))


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.tracks(spark, sf_dir).groupBy(F.col("tile").alias("key"), F.col("dz").alias("bin")).agg(F.sum("score").alias("v"))


@JOBS.add(
    f"""{_POINTS} select p.id, d2 from points p left join (select a.id, min((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py)) as d2 from points a join points b on a.source = b.source and a.id <> b.id group by 1) n on n.id = p.id""",
    "boxes",
)
def nearest_point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.nearest_distance(_points(spark, sf_dir), 64, whole=True)


@JOBS.add(
    f"""{_POINTS} select id, inside, unsaturated, isolated, inside and unsaturated and isolated as good from (
  select p.id, px >= 20 and px < 9900 as inside, peak < 45 as unsaturated, coalesce(d2 > 900, true) as isolated from points p left join {_NEAR} n on n.id = p.id)""",
    "boxes",
)
def bead_quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.bead_flags(_points(spark, sf_dir), 20, 9920, 45, 30, 64)


@JOBS.add(
    """also sums as (select tile as vertex, dz as bin, sum(score)::bigint as total, count(*) as n from tracks group by 1, 2)
select centre, bin, sum(total)::bigint as total, sum(n)::bigint as n from (select t.vertex as centre, t.vertex + k as member from (select distinct vertex from sums) t, range(0, 4) r(k)) join sums on vertex = member group by 1, 2""",
    "tracks",
)
def neighbourhood_pooling(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = A.tracks(spark, sf_dir).groupBy(F.col("tile").alias("vertex"), F.col("dz").alias("bin")).agg(F.sum("score").alias("total"), F.count("*").alias("n"))
    near = sums.select(F.col("vertex").alias("centre")).distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3)))).select("centre", (F.col("centre") + F.col("k")).alias("member"))
    return M.pooled(sums, near)


@JOBS.add(
    """also sized as (select track as family, tile as "group", dz as id, count(*) over (partition by track, tile) as n from tracks), many as (select family, count(distinct "group") as g from sized group by 1)
select family, "group", count(*) as rows_held, round(min(1 / (g * n)), 12) as weight from sized join many using (family) group by 1, 2""",
    "tracks",
)
def group_balanced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tracks(spark, sf_dir).select(F.col("track").alias("family"), F.col("tile").alias("group"), F.col("dz").alias("id"))
    return M.balanced_weights(rows).groupBy("family", "group").agg(F.count("*").alias("rows_held"), F.round(F.min("weight"), 12).alias("weight"))


@JOBS.add(
    f"""{_PROFILE}, top as (select *, max(v) over (partition by key) as high from profile), peaks as (select key, min(bin) as peak from top where v = high group by 1)
select key, any_value(peak) as peak, min(bin) filter (where bin > peak and v * 100 <= high * 50) as crossing from top join peaks using (key) group by 1""",
    "tracks",
)
def peak_fraction_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.peak_crossing(_profile(spark, sf_dir), 50)


@JOBS.add(
    f"""{_PROFILE}, low as (select key, bin as least_bin from profile qualify row_number() over (partition by key order by v, bin) = 1)
select key, least_bin, bin as most_bin from profile join low using (key) where bin >= least_bin qualify row_number() over (partition by key order by v desc, bin) = 1""",
    "tracks",
)
def wall_turnarounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.turnaround(_profile(spark, sf_dir))


@JOBS.add(
    f"""{_PROFILE}, runs as (select key, bin, bin - row_number() over (partition by key order by bin) as k from profile where v % 3 > 0)
select key, start, stop from (select key, min(bin) as start, max(bin) + 1 as stop from runs group by key, k) qualify row_number() over (partition by key order by start) = 1""",
    "tracks",
)
def first_inside_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.first_run(_profile(spark, sf_dir).withColumn("inside", F.col("v") % 3 > 0))


@JOBS.add(
    """with stacks as (select p_partkey as stack, p_size::bigint as planes from part), cores as (select stack, planes, unnest(range(0, planes, 7)) as core_start from stacks)
select stack, core_start, least(core_start + 7, planes) as core_stop, greatest(core_start - 2, 0) as read_start, least(least(core_start + 7, planes) + 2, planes) as read_stop from cores"""
)
def slab_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacks = A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("stack"), F.col("p_size").cast("long").alias("planes"))
    return M.slab_windows(stacks, 7, 2)


@JOBS.add("select p_partkey as stack, p_size * i // 6 as start, p_size * (i + 1) // 6 as stop from part, range(0, 6) r(i) where p_size * (i + 1) // 6 > p_size * i // 6")
def plane_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    stacks = A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("stack"), F.col("p_size").cast("long").alias("planes"))
    return M.chunk_edges(stacks, 6)


@JOBS.add(
    """select fixed as key, count(*) filter (where score >= 5) as n, case when count(*) filter (where score >= 5) < 3 then 'unverified' when median(abs(shift)) filter (where score >= 5) <= 12 then 'verified' else 'contradicted' end as verdict from edges group by 1""",
    "edges",
)
def residual_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    planes = A.edges(spark, sf_dir).select(F.col("fixed").alias("key"), "shift", (F.col("score") >= 5).alias("sure"))
    return M.verdicts(planes, 3, 12)


_CELLS = """also cells as (select z, (y // 2)::int as y, (x // 2)::int as x, case when max(v) % 11 = 0 then 0 else 1 + ((y // 8) * 4 + (x // 8)) * 2 + case when (y // 2) % 4 in (1, 2) and (x // 2) % 4 in (1, 2) then 1 else 0 end end::bigint as label
  from voxels group by z, y // 2, x // 2, y // 8, x // 8)"""


@JOBS.add(
    f"""{_CELLS}, out_faces as (select v.z, v.label as own, v.y + dy as y, v.x + dx as x from cells v, (values (0, 1), (1, 0), (0, -1), (-1, 0)) s(dy, dx) where v.label > 0),
met as (select o.z, own, coalesce(w.label, 0) as near from out_faces o left join cells w on w.z = o.z and w.y = o.y and w.x = o.x where coalesce(w.label, 0) <> own)
select z, own as label, min(near) as around from met group by 1, 2 having min(near) = max(near) and min(near) > 0""",
    "voxels",
)
def encircled_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cores of 2 x 2 cells, each within a ring of its own, where no cell is missing or background."""
    y, x = F.floor(F.col("y") / 2).cast("int"), F.floor(F.col("x") / 2).cast("int")
    top = A.voxels(spark, sf_dir).groupBy("z", y.alias("y"), x.alias("x")).agg(F.max("v").alias("v"))
    core = ((F.col("y") % 4).isin(1, 2) & (F.col("x") % 4).isin(1, 2)).cast("long")
    ring = 1 + (F.floor(F.col("y") / 4) * 4 + F.floor(F.col("x") / 4)) * 2 + core
    return M.encircled(top.select("z", "y", "x", F.when(F.col("v") % 11 == 0, 0).otherwise(ring).cast("long").alias("label")))


@JOBS.add("also pairs as (select least(v0, v1) as a, greatest(v0, v1) as b from faces union all select least(v1, v2), greatest(v1, v2) from faces union all select least(v2, v0), greatest(v2, v0) from faces) select a, b from pairs group by 1, 2 having count(*) = 1", "faces")
def mesh_boundary_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mesh_boundary(A.faces(spark, sf_dir))


@JOBS.add("select lo // 500 as gx, y_lo // 500 as gy, round(median(ln((hi - lo + 3) / (id % 17 + 1))), 9) as ratio, count(*) as n from boxes group by 1, 2 having count(*) >= 3", "boxes")
def grid_log_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = A.boxes(spark, sf_dir).select(F.col("lo").alias("px"), F.col("y_lo").alias("py"), (F.col("hi") - F.col("lo") + 3).alias("num"), (F.col("id") % 17 + 1).alias("den"))
    return M.grid_ratios(points, 500, 3)


@JOBS.add("select c_custkey as id, c_name as name from customer where regexp_matches(c_name, '[0-9]*[02468]$') and not regexp_matches(c_name, '0$')")
def included_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.chosen_names(A.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "[0-9]*[02468]$", "0$")


@JOBS.add(
    """also planes as (select z, sum(v)::bigint as m, sum(v * y)::bigint as my, sum(v * x)::bigint as mx from voxels group by 1)
select z, round(my / m, 6) as centre_y, round(mx / m, 6) as centre_x from planes where m * 100 >= (select max(m) from planes) * 20""",
    "voxels",
)
def weighted_plane_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.weighted_centres(A.voxels(spark, sf_dir), 20)


@JOBS.add("select z, (y - 16) * (y - 16) + (x - 16) * (x - 16) as r2, round(sum(v) / count(*), 6) as mean, count(*) as n from voxels group by 1, 2", "voxels")
def radial_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.radial_means(A.voxels(spark, sf_dir), 16, 16)


@JOBS.add("select distinct l_orderkey as missing from lineitem except select o_orderkey from orders where o_orderkey % 10 > 0")
def unmatched_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one side that the other side lacks."""
    lines = A.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("missing")).distinct()
    known = A.table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 10 > 0).select(F.col("o_orderkey").alias("missing"))
    return lines.join(known, "missing", "left_anti")


@JOBS.add("select label // 8 as final, min(z) as z0, max(z) + 1 as z1, min(y) as y0, max(y) + 1 as y1, min(x) as x0, max(x) + 1 as x1 from voxels where label > 0 group by 1", "voxels")
def united_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of final labels from the boxes of their parts."""
    from chunkloom.operators import labels as L

    parts = L.bounding_boxes(A.voxels(spark, sf_dir)).withColumn("final", F.floor(F.col("label") / 8))
    return parts.groupBy("final").agg(*[e for c in "zyx" for e in (F.min(f"{c}0").alias(f"{c}0"), F.max(f"{c}1").alias(f"{c}1"))])


@JOBS.add("select tile, track, count(*) as n, count(*) filter (where valid) as valid, count(*) filter (where not valid and score >= 5) as sure_but_invalid, count(distinct dz) as shifts from tracks group by 1, 2", "tracks")
def track_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.tracks(spark, sf_dir)
    return rows.groupBy("tile", "track").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("valid"), 1)).alias("valid"), F.count(F.when(~F.col("valid") & (F.col("score") >= 5), 1)).alias("sure_but_invalid"), F.countDistinct("dz").alias("shifts")
    )


@JOBS.add("select c_name as name, regexp_extract(c_name, '([0-9]+)$', 1) as digits, try_cast(regexp_extract(c_name, '([0-9]+)$', 1) as bigint) as number from customer")
def tile_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trailing number of a name."""
    digits = F.regexp_extract("c_name", "([0-9]+)$", 1)
    return A.table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), digits.alias("digits"), digits.try_cast("long").alias("number"))
