"""Fusion, surface, sampling and gate jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions import scalars
from chunkloom.jobs.base import Jobs
from chunkloom.operators import labels as L
from chunkloom.operators import sampling as M
from chunkloom.operators import volumes as V
from chunkloom.operators.ranges import numbered
from chunkloom.sources import adapters as A

JOBS = Jobs()


@JOBS.add(
    """also views as (select z // 2 as z, y, x, v, 1 + least(y % 8, 7 - y % 8) * (1 + z % 2) as weight from voxels)
select z, y, x, round(sum(weight * v) / sum(weight), 6) as v, count(*) as n from views where weight > 0 group by 1, 2, 3""",
    "voxels",
)
def fused_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring planes as two views, weighted by the distance from a block's edge."""
    weight = 1 + F.least(F.col("y") % 8, 7 - F.col("y") % 8) * (1 + F.col("z") % 2)
    views = A.voxels(spark, sf_dir).select((F.col("z") % 2).alias("view"), F.floor(F.col("z") / 2).alias("z"), "y", "x", "v", weight.alias("weight"))
    return V.fused(views).withColumn("v", F.round("v", 6))


_SECOND = "second as (select z, y, x, v // 3 as w from voxels where label % 4 > 0)"


@JOBS.add(
    f"""also {_SECOND}, both_sides as (select a.z, a.v, w from (select z, y, x, case when label = 0 then 0 else v end as v from voxels) a left join second using (z, y, x)),
done as (select z, v, v > 0 and coalesce(w > 0, false) as ok, greatest(round_even(v - 0.5 * w - 100, 0), 0)::bigint as less from both_sides)
select z, count(*) filter (where ok) as supported, sum(case when ok then less else 0 end)::bigint as zeroed, sum(case when ok then less else v end)::bigint as kept from done group by z""",
    "voxels",
)
def subtracted_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A share of a second channel taken off, with both treatments of voxels without support."""
    voxels = A.voxels(spark, sf_dir)
    target = voxels.select("z", "y", "x", F.when(F.col("label") == 0, 0).otherwise(F.col("v")).alias("v"))
    second = voxels.where(F.col("label") % 4 > 0).select("z", "y", "x", F.floor(F.col("v") / 3).alias("v"))
    zeroed, kept = (V.subtracted(target, second, 0.5, 100.0, keep) for keep in (False, True))
    held = target.join(second.select("z", "y", "x", F.col("v").alias("w")), ["z", "y", "x"], "left").groupBy("z").agg(F.count_if((F.col("v") > 0) & (F.col("w") > 0)).alias("supported"))
    sums = [t.groupBy("z").agg(F.sum("v").alias(n)) for t, n in ((zeroed, "zeroed"), (kept, "kept"))]
    return held.join(sums[0], "z").join(sums[1], "z")


@JOBS.add(
    """also both_sides as (select a.z, a.y // 8 as py, a.x // 8 as px, ln(b.v / a.v) as r from voxels a join voxels b on b.z = a.z + 1 and b.y = a.y and b.x = a.x where a.v > 0 and b.v > 0),
mid as (select z, py, px, count(*) as n, median(r) as m from both_sides group by 1, 2, 3 having count(*) >= 12)
select z, py, px, any_value(n) as n, round(any_value(m), 9) as ratio, round(median(abs(r - m)), 9) as mad from both_sides join mid using (z, py, px) group by 1, 2, 3""",
    "voxels",
)
def patch_log_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each plane against the next, by patches."""
    voxels = A.voxels(spark, sf_dir)
    found = V.patch_ratios(voxels, voxels.withColumn("z", F.col("z") - 1), 8, 12)
    return found.withColumns({c: F.round(c, 9) for c in ("ratio", "mad")})


@JOBS.add("select y + z % 5 * 7 as y, x + z // 5 % 5 * 11 as x, max(v) as top, round(sum(v) / count(*), 6) as mean, count(*) as n from voxels group by 1, 2", "voxels")
def placed_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planes as tiles, placed by their stage positions alone."""
    planes = A.voxels(spark, sf_dir).select(F.col("z").alias("tile"), "y", "x", "v", (F.col("z") % 5 * 7).alias("y0"), (F.floor(F.col("z") / 5) % 5 * 11).alias("x0"))
    return V.composite(planes).withColumn("mean", F.round("mean", 6))


@JOBS.add(
    """select kx, ky, count(*) as n, min(id) as first from (select id, kx, unnest(range((y_lo - 8) // 100 - case when (y_lo - 8) < 0 and (y_lo - 8) % 100 <> 0 then 1 else 0 end, (y_hi - 1 + 8) // 100 + 1)) as ky
  from (select *, unnest(range((lo - 8) // 100 - case when (lo - 8) < 0 and (lo - 8) % 100 <> 0 then 1 else 0 end, (hi - 1 + 8) // 100 + 1)) as kx from boxes where hi > lo and y_hi > y_lo)) where kx >= 0 and ky >= 0 group by 1, 2""",
    "boxes",
)
def block_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.block_sources(A.boxes(spark, sf_dir), 100, 100, 8)


@JOBS.add(
    """also rays as (select z // 6 as ray, y, x, 5 - z % 6 as step, v from voxels), near as (select *, row_number() over (partition by ray, y, x order by step) - 1 as k from rays)
select ray, y, x, max(v) as v, count(*) as steps from near where k = step group by 1, 2, 3""",
    "voxels",
)
def ray_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ray_maxima(A.voxels(spark, sf_dir), 6)


@JOBS.add(
    """also sums as (select z, y // 8 as ky, x // 8 as kx, count(*) as n, sum(v)::bigint as s, sum(v::hugeint * v)::double as q from voxels group by 1, 2, 3),
scored as (select ky, kx, z, round(q * n / (s::double * s) - 1, 9) as energy from sums where s > 0)
select ky, kx, z, energy from scored qualify row_number() over (partition by ky, kx order by energy desc, z) = 1""",
    "voxels",
)
def sharpest_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.sharpest(A.voxels(spark, sf_dir), 8)


@JOBS.add(
    """with cells as (select o_orderkey as cell, o_orderkey % 9 as a, o_custkey % 11 as b, o_orderkey // 50 * 64 + o_custkey % 40 as v0, o_orderkey // 50 * 64 + o_orderkey * 7 % 37 as v1, o_orderkey // 50 * 64 + o_orderkey * 11 % 31 as v2 from orders)
select cell, round((a * (v0 * 37 % 101) + b * (v1 * 37 % 101) + (20 - a - b) * (v2 * 37 % 101)) / 20, 9) as value from cells"""
)
def values_on_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of vertices at points within faces."""
    orders, key = A.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    piece, corners = F.floor(key / 50) * 64, [F.col("o_custkey") % 40, key * 7 % 37, key * 11 % 31]
    faces = orders.select(key.alias("face"), *[(piece + c).alias(f"v{i}") for i, c in enumerate(corners)])
    a, b = key % 9, F.col("o_custkey") % 11
    cells = orders.select(key.alias("cell"), key.alias("face"), (a / 20).alias("b0"), (b / 20).alias("b1"), ((20 - a - b) / 20).alias("b2"))
    vertices = faces.select(F.explode(F.array("v0", "v1", "v2")).alias("vertex")).distinct().withColumn("value", (F.col("vertex") * 37 % 101).cast("double"))
    return V.on_faces(cells, faces, vertices).withColumn("value", F.round("value", 9))


@JOBS.add(
    """select id, round(sqrt(dx * dx + dy * dy + dz * dz), 6) as depth, (dx * 0.6 + dy * 0.8 <= 0) and id % 9 > 0 and sqrt(dx * dx + dy * dy + dz * dz) <= 30 as inside
from (select id, (lo % 41) - 20.0::double as dx, (y_lo % 31) - 15.0::double as dy, (id % 7)::double as dz from boxes)""",
    "boxes",
)
def tissue_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda c, n: c.cast("double").alias(n)
    points = A.boxes(spark, sf_dir).select(
        "id", one(F.col("lo") % 41, "px"), one(F.col("y_lo") % 31, "py"), one(F.col("id") % 7, "pz"), F.lit(20.0).alias("qx"), F.lit(15.0).alias("qy"), F.lit(0.0).alias("qz"),
        F.lit(0.6).alias("nx"), F.lit(0.8).alias("ny"), F.lit(0.0).alias("nz"), (F.col("id") % 9 == 0).alias("rim"),
    )
    return V.on_tissue_side(points, 30.0).select("id", F.round("depth", 6).alias("depth"), "inside")


@JOBS.add(
    """also links as (select distinct fixed as a, moving as b from edges where accepted), steps as (select a, b from links union select b, a from links),
donors as (select fixed as node from edges where accepted group by 1 having sum(score) >= 140),
reach(node, donor, steps) as (select node, node, 0 from donors union select b, donor, reach.steps + 1 from reach join steps on a = node where reach.steps < 6)
select node, steps, min(donor) as donor from reach r where steps = (select min(steps) from reach s where s.node = r.node) group by 1, 2""",
    "edges",
)
def nearest_donors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The well measured tile nearest to each tile by links."""
    kept = A.edges(spark, sf_dir).where("accepted")
    donors = kept.groupBy(F.col("fixed").alias("node")).agg(F.sum("score").alias("s")).where("s >= 140").select("node")
    return V.nearest_donors(kept.select(F.col("fixed").alias("a"), F.col("moving").alias("b")), donors).where("steps <= 6").select("node", "steps", "donor")


JOBS.sql["nearest_donors"] = JOBS.sql["nearest_donors"].replace("with edges", "with recursive edges", 1)


@JOBS.add(
    "select id, round(exp(0.3 * power(greatest(1 - y / 0.2, 0), 2) - 0.2 * power(greatest(1 - (1 - y) / 0.2, 0), 2) + 0.1 * power(greatest(1 - x / 0.2, 0), 2) - 0.4 * power(greatest(1 - (1 - x) / 0.2, 0), 2)), 9) as gain from (select id, (lo % 101) / 100 as y, (y_lo % 101) / 100 as x from boxes)",
    "boxes",
)
def edge_ramp_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    gain = V.edge_ramps((F.col("lo") % 101) / 100, (F.col("y_lo") % 101) / 100, 0.2, (0.3, -0.2, 0.1, -0.4))
    return A.boxes(spark, sf_dir).select("id", F.round(gain, 9).alias("gain"))


_MODES = [(a, b) for a in range(3) for b in range(3) if 0 < a + b < 3]


@JOBS.add(
    "select id, round(v * exp(" + " + ".join(f"{0.01 * (k + 1)} * cos(pi() * {a} * y) * cos(pi() * {b} * x) * cos(pi() * {d} * z) / {1 + d * d}" for k, (d, a, b) in enumerate((d, a, b) for d in range(2) for a, b in _MODES)) + "), 6) as v from (select id, hi - lo as v, (lo % 101) / 100 as y, (y_lo % 101) / 100 as x, (id % 11) / 10 as z from boxes)",
    "boxes",
)
def cosine_field_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values times the exponential of a field of cosines."""
    modes = V.cosine_modes((F.col("lo") % 101) / 100, (F.col("y_lo") % 101) / 100, (F.col("id") % 11) / 10, 1)
    field = sum((0.01 * (k + 1) * m for k, m in enumerate(modes)), F.lit(0.0))
    return A.boxes(spark, sf_dir).select("id", F.round((F.col("hi") - F.col("lo")) * F.exp(field), 6).alias("v"))


@JOBS.add("select p_partkey as stack, z from part, lateral (select unnest(range(0, p_size)) as z) order by md5('7:' || p_partkey || ':' || z), stack, z limit 300")
def sampled_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """300 planes, the sample's stated size."""
    stacks = A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("stack"), F.col("p_size").cast("long").alias("planes"))
    return M.uniform_planes(stacks, 300, "7")


@JOBS.add("select id, cx as c0, cy as c1 from (select id, lo // 500 as cx, y_lo // 200 as cy, md5('5:' || id) as d from boxes qualify row_number() over (partition by lo // 500, y_lo // 200 order by md5('5:' || id), id) = 1) order by d, id limit 40", "boxes")
def random_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 boxes, the sample's stated size, at most one a cell."""
    return M.random_crops(A.boxes(spark, sf_dir), [F.floor(F.col("lo") / 500), F.floor(F.col("y_lo") / 200)], 40, "5")


@JOBS.add(
    """also starts as (select id, e, axis, floor(greatest(e - 12, 0) * i / 4)::bigint as s from (select id, hi - lo as e, 'x' as axis from boxes union all select id, y_hi - y_lo, 'y' from boxes), range(0, 5) r(i)),
grid as (select y.id, y.s as y, x.s as x, row_number() over (partition by y.id order by y.s, x.s) - 1 as k from (select distinct id, s from starts where axis = 'y') y join (select distinct id, s from starts where axis = 'x') x using (id))
select id, k::int as k, y, x from grid where k < 9""",
    "boxes",
)
def patch_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = A.boxes(spark, sf_dir).select("id", (F.col("hi") - F.col("lo")).alias("width"), (F.col("y_hi") - F.col("y_lo")).alias("height"))
    return M.patch_grid(boxes, 12, 5, 9)


@JOBS.add(
    """also blocks as (select z, y // 8 as ky, x // 8 as kx, count(*) filter (where label > 0) as held, sum(v)::bigint as v from voxels group by 1, 2, 3)
select z, ky, kx, held, v from blocks qualify row_number() over (partition by z order by held desc, v desc, ky, kx) <= 3""",
    "voxels",
)
def content_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.content_crops(A.voxels(spark, sf_dir), 8, 3)


@JOBS.add(
    """also chunks as (select tile as stack, (dz + 25) // 6 as c, count(distinct dz) as n, min(dz + 25) as first, max(dz + 25) as last, row_number() over (partition by tile order by (dz + 25) // 6) as k from tracks group by 1, 2),
walk(stack, k, batch, first, last, n) as (
  select stack, k, 0, first, last, n from chunks where k = 1
  union all
  select c.stack, c.k, case when w.n >= 9 then w.batch + 1 else w.batch end, case when w.n >= 9 then c.first else w.first end, c.last, case when w.n >= 9 then c.n else w.n + c.n end from walk w join chunks c on c.stack = w.stack and c.k = w.k + 1)
select stack, batch, min(first) as first, max(last) as last, max(n) as n from walk group by 1, 2""",
    "tracks",
)
def chunk_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.chunk_batches(A.tracks(spark, sf_dir).select(F.col("tile").alias("stack"), (F.col("dz") + 25).alias("i")).distinct(), 6, 9)


JOBS.sql["chunk_batches"] = JOBS.sql["chunk_batches"].replace("with tracks", "with recursive tracks", 1)


@JOBS.add(
    """also crops as (select z, y // 8 as cy, x // 8 as cx, quantile_cont(v, 0.01) as lo, quantile_cont(v, 0.99) as hi, avg((label = 0)::int) as empty from voxels group by 1, 2, 3)
select z, count(*) as crops, round(avg(lo), 6) as low, round(avg(hi), 6) as high from crops where empty <= 0.35 group by 1""",
    "voxels",
)
def crop_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.crop_ranges(A.voxels(spark, sf_dir), 8, 0.01, 0.99, 0.35).withColumns({c: F.round(c, 6) for c in ("low", "high")})


@JOBS.add("select p_partkey as id, unnest(range(p_size % 10, p_size + 1, 7)) / 10 as level from part")
def compression_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    return M.levels(A.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), (size % 10).alias("low"), size.alias("high")), 7)


@JOBS.add("select id, (dense_rank() over (order by lo // 300 * 1000000 + y_lo // 300) - 1) % 5 as fold from boxes", "boxes")
def spatial_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole blocks of space in a fold."""
    rows = A.boxes(spark, sf_dir).select("id", (F.floor(F.col("lo") / 300) * 1_000_000 + F.floor(F.col("y_lo") / 300)).alias("label"))
    order = L.dense_labels(rows.groupBy("label").agg(F.count("*").alias("area")), 1)
    return rows.join(order, "label").select("id", ((F.col("final") - 1) % 5).alias("fold"))


@JOBS.add(
    """select id, stable, accepted, case when accepted then round(case when stable then 0.05 else greatest(0.05, improvement) end * least(a, b) * greatest(peak, 0), 9) else 0 end as weight
from (select *, before >= 0.6 and abs(shift) <= 3 as stable, (before >= 0.6 and abs(shift) <= 3) or improvement >= 0.05 as accepted
  from (select l_orderkey * 10 + l_linenumber as id, round(l_tax * 100) / 10 as before, round(l_discount * 100) / 10 - 0.4 as peak, (round(l_discount * 100) - round(l_tax * 100)) / 20 as improvement, round(l_quantity) - 25 as shift, (l_partkey % 10) / 10 as a, (l_suppkey % 10) / 10 as b from lineitem))"""
)
def boundary_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted patches: aligned before, or clearly better after; weights by evidence, content and peak."""
    tax, off = F.round(F.col("l_tax") * 100), F.round(F.col("l_discount") * 100)
    rows = A.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), (tax / 10).alias("before"), (off / 10 - 0.4).alias("peak"), ((off - tax) / 20).alias("improvement"),
        (F.round("l_quantity") - 25).alias("shift"), F.least(F.col("l_partkey") % 10 / 10, F.col("l_suppkey") % 10 / 10).alias("content"),
    )
    stable = (F.col("before") >= 0.6) & (F.abs("shift") <= 3)
    rows = rows.withColumn("stable", stable).withColumn("accepted", F.col("stable") | (F.col("improvement") >= 0.05))
    evidence = F.when(F.col("stable"), 0.05).otherwise(F.greatest(F.lit(0.05), F.col("improvement")))
    return rows.select("id", "stable", "accepted", F.when(F.col("accepted"), F.round(evidence * F.col("content") * F.greatest("peak", F.lit(0.0)), 9)).otherwise(0.0).alias("weight"))


@JOBS.add(
    """also rows as (select fixed, accepted, reason, score, shift from edges),
found as (select fixed, unnest(case when accepted then list_filter([case when abs(shift) > 15 then 'unverified' end, case when score = 3 then 'withheld' end, case when score < 3 then 'no_evidence' end], lambda d: d is not null) when reason = 'same_tile' then [] else ['uncovered'] end) as defect from rows)
select fixed, defect, count(*) as n from found group by 1, 2""",
    "edges",
)
def recovery_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every defect of each window."""
    own = F.array_compact(F.array(F.when(F.abs("shift") > 15, "unverified"), F.when(F.col("score") == 3, "withheld"), F.when(F.col("score") < 3, "no_evidence")))
    none = F.array().cast("array<string>")
    defects = F.when(F.col("accepted"), own).when(F.col("reason") == "same_tile", none).otherwise(F.array(F.lit("uncovered")))
    return A.edges(spark, sf_dir).select("fixed", F.explode(defects).alias("defect")).groupBy("fixed", "defect").agg(F.count("*").alias("n"))


@JOBS.add("select fixed, count(*) filter (where not accepted and reason <> 'same_tile' and score / 9 < 0.5) as seedable from edges group by 1", "edges")
def seedable_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_ = ~F.col("accepted") & (F.col("reason") != "same_tile") & (F.col("score") / 9 < 0.5)
    return A.edges(spark, sf_dir).groupBy("fixed").agg(F.count_if(open_).alias("seedable"))


@JOBS.add("select z, y // 16 as ky, x // 16 as kx, min(label) <> 0 or max(label) <> 0 as filled, count(*) filter (where label = 0) * 100 > count(*) * 30 as too_empty from voxels group by 1, 2, 3", "voxels")
def tile_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that hold anything but fill, and tiles with too many zeros to train on."""
    at = [F.floor(F.col(c) / 16).alias(f"k{c}") for c in "yx"]
    empty = F.count_if(F.col("label") == 0) * 100 > F.count("*") * 30
    return A.voxels(spark, sf_dir).groupBy("z", *at).agg(((F.min("label") != 0) | (F.max("label") != 0)).alias("filled"), empty.alias("too_empty"))


@JOBS.add(
    """also vectors as (select fixed, moving, coalesce(avg(shift) filter (where axis = 0), 0) as z, coalesce(avg(shift) filter (where axis = 1), 0) as y, coalesce(avg(shift) filter (where axis = 2), 0) as x from edges where accepted group by 1, 2),
norms as (select fixed // 40 as part, z, sqrt(z * z + y * y + x * x) as norm from vectors)
select part, count(*) as n, round(median(norm), 9) as median_norm, round(quantile_cont(norm, 0.95), 9) as p95_norm, round(max(norm), 9) as max_norm, round(median(abs(z)), 9) as median_z, round(max(abs(z)), 9) as max_z from norms group by 1""",
    "edges",
)
def residual_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Norms of residual vectors, by parts of the mosaic."""
    axis = lambda k: F.coalesce(F.avg(F.when(F.col("axis") == k, F.col("shift"))), F.lit(0.0))
    vectors = A.edges(spark, sf_dir).where("accepted").groupBy("fixed", "moving").agg(*[axis(k).alias(c) for k, c in enumerate("zyx")])
    rows = vectors.select(F.floor(F.col("fixed") / 40).alias("part"), F.abs("z").alias("z"), F.sqrt(sum((F.col(c) * F.col(c) for c in "zyx"), F.lit(0.0))).alias("norm"))
    r = lambda c, n: F.round(c, 9).alias(n)
    return rows.groupBy("part").agg(F.count("*").alias("n"), r(F.median("norm"), "median_norm"), r(F.percentile("norm", F.lit(0.95)), "p95_norm"), r(F.max("norm"), "max_norm"), r(F.median("z"), "median_z"), r(F.max("z"), "max_z"))


@JOBS.add("select user_id, count(*) filter (where event_type = 'purchase') as accepted, count(*) filter (where event_type = 'error') as error, count(*) filter (where event_type not in ('purchase', 'error')) as other, count(*) as n from events group by 1")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", "accepted").when(F.col("event_type") == "error", "error").otherwise("other")
    return A.table(spark, sf_dir, "events").groupBy("user_id").agg(*[F.count_if(kind == k).alias(k) for k in ("accepted", "error", "other")], F.count("*").alias("n"))


@JOBS.add(
    """also ends as (select fixed as tile, moving as other, accepted from edges where fixed <> moving union all select moving, fixed, accepted from edges where fixed <> moving),
deg as (select tile, count(distinct other) filter (where accepted and score_ok) as degree, count(distinct other) as measured from (select *, true as score_ok from ends) group by 1)
select tile, degree, measured, degree = 0 as apart, measured < 4 as at_edge from deg where degree = 0 or measured < 4""",
    "edges",
)
def disconnected_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles without an accepted constraint, and tiles at the edge of what was measured: the first have to be among the second."""
    edges = A.edges(spark, sf_dir).where(F.col("fixed") != F.col("moving"))
    ends = edges.select(F.col("fixed").alias("tile"), F.col("moving").alias("other"), "accepted").union(edges.select("moving", "fixed", "accepted"))
    found = ends.groupBy("tile").agg(F.countDistinct(F.when(F.col("accepted"), F.col("other"))).alias("degree"), F.countDistinct("other").alias("measured"))
    return found.select("tile", "degree", "measured", (F.col("degree") == 0).alias("apart"), (F.col("measured") < 4).alias("at_edge")).where(F.col("apart") | F.col("at_edge"))


@JOBS.add("select fixed, moving, axis, score, count(*) as n from edges group by 1, 2, 3, 4 having count(*) > 1", "edges")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.edges(spark, sf_dir).groupBy("fixed", "moving", "axis", "score").agg(F.count("*").alias("n")).where("n > 1")


@JOBS.add("select c_name as moving, s_name as fixed, c_custkey as id from customer join supplier on regexp_extract(c_name, '([0-9]+)$', 1) = regexp_extract(s_name, '([0-9]+)$', 1) where replace(s_name, 'Supplier', 'Customer') = c_name")
def corresponding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of two acquisitions, met by the number in their names; the derived name has to be the other's."""
    number = lambda c: F.regexp_extract(c, "([0-9]+)$", 1).alias("number")
    moving = A.table(spark, sf_dir, "customer").select(F.col("c_name").alias("moving"), F.col("c_custkey").alias("id"), number("c_name"))
    fixed = A.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("fixed"), number("s_name"))
    return moving.join(fixed, "number").where(F.replace(F.col("fixed"), F.lit("Supplier"), F.lit("Customer")) == F.col("moving")).select("moving", "fixed", "id")


@JOBS.add(
    """select 'left' as side, s_suppkey as tile, row_number() over (order by s_suppkey) - 1 as index from supplier
union all select 'right', c_custkey, row_number() over (order by c_custkey) - 1 + (select count(*) from supplier) from customer"""
)
def joined_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two registrations in one list, numbered on."""
    left = A.table(spark, sf_dir, "supplier").select(F.lit("left").alias("side"), F.col("s_suppkey").alias("tile"))
    right = A.table(spark, sf_dir, "customer").select(F.lit("right").alias("side"), F.col("c_custkey").alias("tile"))
    before = left.agg(F.count("*").alias("before"))  # one row
    rows = numbered(left.unionByName(right), "side", "tile", "k").crossJoin(F.broadcast(before))
    return rows.select("side", "tile", (F.col("k") - 1 + F.when(F.col("side") == "right", F.col("before")).otherwise(0)).alias("index"))


@JOBS.add("select id, unit, round(size::double * case unit when 'nm' then 0.001 when 'um' then 1.0 when 'mm' then 1000.0 when 'm' then 1000000.0 end::double, 6) as um from (select id, (['nm', 'um', 'mm', 'm'])[id % 4 + 1] as unit, hi - lo as size from boxes)", "boxes")
def lengths_in_microns(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*[F.lit(u) for u in scalars.MICRONS]), (F.col("id") % 4 + 1).cast("int"))
    return A.boxes(spark, sf_dir).select("id", unit.alias("unit"), F.round(scalars.microns(F.col("hi") - F.col("lo"), unit), 6).alias("um"))


@JOBS.add("select id, case when n < 1024 then printf('%d B', n) when n < 1048576 then printf('%.1f KiB', n / 1024) when n < 1073741824 then printf('%.1f MiB', n / 1048576) else printf('%.1f GiB', n / 1073741824) end as size from (select id, lo * lo * (id % 50) as n from boxes)", "boxes")
def readable_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.boxes(spark, sf_dir).select("id", scalars.human_bytes(F.col("lo") * F.col("lo") * (F.col("id") % 50)).alias("size"))


@JOBS.add("select id, round(100 + 0.8 * (lo::double * 0.5) - 0.6 * (y_lo::double * 0.5), 6) as wx, round(50 + 0.6 * (lo::double * 0.5) + 0.8 * (y_lo::double * 0.5), 6) as wy, lo as ix, y_lo as iy from boxes", "boxes")
def world_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexes to positions by origin, spacing and direction, and back."""
    x, y = scalars.to_world(F.col("lo"), F.col("y_lo"), (100.0, 50.0), 0.5, (0.8, 0.6))
    back = scalars.to_index(x, y, (100.0, 50.0), 0.5, (0.8, 0.6))
    return A.boxes(spark, sf_dir).select("id", F.round(x, 6).alias("wx"), F.round(y, 6).alias("wy"), *[F.round(v).cast("long").alias(n) for v, n in zip(back, ("ix", "iy"))])


@JOBS.add("select id, wave, case when n = 1 then label end as label from (select id, wave, count(*) filter (where abs(wave - nominal) <= 12) as n, min(label) filter (where abs(wave - nominal) <= 12) as label from (select id, 400 + lo % 300 as wave from boxes), (values (405, 'a'), (488, 'b'), (500, 'c'), (561, 'd'), (640, 'e')) t(nominal, label) group by 1, 2)", "boxes")
def channel_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nominal labels of emission wavelengths, where exactly one is within the tolerance."""
    known = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c")) for n, c in ((405, "a"), (488, "b"), (500, "c"), (561, "d"), (640, "e"))])
    near = F.filter(known, lambda k: F.abs(F.col("wave") - k["n"]) <= 12)
    return A.boxes(spark, sf_dir).select("id", (400 + F.col("lo") % 300).alias("wave")).select("id", "wave", F.when(F.size(near) == 1, near[0]["c"]).alias("label"))


@JOBS.add("select source, id, (dense_rank() over (partition by source order by y_lo // 50) - 1)::bigint as row, (dense_rank() over (partition by source order by lo // 50) - 1)::bigint as col from boxes", "boxes")
def mosaic_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of tiles by the order of the distinct positions of their source."""
    boxes = A.boxes(spark, sf_dir).select("source", "id", F.floor(F.col("y_lo") / 50).alias("y"), F.floor(F.col("lo") / 50).alias("x"))
    out = boxes
    for axis, name in (("y", "row"), ("x", "col")):
        out = out.join(numbered(boxes.select("source", axis).distinct(), "source", axis, name), ["source", axis])
    return out.select("source", "id", (F.col("row") - 1).alias("row"), (F.col("col") - 1).alias("col"))


@JOBS.add(
    """select band, count(*) as n, case when count(*) >= 8 and count(*) * sum(a * a) > sum(a) * sum(a) and count(*) * sum(b * b) > sum(b) * sum(b)
  then round((count(*) * sum(a * b) - sum(a) * sum(b))::double / sqrt((count(*) * sum(a * a) - sum(a) * sum(a))::double * (count(*) * sum(b * b) - sum(b) * sum(b))::double), 9) end as r from bands group by 1""",
    "bands",
)
def overlap_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of both sides of each overlap, from whole-number sums."""
    s = {n: F.sum(c) for n, c in (("a", F.col("a")), ("b", F.col("b")), ("aa", F.col("a") * F.col("a")), ("bb", F.col("b") * F.col("b")), ("ab", F.col("a") * F.col("b")))}
    sums = A.bands(spark, sf_dir).groupBy("band").agg(F.count("*").alias("n"), *[v.alias(k) for k, v in s.items()])
    n = F.col("n")
    va, vb = n * F.col("aa") - F.col("a") * F.col("a"), n * F.col("bb") - F.col("b") * F.col("b")
    r = (n * F.col("ab") - F.col("a") * F.col("b")).cast("double") / F.nullif(F.sqrt(va.cast("double") * vb.cast("double")), F.lit(0.0))
    return sums.select("band", "n", F.when((n >= 8) & (va > 0) & (vb > 0), F.round(r, 9)).alias("r"))


def _clipped_sql(points: str, axis: str, bound: str, above: bool) -> str:
    """A polygon's part on one side of a bound, as a list; the SQL goes over positions."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: f"({p}.{axis} >= {bound})" if above else f"({p}.{axis} < {bound})"
    now, before = "p[i]", "p[case when i = 1 then len(p) else i - 1 end]"
    at = f"({before}).{other} + ({bound} - ({before}).{axis}) / (({now}).{axis} - ({before}).{axis}) * (({now}).{other} - ({before}).{other})"
    cross = f"{{'x': {bound if axis == 'x' else at}, 'y': {at if axis == 'x' else bound}}}"
    now_in, before_in = inside(f"({now})"), inside(f"({before})")
    return f"""select id, x0, x1, y0, y1, flatten(list_transform(range(1, len(p) + 1), lambda i: list_concat(case when {now_in} <> {before_in} then [{cross}] else [] end, case when {now_in} then [{now}] else [] end))) as p from ({points})"""


_CORNERS = [("lo % 50", "y_lo % 40"), ("lo % 50 + 10 + id % 7", "y_lo % 40 + id % 5"), ("lo % 50 + 12", "y_lo % 40 + 9 + id % 11"), ("lo % 50 + 3", "y_lo % 40 + 12")]
_POLYGON = f"""select id, (lo % 17 + 12)::double as x0, (lo % 17 + 42)::double as x1, (y_lo % 13 + 9)::double as y0, (y_lo % 13 + 30)::double as y1, [{", ".join(f"{{'x': ({x})::double, 'y': ({y})::double}}" for x, y in _CORNERS)}] as p from boxes"""


def _areas_sql() -> str:
    points = _POLYGON
    for axis, bound, above in (("x", "x0", True), ("x", "x1", False), ("y", "y0", True), ("y", "y1", False)):
        points = _clipped_sql(points, axis, bound, above)
    return f"select id, round(abs(coalesce(list_sum(list_transform(range(1, len(p) + 1), lambda i: p[i].x * p[i % len(p) + 1].y - p[i % len(p) + 1].x * p[i].y)), 0)) / 2, 6) as area from ({points})"


@JOBS.add(_areas_sql(), "boxes")
def clipped_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The area of four-cornered regions within rectangles."""
    at = [F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y")) for x, y in _CORNERS]
    box = [F.expr(e).cast("double") for e in ("lo % 17 + 12", "lo % 17 + 42", "y_lo % 13 + 9", "y_lo % 13 + 30")]
    return A.boxes(spark, sf_dir).select("id", F.round(scalars.clipped_area(F.array(*at), *box), 6).alias("area"))
