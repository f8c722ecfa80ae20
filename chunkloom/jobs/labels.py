"""Label jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import labels as L
from chunkloom.sources import adapters as A

JOBS = Jobs()
SMALL = 12


@JOBS.add(
    "select label, count(*) as area, sum(z) / count(*) as centroid_z, sum(y) / count(*) as centroid_y, sum(x) / count(*) as centroid_x, sum(v) / count(*) as mean_v, min(v) as min_v, max(v) as max_v from voxels where label > 0 group by label",
    "voxels",
)
def label_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = L.partial_moments(A.voxels(spark, sf_dir).withColumn("block", F.floor(F.col("z") / 3)), "block")
    return L.finish(L.merge_moments(parts))


@JOBS.add(
    """also planes as (select label, z, count(*) as plane_area from voxels where label > 0 group by label, z),
ranked as (select *, abs(z * sum(plane_area) over w - sum(z * plane_area) over w) as far from planes window w as (partition by label)),
best as (select label, z as plane_z, plane_area from ranked qualify row_number() over (partition by label order by plane_area desc, far, z) = 1)
select label, count(*) as area, any_value(plane_z) as plane_z, any_value(plane_area) as plane_area from voxels join best using (label) group by label""",
    "voxels",
)
def measured_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every label with its plane, checked both ways."""
    voxels = A.voxels(spark, sf_dir)
    moments = L.merge_moments(L.partial_moments(voxels)).select("label", "area")
    return L.with_planes(moments, L.representative_plane(voxels)).select("label", "area", "plane_z", "plane_area")


@JOBS.add(
    """also marked as (select label, case when v % 1000 < 15 then null else v end as v from voxels where label > 0)
select label, count(*) as area, count(*) > count(v) as has_nan, case when count(*) = count(v) then sum(v) / count(*) end as mean, case when count(*) = count(v) then min(v)::double end as least, case when count(*) = count(v) then max(v)::double end as most from marked group by label""",
    "voxels",
)
def moments_with_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of intensities of which some are NaN; the query's rows have a flag and null for NaN."""
    v = F.when(F.col("v") % 1000 < 15, F.lit(float("nan"))).otherwise(F.col("v").cast("double"))
    found = L.float_moments(A.voxels(spark, sf_dir).withColumn("v", v))
    return found.select("label", "area", F.isnan("mean").alias("has_nan"), *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("mean", "least", "most")])


@JOBS.add("select label, z, count(*) as area from voxels where label > 0 group by label, z", "voxels")
def label_plane_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.voxels(spark, sf_dir).where(F.col("label") > 0).groupBy("label", "z").agg(F.count("*").alias("area"))


@JOBS.add(
    """also planes as (select label, z, count(*) as plane_area from voxels where label > 0 group by label, z),
ranked as (select *, abs(z * sum(plane_area) over w - sum(z * plane_area) over w) as far from planes window w as (partition by label))
select label, z as plane_z, plane_area from ranked qualify row_number() over (partition by label order by plane_area desc, far, z) = 1""",
    "voxels",
)
def representative_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.representative_plane(A.voxels(spark, sf_dir))


_MET = """also met as (select a.label as p, b.label as q from voxels a join voxels b on b.z = a.z + 1 and b.y = a.y and b.x = a.x
  union all select a.label, b.label from voxels a join voxels b on b.z = a.z and b.y = a.y + 1 and b.x = a.x
  union all select a.label, b.label from voxels a join voxels b on b.z = a.z and b.y = a.y and b.x = a.x + 1)"""
_CONTACTS = f"""{_MET},
contacts as (select least(p, q) as a, greatest(p, q) as b, count(*) as n from met where p > 0 and q > 0 and p <> q group by 1, 2)"""


@JOBS.add(f"{_CONTACTS} select * from contacts", "voxels")
def label_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.contacts(A.voxels(spark, sf_dir))


@JOBS.add(
    f"""{_CONTACTS}, volumes as (select label, count(*) as area from voxels where label > 0 group by 1),
both_ways as (select a, b, n from contacts union all select b, a, n from contacts)
select a as label, b as recipient, n from both_ways join volumes p on p.label = a join volumes q on q.label = b
where p.area < {SMALL} and q.area >= {SMALL} qualify row_number() over (partition by a order by n desc, b) = 1""",
    "voxels",
)
def small_label_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels = A.voxels(spark, sf_dir)
    volumes = voxels.where(F.col("label") > 0).groupBy("label").agg(F.count("*").alias("area"))
    return L.strongest_neighbour(L.contacts(voxels), volumes, SMALL)


_COUNTS = """also counts as (
  select p.band, p.a, p.b, both_n, area_a, area_b from (select band, a, b, count(*) as both_n from bands where a > 0 and b > 0 group by 1, 2, 3) p
  join (select band, a, count(*) as area_a from bands where a > 0 group by 1, 2) l on l.band = p.band and l.a = p.a
  join (select band, b, count(*) as area_b from bands where b > 0 group by 1, 2) r on r.band = p.band and r.b = p.b)"""


@JOBS.add(f'{_COUNTS} select band, a, b, both_n as "both", area_a, area_b from counts', "bands")
def overlap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.overlap_counts(A.bands(spark, sf_dir))


@JOBS.add(
    f"""{_COUNTS}, scored as (select *, area_a + area_b - both_n as u, (both_n::hugeint << 62) // (area_a + area_b - both_n) as iou from counts where both_n * 100 >= (area_a + area_b - both_n)),
top as (select *, max(iou) over (partition by band, a) as ta, max(iou) over (partition by band, b) as tb from scored),
tied as (select *, sum((iou = ta)::int) over (partition by band, a) as na, sum((iou = tb)::int) over (partition by band, b) as nb from top)
select band, a, b, both_n as "both", u as "union" from tied where iou = ta and iou = tb and na = 1 and nb = 1""",
    "bands",
)
def reciprocal_best_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reciprocal_best(L.overlap_counts(A.bands(spark, sf_dir)), (1, 100))


@JOBS.add(
    f"select label, row_number() over (order by label) as final from (select label, count(*) as area from voxels where label > 0 group by 1) where area >= {SMALL}", "voxels"
)
def surviving_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    volumes = A.voxels(spark, sf_dir).where(F.col("label") > 0).groupBy("label").agg(F.count("*").alias("area"))
    return L.dense_labels(volumes, SMALL)


@JOBS.add("select label // 8 as final, count(*) as area from voxels where label > 0 group by 1", "voxels")
def mapped_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    volumes = A.voxels(spark, sf_dir).where(F.col("label") > 0).groupBy("label").agg(F.count("*").alias("area"))
    mapping = volumes.select("label", F.floor(F.col("label") / 8).alias("final"))
    return L.mapped_volumes(volumes, mapping)


@JOBS.add("select label, min(z) as z0, max(z) + 1 as z1, min(y) as y0, max(y) + 1 as y1, min(x) as x0, max(x) + 1 as x1 from voxels where label > 0 group by 1", "voxels")
def label_bounding_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.bounding_boxes(A.voxels(spark, sf_dir))


@JOBS.add("select y, x, max(v) as v, count(*) as n from voxels group by 1, 2", "voxels")
def max_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.max_projection(A.voxels(spark, sf_dir))


@JOBS.add("select z, (y // 2)::int as y, (x // 2)::int as x, round_even(sum(v) / count(*), 0)::bigint as v from voxels group by 1, 2, 3", "voxels")
def downsampled_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.block_means(A.voxels(spark, sf_dir))


@JOBS.add("select band, count(distinct a) as labels_a, count(distinct b) as labels_b from bands group by band", "bands")
def distinct_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.bands(spark, sf_dir).groupBy("band").agg(F.countDistinct("a").alias("labels_a"), F.countDistinct("b").alias("labels_b"))


@JOBS.add(
    """select z, max(abs(v - w))::bigint as max_abs, sum(abs(v - w)) / count(*) as mae, sqrt(sum((v - w) * (v - w)) / count(*)) as rmse
from (select z, v, (v // 256) * 256 as w from voxels) group by z""",
    "voxels",
)
def coding_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.voxels(spark, sf_dir).select("z", (F.col("v") - F.floor(F.col("v") / 256) * 256).alias("d"))
    return rows.groupBy("z").agg(F.max("d").alias("max_abs"), (F.sum("d") / F.count("*")).alias("mae"), F.sqrt(F.sum(F.col("d") * F.col("d")) / F.count("*")).alias("rmse"))


@JOBS.add(
    """select a.label as label, count(*) as n, sum(a.v * b.v)::decimal(38, 0)::varchar as product from voxels a join (select z, y, x, v // 100 as v from voxels) b on a.z = b.z and a.y = b.y and a.x = b.x where a.label > 0 group by 1""",
    "voxels",
)
def cogrid_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and a second channel on the same grid, met by position."""
    voxels = A.voxels(spark, sf_dir)
    second = voxels.select("z", "y", "x", F.floor(F.col("v") / 100).alias("w"))
    rows = voxels.where(F.col("label") > 0).join(second, ["z", "y", "x"])
    return rows.groupBy("label").agg(F.count("*").alias("n"), F.sum((F.col("v") * F.col("w")).cast("decimal(38,0)")).cast("string").alias("product"))
