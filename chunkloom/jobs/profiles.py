"""Profile and inlier jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import inliers as I
from chunkloom.operators import profiles as P
from chunkloom.operators import statistics as S
from chunkloom.operators.ranges import quantiles
from chunkloom.sources import adapters as A

JOBS = Jobs()
_PROFILE = "also profile as (select tile as key, dz as bin, sum(score)::double as v, count(*) as n from tracks where valid and score > 1 group by 1, 2)"
_PEAKS = f"{_PROFILE}, peaks as (select key, arg_max(bin, (v, -bin)) as peak, max(v) as high from profile group by 1)"


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = A.tracks(spark, sf_dir).where(F.col("valid") & (F.col("score") > 1))
    return kept.groupBy(F.col("tile").alias("key"), F.col("dz").alias("bin")).agg(F.sum("score").alias("v"), F.count("*").alias("n"))


@JOBS.add(
    f"""{_PEAKS}, sides as (select key, any_value(peak) as peak, any_value(high) as high, max(bin) filter (where bin <= peak and v < high / 2) as l, min(bin) filter (where bin >= peak and v < high / 2) as r from profile join peaks using (key) group by key),
ends as (select s.*, a.v as la, b.v as lb, c.v as ra, d.v as rb from sides s left join profile a on a.key = s.key and a.bin = l left join profile b on b.key = s.key and b.bin = l + 1 left join profile c on c.key = s.key and c.bin = r - 1 left join profile d on d.key = s.key and d.bin = r)
select key, peak, case when l is not null and r is not null then round((case when ra is null or rb is null or ra = rb then (r - 1)::double else (r - 1) + (high / 2 - ra) / (rb - ra) end) - (case when la is null or lb is null or la = lb then l::double else l + (high / 2 - la) / (lb - la) end), 9) end as width from ends""",
    "tracks",
)
def half_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.half_widths(_profile(spark, sf_dir)).withColumn("width", F.round("width", 9))


@JOBS.add(
    f"""{_PEAKS}, reach as (select key, peak, high, least(peak + 24, 25 - peak) as r from peaks),
pairs as (select c.key, c.r, o, m.v as m, p.v as p from reach c, lateral (select unnest(range(1, r + 1)) as o) join profile m on m.key = c.key and m.bin = c.peak - o join profile p on p.key = c.key and p.bin = c.peak + o),
sums as (select key, sum(p) as plus, sum(m) as minus, min(p / m) filter (where o between 2 and 4 and m > 0) as near from pairs group by key),
spans as (select key, max(bin) filter (where v >= high * 0.2) - min(bin) filter (where v >= high * 0.2) + 1 as span from profile join peaks using (key) group by key)
select key, case when r >= 2 and minus > 0 then round(plus / minus, 9) end as ratio, case when r >= 4 then round(near, 9) end as near_ratio, span from reach left join sums using (key) join spans using (key)""",
    "tracks",
)
def profile_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shapes(_profile(spark, sf_dir), -24, 25, 0.2, (2, 4)).withColumns({c: F.round(c, 9) for c in ("ratio", "near_ratio")})


@JOBS.add(
    f"""{_PEAKS}, hits as (select key, peak, high, side, step, case when step > 0 then (select min(bin) from profile f where f.key = k.key and f.bin > peak and f.v <= high * 0.6) else (select max(bin) from profile f where f.key = k.key and f.bin < peak and f.v <= high * 0.6) end as hit from peaks k, (values ('rising', -1), ('falling', 1)) s(side, step) where high > 0),
held as (select h.*, (select count(*) from profile f where f.key = h.key and f.bin > least(peak, hit) and f.bin < greatest(peak, hit)) = abs(hit - peak) - 1 as whole, a.v as low, b.v as up, least(a.n, b.n, c.n) as support from hits h left join profile a on a.key = h.key and a.bin = hit left join profile b on b.key = h.key and b.bin = hit - step left join profile c on c.key = h.key and c.bin = peak)
select key, side, case when whole then round(hit - step * (high * 0.6 - low) / (up - low), 9) end as depth, case when whole then support else 0 end as support from held""",
    "tracks",
)
def boundary_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of each profile."""
    return P.crossings(_profile(spark, sf_dir), 0.6).withColumn("depth", F.round("depth", 9))


@JOBS.add(f"{_PROFILE}, ends as (select key, max(v) as high, sum(v) as total from profile group by 1) select key, bin, round(v / high, 9) as by_peak, round(v / total, 9) as by_sum from profile join ends using (key) where high > 0 and total > 0", "tracks")
def normalised_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.normalised(_profile(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("by_peak", "by_sum")})


_CROPS = "also crops as (select (z % 2) * 16 + (y % 4) * 4 + x % 4 as place, v from voxels where label > 0)"


@JOBS.add(f"{_CROPS} select place, count(*) as n, median(v)::double as v from crops group by 1", "voxels")
def median_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median of all labels' crops at each of 32 places, exact although a place has a share of all rows."""
    place = (F.col("z") % 2) * 16 + (F.col("y") % 4) * 4 + F.col("x") % 4
    crops = A.voxels(spark, sf_dir).where(F.col("label") > 0).select(place.alias("place"), "v")
    return quantiles(crops, "place", "v", (0.5,)).select("place", "n", F.col("q0").alias("v"))


@JOBS.add(
    """also q as (select channel, count(*) as n, quantile_cont(v, 0.0001) as lo, case when count(*) >= 5000 then quantile_cont(v, 0.9999) else quantile_cont(v, 0.999) end as hi from samples group by 1)
select channel, n, round(case when hi - lo < 100 then (hi + lo) / 2 - 50 else lo end, 6) as lower, round(65534 / greatest(hi - lo, 100), 9) as scale from q""",
    "samples",
)
def quantisation_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer quantiles, a nearer one for small samples, over a least range."""
    return S.quantisation(A.samples(spark, sf_dir), 5000, 100.0).select("channel", "n", F.round("lower", 6).alias("lower"), F.round("scale", 9).alias("scale"))


_MEASURED = """also measured as (select o_orderkey // 24 as fixed, o_orderkey // 24 + (5 ** (o_custkey % 3))::bigint as moving, o_orderkey as id, (o_orderkey * 37 % 50) / 10 as z, (o_custkey % 9)::double as y, (o_orderkey * 13 % 11)::double as x, (o_custkey % 10) / 10 as weight from orders),
boxes3 as (select a.fixed, a.moving, a.z as z0, b.y as y0, c.x as x0 from (select distinct fixed, moving, z from measured) a join (select distinct fixed, moving, y from measured) b using (fixed, moving) join (select distinct fixed, moving, x from measured) c using (fixed, moving)),
sets as (select fixed, moving, z0, y0, x0, count(*) as n, list(m.id order by m.id) as ids from boxes3 join measured m using (fixed, moving) where m.z between z0 and z0 + 1.5 and m.y between y0 and y0 + 3 and m.x between x0 and x0 + 5 group by all),
best as (select fixed, moving, n, ids from sets qualify row_number() over (partition by fixed, moving order by n desc, ids) = 1),
marks as (select m.*, case when n < 3 then 'downweighted' when list_contains(ids, id) then 'inlier' else 'outlier' end as status from measured m join best using (fixed, moving))"""


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, other = F.col("o_orderkey"), F.col("o_custkey")
    step = F.element_at(F.array(*[F.lit(k).cast("long") for k in (1, 5, 25)]), (other % 3 + 1).cast("int"))
    fixed, d = F.floor(key / 24), lambda c: c.cast("double")
    rows = A.table(spark, sf_dir, "orders").select(
        fixed.alias("fixed"), (fixed + step).alias("moving"), key.alias("id"), (key * 37 % 50 / 10).alias("z"), d(other % 9).alias("y"), d(key * 13 % 11).alias("x"), (other % 10 / 10).alias("weight")
    )
    return I.marked(rows, (1.5, 3.0, 5.0), 3, 0.1)


@JOBS.add(f"{_MEASURED.replace('also', 'with', 1)} select fixed, moving, status, count(*) as n, round(sum(case status when 'inlier' then weight when 'downweighted' then weight * 0.1 else 0 end), 6) as weight from marks group by 1, 2, 3")
def inlier_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of each pair's measurements."""
    return _measured(spark, sf_dir).groupBy("fixed", "moving", "status").agg(F.count("*").alias("n"), F.round(F.sum("weight"), 6).alias("weight"))


@JOBS.add(f"{_MEASURED.replace('also', 'with', 1)} select fixed, moving, count(*) as n, median(z) as z, median(y) as y, median(x) as x from marks where status = 'inlier' group by 1, 2")
def inlier_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median of the largest set that agrees."""
    return I.medians(_measured(spark, sf_dir))
