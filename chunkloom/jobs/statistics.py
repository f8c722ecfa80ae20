"""Statistics jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import statistics as S
from chunkloom.sources import adapters as A

JOBS = Jobs()
_SCALE = "also scale as (select channel, round(quantile_cont(v, 0.05), 6) as low, round(quantile_cont(v, 0.95), 6) as high from samples group by 1)"


@JOBS.add("select channel, round(quantile_cont(v, 0.05), 6) as \"offset\", round(1000 / (quantile_cont(v, 0.95) - quantile_cont(v, 0.05)), 9) as scale from samples group by 1", "samples")
def quantile_scaling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.scaling(A.samples(spark, sf_dir), 0.05, 0.95, 1000)
    return found.select("channel", F.round("offset", 6).alias("offset"), F.round("scale", 9).alias("scale"))


@JOBS.add(
    """also ends as (select channel, min(v) as lo, max(v) as hi from samples group by 1)
select channel, (case when hi = lo then 0 else least(63, floor((v - lo) * 64 / (hi - lo))) end)::bigint as bin, count(*) as n from samples join ends using (channel) group by 1, 2""",
    "samples",
)
def intensity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.histogram(A.samples(spark, sf_dir), 64)


@JOBS.add(
    """also ranked as (select channel, v, row_number() over (partition by channel order by v) as k, count(*) over (partition by channel) as n from samples)
select channel, percent, v from ranked, (values (1), (50), (99)) p(percent) where k = greatest(1, ceil(percent * n / 100))""",
    "samples",
)
def rank_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rank_percentiles(A.samples(spark, sf_dir), (1, 50, 99))


@JOBS.add(
    """also run as (select channel, v, sum(v) over (partition by channel order by v) as through, sum(v) over (partition by channel) as total from samples)
select channel, min(v) as v from run where through * 100 >= total * 30 group by 1""",
    "samples",
)
def running_sum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.threshold_cut(A.samples(spark, sf_dir), 30)


_MIDDLE = "also middle as (select channel, median(v) as m from samples group by 1)"


@JOBS.add(
    f"""{_MIDDLE} select channel, count(*) as n, round(avg(v), 6) as mean, round(coalesce(stddev_samp(v), 0), 6) as std, any_value(m)::double as median, median(abs(v - m))::double as mad, round(quantile_cont(v, 0.16), 6) as p16, round(quantile_cont(v, 0.84), 6) as p84 from samples join middle using (channel) group by 1""",
    "samples",
)
def distribution_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = S.distribution(A.samples(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in ("mean", "std", "p16", "p84")})


@JOBS.add(
    f"""{_MIDDLE}, spread as (select channel, any_value(m) as m, median(abs(v - m)) as mad from samples join middle using (channel) group by 1)
select channel, count(*) filter (where abs(v - m) <= 2 * mad) as kept, count(*) filter (where abs(v - m) > 2 * mad) as left_out from samples join spread using (channel) group by 1""",
    "samples",
)
def robust_keep_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.robust_keep(A.samples(spark, sf_dir), 2)


@JOBS.add(
    f"""{_SCALE} select channel, round_even(least(greatest((v - low) * round(255 / (high - low), 9), 0), 255), 0)::bigint as q, count(*) as n from samples join scale using (channel) group by 1, 2""", "samples"
)
def quantised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = A.samples(spark, sf_dir)
    q = S.exact_quantiles(samples, (0.05, 0.95)).select("channel", F.round("q0", 6).alias("offset"), F.round("q1", 6).alias("high"))
    scale = q.select("channel", "offset", F.round(255 / (F.col("high") - F.col("offset")), 9).alias("scale"))
    return S.quantised(samples, scale, 255).groupBy("channel", "q").agg(F.count("*").alias("n"))


@JOBS.add("select tile, track, median(dz)::double as dz, median(score)::double as score, count(*) as n from tracks where valid and score >= 3 group by 1, 2", "tracks")
def track_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.track_medians(A.tracks(spark, sf_dir), 3)


@JOBS.add("select track, round(median(p), 6) as p90 from (select track, tile, quantile_cont(abs(dz), 0.9) as p from tracks group by 1, 2) group by 1", "tracks")
def tile_balanced_p90(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.tile_balanced(A.tracks(spark, sf_dir))


_TERMS = ("zz", "zy", "zx", "yy", "yx", "xx")


@JOBS.add(
    "also sums as (select label, sum(v)::bigint as weight, " + ", ".join(f"sum(v::hugeint * {a}) as s{a}" for a in "zyx") + ", " + ", ".join(f"sum(v::hugeint * {a} * {b}) as s{a}{b}" for a, b in _TERMS) + " from voxels where label > 0 group by 1)\n"
    "select label, weight, " + ", ".join(f"round(s{a}::double / weight, 6) as mean_{a}" for a in "zyx") + ", " + ", ".join(f"round((weight * s{a}{b} - s{a} * s{b})::double / weight / weight, 6) as {a}{b}" for a, b in _TERMS) + " from sums",
    "voxels",
)
def weighted_label_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.weighted_moments(A.voxels(spark, sf_dir))


@JOBS.add(
    """also sums as (select tile, count(*) as n, sum(score) as w, sum(score * score) as wx, sum(score * dz) as wy, sum(score * score * score) as wxx, sum(score * score * dz) as wxy from tracks where valid group by 1)
select tile, case when n >= 3 and w * wxx - wx * wx <> 0 then round((w * wxy - wx * wy) / (w * wxx - wx * wx), 9) end as slope, n from sums""",
    "tracks",
)
def weighted_linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.linear_fit(A.tracks(spark, sf_dir))


@JOBS.add("select tile, case when count(*) >= 8 and var_pop(dz) > 0 and var_pop(score) > 0 then round(corr(dz::double, score::double), 6) end as r from tracks where valid group by 1", "tracks")
def masked_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.tracks(spark, sf_dir).where("valid").groupBy("tile").agg(F.round(S.correlation(F.col("dz"), F.col("score"), 8), 6).alias("r"))
