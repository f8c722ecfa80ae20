"""Planning, gating and coverage jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions import scalars as S
from chunkloom.jobs.base import Jobs
from chunkloom.sources import adapters as A

JOBS = Jobs()


@JOBS.add("select distinct z, y // 8 as ky, x // 8 as kx from voxels except select distinct z, y // 8, x // 8 from voxels where label % 5 = 1", "voxels")
def pending_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned blocks without those that are done (anti join)."""
    v = A.voxels(spark, sf_dir).select("z", F.floor(F.col("y") / 8).cast("int").alias("ky"), F.floor(F.col("x") / 8).cast("int").alias("kx"), "label")
    return v.select("z", "ky", "kx").distinct().join(v.where(F.col("label") % 5 == 1), ["z", "ky", "kx"], "left_anti")


@JOBS.add(
    """also blocks as (select z, y // 8 as ky, x // 8 as kx, count(*) as n, count(*) filter (where label > 0) as held from voxels group by 1, 2, 3) select z, ky, kx, n, held from blocks where held * 100 >= n * 60""", "voxels"
)
def foreground_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with enough foreground."""
    v = A.voxels(spark, sf_dir)
    at = [F.floor(F.col(c) / 8).cast("int").alias(f"k{c}") for c in "yx"]
    return v.groupBy("z", *at).agg(F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("held")).where(F.col("held") * 100 >= F.col("n") * 60)


@JOBS.add(
    """also seen as (select distinct label from voxels where label > 0), slabs as (select distinct z // 2 as s from voxels), wanted as (select unnest(range(s * 64 + 1, s * 64 + 61)) as label from slabs)
select 'missing' as kind, count(*) as n, min(label) as least from (select label from wanted except select label from seen)
union all select 'unexpected', count(*), min(label) from (select label from seen except select label from wanted)""",
    "voxels",
)
def label_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels missing from a plan of 60 a slab, and labels outside it."""
    voxels = A.voxels(spark, sf_dir)
    seen = voxels.where(F.col("label") > 0).select("label").distinct().withColumn("seen", F.lit(True))
    slab = voxels.select(F.floor(F.col("z") / 2).alias("s")).distinct()
    wanted = slab.select(F.explode(F.sequence(F.col("s") * 64 + 1, F.col("s") * 64 + 60)).alias("label"), F.lit(True).alias("wanted"))
    both = seen.join(wanted, "label", "full")
    kind = F.when(F.col("seen").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected")
    kinds = F.explode(F.array(F.lit("missing"), F.lit("unexpected")))
    counts = both.select(kind.alias("kind"), "label").where(F.col("kind").isNotNull()).groupBy("kind").agg(F.count("*").alias("n"), F.min("label").alias("least"))
    return spark.range(1).select(kinds.alias("kind")).join(counts, "kind", "left").select("kind", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "least")


@JOBS.add("select l_orderkey % 1000 as token, l_linenumber as local, ((l_orderkey % 1000) << 16) | l_linenumber as gid, count(*) as n from lineitem group by 1, 2, 3")
def packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    token, local = F.col("l_orderkey") % 1000, F.col("l_linenumber").cast("long")
    gid = S.packed_id(token, local, 16)
    rows = A.table(spark, sf_dir, "lineitem").select(gid.alias("gid"))
    back, own = S.unpacked_id(F.col("gid"), 16)
    return rows.groupBy("gid").agg(F.count("*").alias("n")).select(back.alias("token"), own.cast("int").alias("local"), "gid", "n")


@JOBS.add("select id, lo // 24 as t, (lo // 3) % 8 as z, lo % 3 as c from boxes", "boxes")
def page_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, z, c = S.page_place(F.col("lo"), 3, 8)
    return A.boxes(spark, sf_dir).select("id", t.alias("t"), z.alias("z"), c.alias("c"))


@JOBS.add("select id, least(lo, lo + (y_hi - 1) * s) as least, greatest(lo, lo + (y_hi - 1) * s) as most from (select *, case when id % 2 = 0 then -2 else 3 end as s from boxes)", "boxes")
def signed_axis_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    least, most = S.signed_bounds(F.col("lo"), F.col("y_hi"), F.when(F.col("id") % 2 == 0, -2).otherwise(3))
    return A.boxes(spark, sf_dir).select("id", least.alias("least"), most.alias("most"))


@JOBS.add("select id, round(t * t * (3 - 2 * t), 9) as weight from (select id, least(greatest((lo % 100) / 64, 0), 1) as t from boxes)", "boxes")
def smoothstep_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.boxes(spark, sf_dir).select("id", F.round(S.smoothstep((F.col("lo") % 100) / 64), 9).alias("weight"))


@JOBS.add("select case when lo % 20 > 13 then 3 when lo % 20 > 7 then 2 when lo % 20 > 2 then 1 else 0 end as bin, source, sum(hi - lo)::bigint as total, count(*) as n from boxes group by 1, 2", "boxes")
def depth_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and counts by group and nearest depth bin."""
    rows = A.boxes(spark, sf_dir).withColumn("bin", S.nearest_bin((F.col("lo") % 20).cast("double"), [0.0, 4.0, 10.0, 16.0]))
    return rows.groupBy("bin", "source").agg(F.sum(F.col("hi") - F.col("lo")).alias("total"), F.count("*").alias("n"))


@JOBS.add("select id, floor(least(greatest((lo - 100) * 255 / 900, 0), 255))::int as u from boxes", "boxes")
def stretched_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.boxes(spark, sf_dir).select("id", S.stretched(F.col("lo"), F.lit(100), F.lit(1000)).alias("u"))


@JOBS.add(
    """select id, case when lo <= inner_r then 'VZ' when lo <= outer_r then 'SVZ' else 'CP' end as layer from (select id, lo % 100 as lo, case when y_lo % 7 > 0 then 30 end as inner_r, 60 as outer_r from boxes) where inner_r is not null
union all select id, null from boxes where y_lo % 7 = 0""",
    "boxes",
)
def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer by two bounds, null where a bound is undefined."""
    rows = A.boxes(spark, sf_dir).select("id", (F.col("lo") % 100).alias("r"), F.when(F.col("y_lo") % 7 > 0, 30).alias("inner"), F.lit(60).alias("outer"))
    layer = F.when(F.col("inner").isNull() | F.col("outer").isNull(), None).when(F.col("r") <= F.col("inner"), "VZ").when(F.col("r") <= F.col("outer"), "SVZ").otherwise("CP")
    return rows.select("id", layer.alias("layer"))


@JOBS.add(
    """also hours as (select user_id, floor(epoch(ts) / 3600)::bigint as h from events group by 1, 2),
marked as (select *, case when h - 1 > lag(h + 2) over (partition by user_id order by h) or lag(h) over (partition by user_id order by h) is null then 1 else 0 end as new from hours),
numbered as (select *, sum(new) over (partition by user_id order by h) as k from marked)
select user_id, min(h) - 1 as read_start, max(h) + 2 as read_stop, count(*) as cores from numbered group by user_id, k""".replace("also ", "with ", 1),
)
def halo_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled planes with a halo of one, merged while their reads touch."""
    hours = A.table(spark, sf_dir, "events").select("user_id", F.floor(F.unix_timestamp("ts") / 3600).alias("h")).distinct()
    order = W.partitionBy("user_id").orderBy("h")
    before = F.lag("h").over(order)
    numbered = hours.withColumn("new", F.when(before.isNull() | (F.col("h") - 1 > before + 2), 1).otherwise(0)).withColumn("k", F.sum("new").over(order))
    return numbered.groupBy("user_id", "k").agg((F.min("h") - 1).alias("read_start"), (F.max("h") + 2).alias("read_stop"), F.count("*").alias("cores")).drop("k")


@JOBS.add("select user_id, sha256(string_agg(event_id::varchar, ',' order by event_id)) as digest, count(*) as n from events group by 1")
def content_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each group's ids in order."""
    ids = F.transform(F.array_sort(F.collect_list("event_id")), lambda x: x.cast("string"))
    return A.table(spark, sf_dir, "events").groupBy("user_id").agg(F.sha2(F.array_join(ids, ","), 256).alias("digest"), F.count("*").alias("n"))


@JOBS.add("select event_type, json_extract(props, '$.k')::bigint as k, count(*) as n from events group by 1, 2")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint")["k"].alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))
