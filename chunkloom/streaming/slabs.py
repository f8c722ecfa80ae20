"""Slab streams: moments of slabs, with halos, gathered as the data arrive, and counts by hour with a watermark.

A stream reads the files that are there and ends (`availableNow`); offsets and state live in the shared folder, so a
stopped stream goes on from where it was. Each batch adds its partial moments once: a batch that is repeated after a
failure overwrites its own part. What is read at the end are the parts of all batches, merged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut, folder
from chunkloom.jobs.base import Jobs

JOBS = Jobs()


def stream(spark: SparkSession, sf_dir: str, name: str, files: int = 4) -> DataFrame:
    """The files of a table as a stream, up to `files` a batch."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", files).parquet(sf_dir)


def gathered(rows: DataFrame, path: str, part: Callable[[DataFrame], DataFrame], mode: str = "append") -> str:
    """Run a stream to its end; each batch's part(batch) is written under its number. The folder of the parts."""

    def add(batch: DataFrame, number: int) -> None:
        part(batch).write.mode("overwrite").parquet(f"{path}/parts/batch={number}")

    rows.writeStream.outputMode(mode).foreachBatch(add).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return f"{path}/parts"


def partial_sums(rows: DataFrame, path: str) -> DataFrame:
    """Sums of rows (slab, v), from the partial sums that each batch wrote under path."""
    one = lambda b: b.groupBy("slab").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("v").alias("least"), F.max("v").alias("most"))
    parts = rows.sparkSession.read.schema("slab long, n long, total long, least long, most long, batch int").parquet(gathered(rows.withColumn("slab", F.col("slab").cast("long")), path, one))
    return parts.groupBy("slab").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))


def with_halos(rows: DataFrame, depth: int, halo: int) -> DataFrame:
    """rows (z, ...) once for each slab of `depth` planes that reads it, with `core`: whether z is one of the slab's own planes. halo is at most depth."""
    slab = F.floor(F.col("z") / depth)
    below, above = F.col("z") % depth < halo, F.col("z") % depth >= depth - halo
    readers = F.array_compact(F.array(slab, F.when(below & (slab > 0), slab - 1), F.when(above, slab + 1)))
    return rows.withColumn("slab", F.explode(readers)).withColumn("core", F.col("slab") == slab)


def hourly_counts(rows: DataFrame, path: str, delay: str) -> DataFrame:
    """(kind, start, n) of rows (kind, ts): counts by hour; rows more than `delay` behind the latest one seen two or more batches before are left out."""
    counts = rows.withWatermark("ts", delay).groupBy("kind", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"))
    one = lambda b: b.select("kind", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")
    parts = rows.sparkSession.read.schema("kind string, start timestamp_ntz, n long, batch int").parquet(gathered(counts, path, one, "update"))
    return cut(parts.groupBy("kind", "start").agg(F.max_by("n", "batch").alias("n")))


def closed_sessions(rows: DataFrame, path: str, gap: str, delay: str) -> DataFrame:
    """(kind, start, stop, n) of rows (kind, ts): runs of a kind's rows less than `gap` apart, once the watermark, `delay` behind the latest row, has passed their last row and the gap.

    A session is written once, in the batch that closes it; those still open stay in the stream's state and are written
    by a later run over the same path. Rows behind the watermark are left out.
    """
    sessions = rows.withWatermark("ts", delay).groupBy("kind", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    one = lambda b: b.select("kind", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("stop"), "n")
    return rows.sparkSession.read.schema("kind string, start timestamp_ntz, stop timestamp_ntz, n long, batch int").parquet(gathered(sessions, path, one)).drop("batch")


@JOBS.add("select l_linenumber as slab, count(*) as n, sum(round(l_extendedprice * 100)::bigint)::bigint as total, min(round(l_extendedprice * 100)::bigint) as least, max(round(l_extendedprice * 100)::bigint) as most from lineitem group by 1")
def streamed_slab_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("slab"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    return partial_sums(rows, f"{folder(spark)}/slabs-{uuid.uuid4().hex}").withColumn("slab", F.col("slab").cast("int"))


@JOBS.add(
    """with rows as (select l_orderkey // 200 as z, round(l_extendedprice * 100)::bigint as v from lineitem),
readers as (select z, v, z // 5 as slab, true as core from rows union all select z, v, z // 5 - 1, false from rows where z % 5 < 2 and z // 5 > 0 union all select z, v, z // 5 + 1, false from rows where z % 5 >= 3)
select slab, core, count(*) as n, sum(v)::bigint as total from readers group by 1, 2"""
)
def streamed_halo_slabs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slabs of five planes with two of each neighbour's."""
    path = f"{folder(spark)}/halos-{uuid.uuid4().hex}"
    rows = stream(spark, sf_dir, "lineitem").select(F.floor(F.col("l_orderkey") / 200).alias("z"), F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    one = lambda b: b.groupBy("slab", "core").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
    parts = spark.read.schema("slab long, core boolean, n long, total long, batch int").parquet(gathered(with_halos(rows, 5, 2), path, one))
    return parts.groupBy("slab", "core").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@JOBS.add("select event_type, time_bucket(interval 1 hour, ts) as start, count(*) as n from events group by 1, 2")
def streamed_hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour. The table's rows come in one batch, in which nothing is late."""
    rows = stream(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts"))
    return hourly_counts(rows, f"{folder(spark)}/hours-{uuid.uuid4().hex}", "1 day").withColumnRenamed("kind", "event_type")


GAP, DELAY = 20, 60


@JOBS.add(
    f"""with marked as (select event_type, ts, case when ts < lag(ts) over w + interval {GAP} minute then 0 else 1 end as begins from events window w as (partition by event_type order by ts)),
named as (select *, sum(begins) over (partition by event_type order by ts rows unbounded preceding) as session from marked),
sessions as (select event_type, min(ts) as start, max(ts) + interval {GAP} minute as stop, count(*) as n from named group by event_type, session)
select event_type, start, stop, n from sessions where stop <= (select max(ts) from events) - interval {DELAY} minute"""
)
def streamed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of events that the watermark has closed at the stream's end."""
    rows = stream(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts"))
    return closed_sessions(rows, f"{folder(spark)}/sessions-{uuid.uuid4().hex}", f"{GAP} minutes", f"{DELAY} minutes").withColumnRenamed("kind", "event_type")
