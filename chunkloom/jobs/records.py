"""Jobs over record files: the given tables are written as files of a format, and read back with its reader's gates."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.scratch import folder
from chunkloom.jobs.base import Jobs
from chunkloom.operators import labels as L
from chunkloom.operators import records as R
from chunkloom.operators import statistics as S
from chunkloom.sources import adapters as A

JOBS = Jobs()


def _place(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def _tile(key: str) -> Column:
    return F.concat(F.lit("tile_"), F.col(key).cast("string"))


@JOBS.add(
    """select fixed as fixed_index, moving as moving_index, count(*) as n, sum(shift)::bigint as total from edges where accepted and score >= 4 and abs(shift) <= 15 and abs(shift % 7) <= 15 group by 1, 2""",
    "edges",
)
def constraint_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints by name as JSON lines, gated, and indexed by the tiles' names."""
    edges, path = A.edges(spark, sf_dir), _place(spark, "constraints")
    shift = F.array(F.col("shift").cast("double"), (F.col("shift") % 7).cast("double"), F.lit(0.0))
    edges.select(_tile("fixed").alias("fixed"), _tile("moving").alias("moving"), "accepted", F.col("score").cast("double").alias("score"), shift.alias("shift_zyx"), F.col("reason").alias("reject_reason")).write.json(path)
    ids = edges.select(F.col("fixed").alias("index")).union(edges.select("moving")).distinct()
    kept = R.with_index(R.constraint_lines(spark, path, 4.0, 15.0), ids.select(_tile("index").alias("name"), "index"))
    return kept.groupBy("fixed_index", "moving_index").agg(F.count("*").alias("n"), F.sum(F.col("shift_zyx")[0]).cast("long").alias("total"))


@JOBS.add("select 'side_' || source as side, id as tile, 't/' || id || '.zarr' as path, (lo % 7)::double as z, y_lo / 4 as y, lo / 4 as x from boxes", "boxes")
def position_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of up to 100 tiles each."""
    path = _place(spark, "positions")
    at = F.struct((F.col("lo") % 7).cast("double").alias("z"), (F.col("y_lo") / 4).alias("y"), (F.col("lo") / 4).alias("x"))
    tile = F.struct(F.col("id").alias("tile"), F.concat(F.lit("t/"), F.col("id").cast("string"), F.lit(".zarr")).alias("path"), at.alias("translation_um"), F.struct(*[F.lit(0.25).alias(c) for c in "zyx"]).alias("scale_um"))
    rows = A.boxes(spark, sf_dir).groupBy("source", F.floor(F.col("id") / 500).alias("part"))
    rows.agg(F.collect_list(tile).alias("tiles")).select(F.concat(F.lit("side_"), F.col("source").cast("string")).alias("side"), "tiles").write.json(path)
    return R.position_tiles(spark, path)


@JOBS.add("select id as tile, (1 + id % 3)::double * 2 - (id % 5)::double as determinant, lo::double as shift_z, y_lo::double as shift_y, (hi - lo)::double as shift_x from boxes", "boxes")
def registration_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered affines, with their determinants."""
    path = _place(spark, "registration")
    d = lambda c: c.cast("double")
    one, zero = F.lit(1.0), F.lit(0.0)
    affine = F.array(
        F.array(d(1 + F.col("id") % 3), d(F.col("id") % 5), zero, d(F.col("lo"))), F.array(one, F.lit(2.0), zero, d(F.col("y_lo"))), F.array(zero, zero, one, d(F.col("hi") - F.col("lo")))
    )
    A.boxes(spark, sf_dir).select(F.col("id").alias("tile"), affine.alias("affine")).write.json(path)
    return R.registered_tiles(spark, path)


@JOBS.add(
    """select id // 40 as part, (row_number() over (partition by id // 40 order by id))::int as n, lo / 10 as x, y_lo / 10 as y, (hi - lo)::double as z from boxes""",
    "boxes",
)
def stage_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of 40 positions each."""
    path = _place(spark, "stage")
    line = lambda c, v: F.concat(F.lit(f"{c} = "), v.cast("decimal(18,1)").cast("string"), F.lit("\n"))
    axes = F.concat(line("X", F.col("lo") / 10), line("Y", F.col("y_lo") / 10), line("Z", F.col("hi") - F.col("lo")))
    own = A.boxes(spark, sf_dir).groupBy(F.floor(F.col("id") / 40).alias("part")).agg(F.array_sort(F.collect_list(F.struct("id", axes.alias("axes")))).alias("rows"))
    blocks = F.transform("rows", lambda r, i: F.concat(F.lit("BEGIN Position"), (i + 1).cast("string"), F.lit("\n"), r["axes"], F.lit("END\n")))
    text = own.select("part", F.concat(F.lit("Count = "), F.size("rows").cast("string"), F.lit("\n"), F.array_join(blocks, "")).alias("value"))
    text.write.partitionBy("part").text(path)
    # The file's folder holds its number.
    return R.stage_positions(spark, f"{path}/part=*").select(F.regexp_extract("file", "part=([0-9]+)/", 1).cast("long").alias("part"), "n", "x", "y", "z")


@JOBS.add(
    "select label, count(*) as area, sum(z) / count(*) as centroid_z, sum(y) / count(*) as centroid_y, sum(x) / count(*) as centroid_x, sum(v) / count(*) as mean_v, min(v) as min_v, max(v) as max_v from voxels where label > 0 group by label",
    "voxels",
)
def reduced_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial moments of slabs written to a folder each, read by a pattern and merged."""
    path = _place(spark, "partials")
    parts = L.partial_moments(A.voxels(spark, sf_dir).withColumn("slab", F.floor(F.col("z") / 5)), "slab")
    parts.withColumn("m", F.col("slab") % 8).write.partitionBy("m").parquet(path)
    return L.finish(L.merge_moments(spark.read.parquet(f"{path}/m=*")))


@JOBS.add("select count(*) as n, count(*) filter (where hi - lo > 25) as good, sum(lo)::bigint as total from boxes", "boxes")
def quality_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with a header and fixed order of fields; truthy flags in any spelling count."""
    root, kind = _place(spark, "quality"), "id long, x double, good_quality string"
    spelled = F.element_at(F.array(*[F.lit(w) for w in ("true", "1", "Yes", "TRUE")]), (F.col("id") % 4 + 1).cast("int"))
    flag = F.when(F.col("hi") - F.col("lo") > 25, spelled).otherwise(F.when(F.col("id") % 2 == 0, "false").otherwise("0"))
    R.publish(A.boxes(spark, sf_dir).select("id", F.col("lo").cast("double").alias("x"), flag.alias("good_quality")), root, "csv", header="true")
    rows = R.latest(spark, root, kind, "csv", header="true")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.lower(F.trim("good_quality")).isin("true", "1", "yes")).alias("good"), F.sum("x").cast("long").alias("total"))


@JOBS.add("select source, case when lo % 100 <= 30 then 'VZ' when lo % 100 <= 60 then 'SVZ' else 'CP' end as layer, count(*) as n, sum(lo)::bigint as total from boxes group by 1, 2", "boxes")
def published_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers as compressed Parquet, published once all rows can be read back; the reader takes three of its columns."""
    root = _place(spark, "layers")
    layer = F.when(F.col("lo") % 100 <= 30, "VZ").when(F.col("lo") % 100 <= 60, "SVZ").otherwise("CP")
    R.publish(A.boxes(spark, sf_dir).withColumn("layer", layer), root, compression="zstd")
    return R.latest(spark, root, "source long, layer string, lo long").groupBy("source", "layer").agg(F.count("*").alias("n"), F.sum("lo").alias("total"))


@JOBS.add(
    """also ends as (select channel, min(v) as lo, max(v) as hi from samples group by 1)
select channel, (case when hi = lo then 0 else least(31, floor((v - lo) * 32 / (hi - lo))) end)::bigint as bin, count(*) as n, any_value(lo) as low from samples join ends using (channel) group by 1, 2""",
    "samples",
)
def histogram_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins as CSV and each channel's offset as JSON, read back and joined."""
    root, samples = _place(spark, "histogram"), A.samples(spark, sf_dir)
    R.publish(S.histogram(samples, 32), f"{root}/bins", "csv", header="true")
    samples.groupBy("channel").agg(F.min("v").alias("low")).write.json(f"{root}/scaling")
    bins = R.latest(spark, f"{root}/bins", "channel string, bin long, n long", "csv", header="true")
    return bins.join(spark.read.schema("channel string, low long").json(f"{root}/scaling"), "channel").select("channel", "bin", "n", "low")


@JOBS.add("select z // 4 as slab, count(*) as n, sum(v)::bigint as total from voxels where z >= 2 and z < 61 group by 1", "voxels")
def plane_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planes of a half-open range, read from files that are sorted by plane, so that the range skips row groups."""
    path = _place(spark, "planes")
    A.voxels(spark, sf_dir).repartitionByRange("z").sortWithinPartitions("z").write.parquet(path)
    rows = spark.read.schema("z int, v long").parquet(path).where((F.col("z") >= 2) & (F.col("z") < 61))
    return rows.groupBy(F.floor(F.col("z") / 4).alias("slab")).agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@JOBS.add("select z - 1 as z, y - 5 as y, x - 3 as x, label, z * 2.0::double as z_um, 10 + y * 0.5::double as y_um from voxels where z >= 1 and z < 1000000 and y >= 5 and y < 29 and x >= 3 and x < 30", "voxels")
def cropped_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of the volume in its own indexes; positions in microns stay those of the whole."""
    start, stop = {"z": 1, "y": 5, "x": 3}, {"z": 1_000_000, "y": 29, "x": 30}
    inside = [(F.col(c) >= start[c]) & (F.col(c) < stop[c]) for c in "zyx"]
    own = A.voxels(spark, sf_dir).where(inside[0] & inside[1] & inside[2]).select(*[(F.col(c) - start[c]).alias(c) for c in "zyx"], "label")
    shift = {c: o + start[c] * s for c, o, s in (("z", 0.0, 2.0), ("y", 10.0, 0.5))}
    return own.select("z", "y", "x", "label", (shift["z"] + F.col("z") * 2.0).alias("z_um"), (shift["y"] + F.col("y") * 0.5).alias("y_um"))


@JOBS.add(
    """select k as "window", count(*) as n, sum(v)::bigint as total, min(z) as first, max(z) as last from voxels, lateral (select unnest(range(greatest((z - 7) // 5 + case when (z - 7) % 5 > 0 then 1 else 0 end, 0), (z + 1) // 5 + 1)) as k) where z >= k * 5 - 1 and z < k * 5 + 8 group by 1""",
    "voxels",
)
def windowed_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows of planes [5 k - 1, 5 k + 8), each written to its own folder."""
    path = _place(spark, "windows")
    first = F.greatest(F.ceil((F.col("z") - 7) / 5), F.lit(0))
    held = A.voxels(spark, sf_dir).withColumn("window", F.explode(F.sequence(first, F.floor((F.col("z") + 1) / 5))))
    held.repartition("window").write.partitionBy("window").parquet(path)
    rows = spark.read.schema("z int, v long, window long").parquet(path)
    return rows.groupBy("window").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("z").alias("first"), F.max("z").alias("last"))


@JOBS.add("select z // 3 as kz, y // 8 as ky, x // 8 as kx, count(*) as n, sum(label)::bigint as total from voxels group by 1, 2, 3 having min(label) <> 0 or max(label) <> 0", "voxels")
def rechunked_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Another chunk grid; chunks that hold nothing but the fill value 0 are skipped."""
    at = [F.floor(F.col(c) / s).alias(f"k{c}") for c, s in zip("zyx", (3, 8, 8))]
    blocks = A.voxels(spark, sf_dir).groupBy(*at).agg(F.count("*").alias("n"), F.sum("label").alias("total"), F.min("label").alias("least"), F.max("label").alias("most"))
    return blocks.where((F.col("least") != 0) | (F.col("most") != 0)).drop("least", "most")


@JOBS.add("select event_type as role, 'p' || user_id as path, arg_max(value, event_id) as value, sha256(arg_max(event_id, event_id)::varchar) as digest from events group by 1, 2")
def artifact_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One artifact for each role and path: the last one holds."""
    rows = A.table(spark, sf_dir, "events").select(F.col("event_type").alias("role"), F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("path"), "event_id", "value")
    return R.last_of_each(rows, ["role", "path"], "event_id").select("role", "path", "value", F.sha2(F.col("event_id").cast("string"), 256).alias("digest"))


@JOBS.add("select id, 2 * (1 + id % 3) * 0.5::double as scale, ((lo * 2 + 1) * (1 + id % 3)) * 0.5 + hi::double as shift from boxes", "boxes")
def composed_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales and translations of JSON metadata, composed in order."""
    step = lambda a, b: F.struct(a.cast("double").alias("scale"), b.cast("double").alias("shift"))
    steps = F.array(step(F.lit(2.0), F.col("lo") * 2 + 1), step(1 + F.col("id") % 3, F.lit(0.0)), step(F.lit(0.5), F.col("hi")))
    text = A.boxes(spark, sf_dir).select("id", F.to_json(F.struct(steps.alias("steps"))).alias("meta"))
    found = text.select("id", R.composed(F.from_json("meta", "steps array<struct<scale:double,shift:double>>")["steps"]).alias("c"))
    return found.select("id", "c.scale", "c.shift")


@JOBS.add("select id, 'nm' as unit, hi::double as size, 'ch' || source as channel from boxes", "boxes")
def xml_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of XML metadata."""
    text = F.concat(F.lit('<Image ID="'), F.col("id").cast("string"), F.lit('"><Pixels Unit="nm" SizeX="'), F.col("hi").cast("string"), F.lit('"/><Channel Name="ch'), F.col("source").cast("string"), F.lit('"/></Image>'))
    # Parsing costs far more than reading a row, so rows are dealt to as many tasks as a shuffle has, and each is parsed once.
    rows = A.boxes(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).select(text.alias("t"))
    image = R.parsed_xml("t", "_ID long, Pixels struct<_Unit string, _SizeX double>, Channel struct<_Name string>")
    return rows.select(image.alias("i")).select(F.col("i._ID").alias("id"), F.col("i.Pixels._Unit").alias("unit"), F.col("i.Pixels._SizeX").alias("size"), F.col("i.Channel._Name").alias("channel"))


@JOBS.add("select 'img_' || id as stem, 'img_' || id || '.tif' as image, 'img_' || id || '_masks.tif' as label from boxes where id % 3 > 0", "boxes")
def image_label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and their label files, met by stem; files without labels are left out."""
    stem = F.concat(F.lit("img_"), F.col("id").cast("string"))
    boxes = A.boxes(spark, sf_dir)
    files = boxes.select(F.concat(stem, F.lit(".tif")).alias("file")).union(boxes.where(F.col("id") % 3 > 0).select(F.concat(stem, F.lit("_masks.tif"))))
    masks = files.where(F.col("file").endswith("_masks.tif")).select(F.regexp_extract("file", r"^(.*)_masks\.tif$", 1).alias("stem"), F.col("file").alias("label"))
    images = files.where(~F.col("file").endswith("_masks.tif")).select(F.regexp_extract("file", r"^(.*)\.tif$", 1).alias("stem"), F.col("file").alias("image"))
    return images.join(masks, "stem")
