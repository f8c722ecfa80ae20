"""Record files: constraint lists, position documents, text blocks and tables, published by version."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

VERSIONS = "version long, path string, n long"


def publish(df: DataFrame, root: str, kind: str = "parquet", **options: str) -> int:
    """Write df under root as a new version and list it once as many rows can be read back as were written; its number of rows.

    Data go to a folder of their own, and readers only follow the list, so that nobody sees half a version. A version's
    number is claimed by making its file where there is none, so two publishers get two numbers.
    """
    spark = df.sparkSession
    seen, path = Observation(), f"{root}/data-{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**options).format(kind).save(path)
    written = seen.get["n"]
    held = spark.read.schema(df.schema).options(**options).format(kind).load(path).count()
    if held != written:
        raise RuntimeError(f"{written} rows were written and {held} read back")
    files, place = _folder(spark, root)
    last = max(_listed(files, place), default=0)
    while True:
        last += 1
        try:
            # Only one publisher can make the file of a number.
            out = files.create(spark._jvm.org.apache.hadoop.fs.Path(place, f"{last:012d}.json"), False)
            break
        except Py4JJavaError as error:
            if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(place, f"{last:012d}.json")):
                raise error
    out.write((json.dumps({"version": last, "path": path, "n": written}) + "\n").encode())
    out.close()
    return written


def _folder(spark: SparkSession, root: str) -> tuple:
    """The file system and the folder of the list of versions."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/versions")
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _listed(files, place) -> list[int]:
    """Numbers of the versions in the list, also those whose publisher hasn't written their row yet."""
    if not files.exists(place):
        return []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, path, n) of what is published under root. Readers write nothing; where nothing was published, there are no rows."""
    files, place = _folder(spark, root)
    if not _listed(files, place):
        return spark.createDataFrame([], VERSIONS)
    return spark.read.schema(VERSIONS).option("mode", "DROPMALFORMED").json(f"{root}/versions").where("path is not null")


def latest(spark: SparkSession, root: str, schema: str, kind: str = "parquet", **options: str) -> DataFrame:
    """The last published version; an error where there is none."""
    path = versions(spark, root).agg(F.max_by("path", "version")).first()[0]
    if path is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.schema(schema).options(**options).format(kind).load(path)


def require_unique(rows: DataFrame, *keys: str) -> DataFrame:
    """rows; a key that occurs twice is an error once they are read."""
    count = F.count("*").over(W.partitionBy(*keys))
    named = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    once = F.when(count == 1, True).otherwise(F.raise_error(F.concat(F.lit("a key occurs twice: "), named)).cast("boolean"))
    return rows.withColumn("_once", once).where("_once").drop("_once")


def with_index(constraints: DataFrame, tiles: DataFrame) -> DataFrame:
    """constraints with names `fixed` and `moving` replaced by the indexes of tiles (name, index); a name that no tile has is an error."""
    out = constraints
    for side in ("fixed", "moving"):
        known = tiles.select(F.col("name").alias(side), F.col("index").alias(f"{side}_index"))
        missing = F.raise_error(F.concat(F.lit("no tile has the name "), F.col(side))).cast("long")
        out = out.join(known, side, "left").withColumn(f"{side}_index", F.coalesce(f"{side}_index", missing))
    return out


def constraint_lines(spark: SparkSession, path: str, least_score: float, most_shift: float) -> DataFrame:
    """Accepted constraints of JSON lines with a score and a shift within bounds."""
    kind = "fixed string, moving string, accepted boolean, score double, shift_zyx array<double>, reject_reason string"
    within = F.forall("shift_zyx", lambda s: F.abs(s) <= most_shift)
    return spark.read.schema(kind).json(path).where(F.col("accepted") & (F.col("score") >= least_score) & within)


def position_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(side, tile, path, z, y, x) of documents with a list of tiles, in microns."""
    kind = "side string, tiles array<struct<tile:bigint,path:string,translation_um:struct<z:double,y:double,x:double>,scale_um:struct<z:double,y:double,x:double>>>"
    own = spark.read.schema(kind).json(path).select("side", F.explode("tiles").alias("t"))
    return own.select("side", "t.tile", "t.path", *[F.col(f"t.translation_um.{c}").alias(c) for c in "zyx"])


def registered_tiles(spark: SparkSession, path: str) -> DataFrame:
    """(tile, determinant, shift_z, shift_y, shift_x) of registration documents; an affine that isn't 3 x 4 is an error."""
    own = spark.read.schema("tile bigint, affine array<array<double>>").json(path)
    whole = (F.size("affine") == 3) & F.forall("affine", lambda r: F.size(r) == 4)
    m = F.when(whole, F.col("affine")).otherwise(F.raise_error(F.lit("an affine has to be 3 x 4")).cast("array<array<double>>"))
    own = own.select("tile", m.alias("m"))
    minor = lambda a, b: F.col("m")[1][a] * F.col("m")[2][b] - F.col("m")[1][b] * F.col("m")[2][a]
    determinant = F.col("m")[0][0] * minor(1, 2) - F.col("m")[0][1] * minor(0, 2) + F.col("m")[0][2] * minor(0, 1)
    return own.select("tile", determinant.alias("determinant"), *[F.col("m")[i][3].alias(f"shift_{c}") for i, c in enumerate("zyx")])


def stage_positions(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, x, y, z) of text files with blocks `BEGIN PositionN`, `X = ..`, `Y = ..`, `Z = ..`, `END` after a line `Count = ..`.

    Strict: as many blocks as declared, numbered 1, 2, ... in order, each axis once; anything else is an error.
    """
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    blocks = F.regexp_extract_all("value", F.lit(r"BEGIN Position([0-9]+)\n((?:.*\n)*?)END"), 0)
    found = files.select("file", F.regexp_extract("value", "Count = ([0-9]+)", 1).cast("int").alias("count"), blocks.alias("blocks"))
    number = lambda b: F.regexp_extract(b, "BEGIN Position([0-9]+)", 1).cast("int")
    whole = (F.size("blocks") == F.col("count")) & F.forall(F.transform("blocks", lambda b, i: number(b) == i + 1), lambda ok: ok)
    each = found.select("file", F.explode(F.when(whole, F.col("blocks")).otherwise(F.raise_error(F.concat(F.lit("positions are not numbered as declared: "), F.col("file"))).cast("array<string>"))).alias("b"))

    def axis(c: str) -> Column:
        all_of = F.regexp_extract_all("b", F.lit(rf"(?m)^{c} = (-?[0-9.]+)$"), 1)
        return F.when(F.size(all_of) == 1, all_of[0].cast("double")).otherwise(F.raise_error(F.lit(f"axis {c} has to occur once")).cast("double"))

    return each.select("file", number(F.col("b")).alias("n"), *[axis(c.upper()).alias(c) for c in "xyz"])


def composed(levels: Column) -> Column:
    """(scale, shift) of a list of (scale, shift) steps, applied first to last: x -> x * scale + shift."""
    start = F.struct(F.lit(1.0).alias("scale"), F.lit(0.0).alias("shift"))
    return F.aggregate(levels, start, lambda s, t: F.struct((s["scale"] * t["scale"]).alias("scale"), (s["shift"] * t["scale"] + t["shift"]).alias("shift")))


def last_of_each(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by `order`, a column that is unique within the key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def parsed_xml(text: str, schema: str) -> Column:
    """The document in a column as a struct, attributes under `_` and their name: one pass over it, whatever the number of fields. Malformed documents are an error."""
    return F.from_xml(text, schema, {"mode": "FAILFAST"})
