"""Label volumes as foreground voxels: additive moments, contacts, overlap matching, mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def partial_moments(voxels: DataFrame, *keys: str) -> DataFrame:
    """Additive moments of each label in each part (keys): area, coordinate sums and intensity sum, least and most."""
    return voxels.where(F.col("label") > 0).groupBy(*keys, "label").agg(
        F.count("*").alias("area"), F.sum("z").alias("sum_z"), F.sum("y").alias("sum_y"), F.sum("x").alias("sum_x"), F.sum("v").alias("sum_v"), F.min("v").alias("min_v"), F.max("v").alias("max_v")
    )


def merge_moments(parts: DataFrame) -> DataFrame:
    """Moments of whole labels from those of parts."""
    sums = [F.sum(c).alias(c) for c in ("area", "sum_z", "sum_y", "sum_x", "sum_v")]
    return parts.groupBy("label").agg(*sums, F.min("min_v").alias("min_v"), F.max("max_v").alias("max_v"))


def with_planes(moments: DataFrame, planes: DataFrame) -> DataFrame:
    """moments with (plane_z, plane_area) of each label; a label without a plane, or a plane without a label, is an error."""
    sides = moments.withColumn("_m", F.lit(True)).join(planes.withColumn("_p", F.lit(True)), "label", "full")
    whole = F.when(F.col("_m") & F.col("_p"), F.col("plane_z")).otherwise(F.raise_error(F.concat(F.lit("labels of moments and planes differ: "), F.col("label").cast("string"))).cast("int"))
    return sides.withColumn("plane_z", whole).drop("_m", "_p")


def float_moments(voxels: DataFrame) -> DataFrame:
    """(label, area, mean, least, most) of intensities that may be NaN: one NaN makes all three NaN."""
    v = F.col("v").cast("double")
    some = F.max(F.isnan(v))
    held = voxels.where(F.col("label") > 0).groupBy("label").agg(F.count("*").alias("area"), some.alias("nan"), *[f(v).alias(n) for f, n in ((F.avg, "mean"), (F.min, "least"), (F.max, "most"))])
    return held.select("label", "area", *[F.when(F.col("nan"), F.lit(float("nan"))).otherwise(F.col(n)).alias(n) for n in ("mean", "least", "most")])


def finish(moments: DataFrame) -> DataFrame:
    """Centroids and means from moments."""
    return moments.select("label", "area", *[(F.col(f"sum_{c}") / F.col("area")).alias(f"centroid_{c}") for c in "zyx"], (F.col("sum_v") / F.col("area")).alias("mean_v"), "min_v", "max_v")


def representative_plane(voxels: DataFrame) -> DataFrame:
    """(label, plane_z, plane_area): the plane with the largest area, then the nearest to the centroid, then the least."""
    planes = voxels.where(F.col("label") > 0).groupBy("label", "z").agg(F.count("*").alias("plane_area"))
    own = W.partitionBy("label")
    distance = F.abs(F.col("z") * F.sum("plane_area").over(own) - F.sum(F.col("z") * F.col("plane_area")).over(own))
    ranked = planes.withColumn("far", distance).withColumn("k", F.row_number().over(own.orderBy(F.desc("plane_area"), "far", "z")))
    return ranked.where("k = 1").select("label", F.col("z").alias("plane_z"), "plane_area")


def contacts(voxels: DataFrame) -> DataFrame:
    """(a, b, n): faces between voxels of two different labels, a < b; six-connected."""
    held = voxels.where(F.col("label") > 0).select("z", "y", "x", "label")
    steps = F.array(*[F.struct(F.lit(dz).alias("z"), F.lit(dy).alias("y"), F.lit(dx).alias("x")) for dz, dy, dx in ((1, 0, 0), (0, 1, 0), (0, 0, 1))])
    ahead = held.select(F.explode(steps).alias("s"), "z", "y", "x", F.col("label").alias("first")).select(*[(F.col(c) + F.col(f"s.{c}")).alias(c) for c in "zyx"], "first")
    met = ahead.join(held, ["z", "y", "x"]).where(F.col("first") != F.col("label"))
    return met.groupBy(F.least("first", "label").alias("a"), F.greatest("first", "label").alias("b")).agg(F.count("*").alias("n"))


def overlap_counts(bands: DataFrame) -> DataFrame:
    """(band, a, b, both, area_a, area_b): pixels of each pair of labels and of each label, background 0 left out."""
    pairs = bands.where((F.col("a") > 0) & (F.col("b") > 0)).groupBy("band", "a", "b").agg(F.count("*").alias("both"))
    left = bands.where(F.col("a") > 0).groupBy("band", "a").agg(F.count("*").alias("area_a"))
    right = bands.where(F.col("b") > 0).groupBy("band", "b").agg(F.count("*").alias("area_b"))
    return pairs.join(left, ["band", "a"]).join(right, ["band", "b"])


def reciprocal_best(counts: DataFrame, least: tuple[int, int] = (0, 1)) -> DataFrame:
    """Pairs that are each other's only best by IoU, compared as exact fractions; ties are left out.

    least: numerator and denominator of the smallest IoU, inclusive. Fractions are compared by their first 62 binary
    places, in which any two with denominators below 2^31 differ; a larger union of pixels is an error.
    """
    union = F.col("area_a") + F.col("area_b") - F.col("both")
    safe = F.when(union < 1 << 31, union).otherwise(F.raise_error(F.lit("a union of 2^31 pixels or more")).cast("long"))
    rows = counts.withColumn("union", safe).where(F.col("both") * least[1] >= F.col("union") * least[0])
    high = F.expr("shiftleft(both, 31) div union")
    rows = rows.withColumn("high", high).withColumn("iou", F.shiftleft("high", 31) + F.expr("shiftleft(shiftleft(both, 31) % union, 31) div union")).drop("high")

    best_a = rows.withColumn("top_a", F.max("iou").over(W.partitionBy("band", "a"))).withColumn("top_b", F.max("iou").over(W.partitionBy("band", "b")))
    marked = best_a.withColumn("ties_a", F.sum((F.col("iou") == F.col("top_a")).cast("int")).over(W.partitionBy("band", "a"))).withColumn("ties_b", F.sum((F.col("iou") == F.col("top_b")).cast("int")).over(W.partitionBy("band", "b")))
    kept = (F.col("iou") == F.col("top_a")) & (F.col("iou") == F.col("top_b")) & (F.col("ties_a") == 1) & (F.col("ties_b") == 1)
    return marked.where(kept).select("band", "a", "b", "both", "union")


def strongest_neighbour(found: DataFrame, volumes: DataFrame, small: int) -> DataFrame:
    """(label, recipient, n): for labels under `small` voxels, the label not under it with most contact, ties to the least."""
    both = found.select("a", "b", "n").union(found.select("b", "a", "n"))
    sized = both.join(volumes.select(F.col("label").alias("a"), F.col("area").alias("area_a")), "a").join(volumes.select(F.col("label").alias("b"), F.col("area").alias("area_b")), "b")
    fit = sized.where((F.col("area_a") < small) & (F.col("area_b") >= small))
    best = fit.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("recipient"), F.max("n").alias("n"))
    return best.withColumnRenamed("a", "label")


def dense_labels(volumes: DataFrame, least: int) -> DataFrame:
    """(label, final): labels of at least `least` voxels numbered 1, 2, ... in order.

    Numbers come from counts of label ranges, so that no task holds all labels.
    """
    width = 1 << 16
    kept = volumes.where(F.col("area") >= least).select("label", F.floor(F.col("label") / width).alias("part"))
    before = kept.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
    here = kept.withColumn("k", F.row_number().over(W.partitionBy("part").orderBy("label")))
    return here.join(before, "part").select("label", (F.coalesce("before", F.lit(0)) + F.col("k")).cast("long").alias("final"))


def mapped_volumes(volumes: DataFrame, mapping: DataFrame) -> DataFrame:
    """(final, area) of labels through (label, final); unknown labels are an error."""
    joined = volumes.join(mapping, "label", "left").withColumn("final", F.coalesce("final", F.raise_error(F.concat(F.lit("label without a final id: "), F.col("label").cast("string"))).cast("long")))
    return joined.groupBy("final").agg(F.sum("area").alias("area"))


def bounding_boxes(voxels: DataFrame) -> DataFrame:
    """(label, z0, z1, y0, y1, x0, x1): half-open bounds."""
    found = [e.alias(n) for c in "zyx" for e, n in ((F.min(c), f"{c}0"), (F.max(c) + 1, f"{c}1"))]
    return voxels.where(F.col("label") > 0).groupBy("label").agg(*found)


def max_projection(voxels: DataFrame) -> DataFrame:
    """(y, x, v, n): the largest value over z."""
    return voxels.groupBy("y", "x").agg(F.max("v").alias("v"), F.count("*").alias("n"))


def block_means(voxels: DataFrame, size: int = 2) -> DataFrame:
    """(z, y, x, v): means of size x size blocks in a plane, rounded half to even; blocks that miss voxels count those there."""
    at = [F.floor(F.col(c) / size).cast("int").alias(c) for c in "yx"]
    return voxels.groupBy("z", *at).agg(F.bround(F.sum("v") / F.count("v"), 0).cast("long").alias("v"))


def plane_eligibility(voxels: DataFrame, share: float, filled: float) -> DataFrame:
    """(z, signal, fraction, eligible): signal is the 99th less the 50th percentile of a plane.

    A plane is eligible where its signal is at least `share` of the upper quartile of all positive signals, and at
    least `filled` of its voxels aren't background.
    """
    q = F.percentile("v", F.array(F.lit(0.5), F.lit(0.99)))
    planes = voxels.groupBy("z").agg((q[1] - q[0]).alias("signal"), (F.sum((F.col("label") != 0).cast("long")) / F.count("*")).alias("fraction"))
    level = planes.where(F.col("signal") > 0).agg(F.percentile("signal", 0.75).alias("level"))  # one row
    return planes.crossJoin(level).select("z", "signal", "fraction", ((F.col("signal") >= share * F.col("level")) & (F.col("fraction") >= filled)).alias("eligible"))


def flattened_background(voxels: DataFrame, low: float) -> DataFrame:
    """voxels with the values of background replaced by the plane's low percentile."""
    levels = voxels.groupBy("z").agg(F.percentile("v", low).alias("low"))
    return voxels.join(levels, "z").withColumn("v", F.when(F.col("label") == 0, F.col("low")).otherwise(F.col("v").cast("double"))).drop("low")


def overlap_screen(bands: DataFrame, share: int, least: int) -> DataFrame:
    """(band, n, content_a, content_b, accepted): both sides need max(least, ceil(share % of the band)) pixels with a label."""
    counts = bands.groupBy("band").agg(F.count("*").alias("n"), *[F.sum((F.col(c) > 0).cast("long")).alias(f"content_{c}") for c in "ab"])
    need = F.greatest(F.lit(least), F.ceil(F.col("n") * share / 100))
    return counts.withColumn("accepted", (F.col("content_a") >= need) & (F.col("content_b") >= need))
