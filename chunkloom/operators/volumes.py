"""Volumes as voxel tables: fusion of views, subtraction, composites, block culling, surfaces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut


def fused(views: DataFrame) -> DataFrame:
    """(z, y, x, v, n) of views (view, z, y, x, v, weight): weighted means of the views at each voxel; without weight, nothing."""
    held = views.where(F.col("weight") > 0)
    return held.groupBy("z", "y", "x").agg((F.sum(F.col("weight") * F.col("v")) / F.sum("weight")).alias("v"), F.count("*").alias("n"))


def subtracted(target: DataFrame, reference: DataFrame, slope: float, offset: float, keep: bool) -> DataFrame:
    """target (z, y, x, v) less slope * reference - offset, rounded half to even and not below 0.

    Where either side has no positive value, the voxel is 0, or with `keep` stays as it is.
    """
    both = target.join(reference.select("z", "y", "x", F.col("v").alias("r")), ["z", "y", "x"], "left")
    supported = (F.col("v") > 0) & F.coalesce(F.col("r") > 0, F.lit(False))
    less = F.greatest(F.rint(F.col("v") - slope * F.col("r") - offset), F.lit(0.0)).cast("long")
    return both.select("z", "y", "x", F.when(supported, less).otherwise(F.col("v") if keep else F.lit(0)).cast("long").alias("v"))


def patch_ratios(first: DataFrame, second: DataFrame, size: int, least: int) -> DataFrame:
    """(z, py, px, n, ratio, mad): median and median absolute deviation of ln(b / a) over patches with `least` or more voxels positive in both."""
    both = first.join(second.select("z", "y", "x", F.col("v").alias("w")), ["z", "y", "x"]).where((F.col("v") > 0) & (F.col("w") > 0))
    rows = both.select("z", F.floor(F.col("y") / size).alias("py"), F.floor(F.col("x") / size).alias("px"), F.ln(F.col("w") / F.col("v")).alias("r"))
    own = rows.groupBy("z", "py", "px").agg(F.collect_list("r").alias("all"), F.median("r").alias("ratio")).where(F.size("all") >= least)  # at most size * size values
    return own.select("z", "py", "px", F.size("all").cast("long").alias("n"), "ratio", F.explode("all").alias("r")).groupBy("z", "py", "px", "n", "ratio").agg(F.median(F.abs(F.col("r") - F.col("ratio"))).alias("mad"))


def composite(planes: DataFrame) -> DataFrame:
    """(y, x, top, mean, n) of planes (tile, y, x, v, y0, x0): tiles placed at their offsets on one canvas."""
    at = planes.groupBy((F.col("y") + F.col("y0")).alias("y"), (F.col("x") + F.col("x0")).alias("x"))
    return at.agg(F.max("v").alias("top"), (F.sum("v") / F.count("v")).alias("mean"), F.count("*").alias("n"))


def block_sources(boxes: DataFrame, width: int, height: int, pad: int) -> DataFrame:
    """(kx, ky, n, first): output blocks and the source boxes that meet them, widened by `pad`."""
    across = F.sequence(F.floor((F.col("lo") - pad) / width), F.floor((F.col("hi") - 1 + pad) / width))
    down = F.sequence(F.floor((F.col("y_lo") - pad) / height), F.floor((F.col("y_hi") - 1 + pad) / height))
    met = boxes.where((F.col("hi") > F.col("lo")) & (F.col("y_hi") > F.col("y_lo"))).withColumn("kx", F.explode(across)).withColumn("ky", F.explode(down))
    return met.where((F.col("kx") >= 0) & (F.col("ky") >= 0)).groupBy("kx", "ky").agg(F.count("*").alias("n"), F.min("id").alias("first"))


def ray_maxima(voxels: DataFrame, depth: int) -> DataFrame:
    """(ray, y, x, v, steps): along rays of `depth` planes from the top, the greatest value before the first missing voxel."""
    rays = voxels.select(F.floor(F.col("z") / depth).alias("ray"), "y", "x", (depth - 1 - F.col("z") % depth).alias("step"), "v")
    own = rays.groupBy("ray", "y", "x").agg(F.array_sort(F.collect_list(F.struct("step", "v"))).alias("s"))  # at most `depth` entries
    near = F.filter(F.transform("s", lambda e, i: F.struct((e["step"] == i).alias("ok"), e["v"].alias("v"))), lambda e: e["ok"])
    return own.select("ray", "y", "x", F.transform(near, lambda e: e["v"]).alias("v")).where(F.size("v") > 0).select("ray", "y", "x", F.array_max("v").alias("v"), F.size("v").cast("long").alias("steps"))


def sharpest(voxels: DataFrame, size: int) -> DataFrame:
    """(ky, kx, z, energy): for blocks of an area the plane whose values vary most against their mean, the first at ties."""
    v = F.col("v").cast("decimal(38,0)")
    at = voxels.groupBy("z", F.floor(F.col("y") / size).alias("ky"), F.floor(F.col("x") / size).alias("kx"))
    sums = at.agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.sum(v * v).cast("double").alias("q"))
    energy = F.round(F.col("q") * F.col("n") / (F.col("s").cast("double") * F.col("s")) - 1, 9)
    best = F.max(F.struct(energy.alias("e"), (-F.col("z")).alias("z")))
    return sums.where("s > 0").groupBy("ky", "kx").agg(best.alias("b")).select("ky", "kx", (-F.col("b.z")).alias("z"), F.col("b.e").alias("energy"))


def on_faces(cells: DataFrame, faces: DataFrame | None, vertices: DataFrame) -> DataFrame:
    """cells (cell, face, b0, b1, b2) with `value`, the barycentric mean of the face's vertices (vertex, value); an unknown face or vertex is an error.

    faces: (face, v0, v1, v2), or None where cells have v0, v1 and v2 themselves.
    """
    known = cells if faces is None else cells.join(faces, "face", "left")
    corners = F.array(*[F.struct(F.col(f"v{i}").alias("vertex"), F.col(f"b{i}").alias("w")) for i in range(3)])
    each = known.select("cell", F.explode(corners).alias("c")).select("cell", "c.vertex", "c.w").join(vertices, "vertex", "left")
    missing = F.raise_error(F.concat(F.lit("a face or vertex is unknown for cell "), F.col("cell").cast("string"))).cast("double")
    return each.groupBy("cell").agg(F.sum(F.col("w") * F.coalesce("value", missing)).alias("value"))


def on_tissue_side(points: DataFrame, most: float) -> DataFrame:
    """points (px, py, pz, qx, qy, qz, nx, ny, nz, rim) with `depth` and `inside`: q is the nearest surface point and n its outward normal."""
    off = {c: F.col(f"p{c}") - F.col(f"q{c}") for c in "xyz"}
    signed = sum((off[c] * F.col(f"n{c}") for c in "xyz"), F.lit(0.0))
    depth = F.sqrt(sum((off[c] * off[c] for c in "xyz"), F.lit(0.0)))
    return points.withColumn("depth", depth).withColumn("inside", (signed <= 0) & ~F.col("rim") & (F.col("depth") <= most))


def nearest_donors(links: DataFrame, donors: DataFrame, most: int = 600) -> DataFrame:
    """(node, donor, steps): for each node that links (a, b) reach from a donor, the donor fewest links away, the least at ties.

    All donors spread at once, a round a step.
    """
    both = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    known = front = cut(donors.select("node", F.col("node").alias("donor"), F.lit(0).alias("steps")).distinct())
    for step in range(1, most):
        near = both.join(front, both["a"] == front["node"]).groupBy("b").agg(F.min("donor").alias("donor")).withColumnRenamed("b", "node")
        front = cut(near.join(known.select("node"), "node", "left_anti").withColumn("steps", F.lit(step)))
        if front.isEmpty():
            return known
        known = cut(known.unionByName(front))
    raise RuntimeError(f"nodes lie {most} links or more from any donor")


def edge_ramps(y: Column, x: Column, width: float, coefficients: tuple[float, ...]) -> Column:
    """exp of four quadratic ramps at the edges of a unit square, 1 in its inside."""
    sides = (y, 1 - y, x, 1 - x)
    return F.exp(sum((c * F.pow(F.greatest(1 - s / width, F.lit(0.0)), F.lit(2.0)) for c, s in zip(coefficients, sides)), F.lit(0.0)))


def cosine_modes(y: Column, x: Column, z: Column, degree: int) -> list[Column]:
    """Products of cosines up to order 2 in the plane, for each degree in z, those damped by 1 / (1 + degree^2)."""
    orders = [(a, b) for a in range(3) for b in range(3) if 0 < a + b < 3]
    return [F.cos(F.pi() * a * y) * F.cos(F.pi() * b * x) * F.cos(F.pi() * d * z) / (1 + d * d) for d in range(degree + 1) for a, b in orders]
