"""Gates, profiles, neighbourhoods and grids over measurement tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut

#: Places compared with a place, on average, in the cells that nearest_distance() starts from.
CROWD = 4
#: Asked places at most this many are sent to the tasks, so that few wide cells don't hold all places.
FEW = 2000


def _within(asked: DataFrame, places: DataFrame, cell: float, few: bool) -> DataFrame:
    """(source, px, py, id, d2): squared distance from each asked place to the nearest place with another id of its source within `cell`, for those that have one.

    Asked places meet only those in their own and the eight cells around. Tables that grow are shuffled, whatever
    their files' size.
    """
    at = [F.floor(F.col("px") / cell).alias("cx"), F.floor(F.col("py") / cell).alias("cy")]
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    near = asked.select("source", "px", "py", "id", *at, around.alias("s")).select("source", "px", "py", "id", (F.col("cx") + F.col("s.a")).alias("cx"), (F.col("cy") + F.col("s.b")).alias("cy"))
    near = F.broadcast(near) if few else near.hint("merge")
    other = places.select("source", F.col("px").alias("ox"), F.col("py").alias("oy"), "low", "high", *at)
    d2 = (F.col("px") - F.col("ox")) * (F.col("px") - F.col("ox")) + (F.col("py") - F.col("oy")) * (F.col("py") - F.col("oy"))
    met = other.join(near, ["source", "cx", "cy"]).where((d2 <= cell * cell) & ((F.col("low") != F.col("id")) | (F.col("high") != F.col("id"))))
    return met.groupBy("source", "px", "py", "id").agg(F.min(d2).alias("d2"))


def nearest_distance(points: DataFrame, cell: int, whole: bool = False) -> DataFrame:
    """(id, d2): squared distance to the nearest point of the same source with another id within `cell`, null beyond it.

    With `whole`, cells grow for the points still without an answer, until all have one or a cell spans all points;
    null is left for the only point of a source.

    Points at one place count once, and are 0 apart. Cells start so small that a place meets few others, and double for
    the places without an answer. These have no other place within half a cell, so few of them fit into a cell, and
    each round's work stays in proportion to the places, however dense they are.
    """
    points = points.select("id", "source", "px", "py")
    finite = [F.abs(F.col(c).cast("double")) < float("inf") for c in ("px", "py")]  # not so for nulls, and for NaN
    places = points.where(finite[0] & finite[1] & F.col("source").isNotNull()).groupBy("source", "px", "py").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    places = cut(places)
    ends = places.agg(*[(F.max(c) - F.min(c)).alias(c) for c in ("px", "py")], F.count("*").alias("n")).first()
    span, width = max(ends["px"] or 0, ends["py"] or 0), float(cell)
    while width > 2.0**-20 * cell:
        held = places.groupBy("source", F.floor(F.col("px") / width), F.floor(F.col("py") / width)).agg(F.count("*").alias("n"))
        if (held.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0) <= CROWD * ends["n"]:
            break
        width /= 2
    key = ["source", "px", "py"]
    found = places.where("low != high").select(*key, ((F.col("px") - F.col("px")) * (F.col("py") - F.col("py"))).alias("d2"))
    asked, few = places.where("low = high").select(*key, F.col("low").alias("id")), False
    while True:
        got = cut(_within(asked, places, width, few))
        found = found.unionByName(got.drop("id"))
        asked = cut(asked.join(got.select(*key).hint("merge"), key, "left_anti"))
        left = asked.count()
        if not left or width >= (2 * span if whole else cell):
            break
        width, few = width * 2, left <= FEW
    least = points.join(found.hint("merge"), key).groupBy("id").agg(F.min("d2").alias("d2"))
    return points.select("id").join(least.hint("merge"), "id", "left")


def pooled(sums: DataFrame, near: DataFrame) -> DataFrame:
    """(centre, bin, total, n): sums and counts of each centre's neighbourhood (centre, member)."""
    return near.join(sums, near["member"] == sums["vertex"]).groupBy("centre", "bin").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def balanced_weights(rows: DataFrame) -> DataFrame:
    """rows (family, group, id) with `weight` = 1 / (groups of the family * rows of the group)."""
    size = rows.groupBy("family", "group").agg(F.count("*").alias("n"))
    many = size.groupBy("family").agg(F.count("*").alias("groups"))
    return rows.join(size, ["family", "group"]).join(many, "family").withColumn("weight", 1 / (F.col("groups") * F.col("n"))).drop("n", "groups")


def peak_crossing(profile: DataFrame, share: int) -> DataFrame:
    """(key, peak, crossing): the highest bin, and the first bin after it at or under share percent of the peak."""
    own = W.partitionBy("key")
    top = profile.withColumn("high", F.max("v").over(own)).withColumn("peak", F.min(F.when(F.col("v") == F.max("v").over(own), F.col("bin"))).over(own))
    below = F.when((F.col("bin") > F.col("peak")) & (F.col("v") * 100 <= F.col("high") * share), F.col("bin"))
    return top.groupBy("key").agg(F.first("peak").alias("peak"), F.min(below).alias("crossing"))


def turnaround(profile: DataFrame) -> DataFrame:
    """(key, least_bin, most_bin): bins of the least value and of the greatest after it, first ones at ties."""
    own = W.partitionBy("key")
    low = profile.withColumn("least_bin", F.min(F.struct("v", "bin")).over(own)["bin"])
    return low.where(F.col("bin") >= F.col("least_bin")).groupBy("key").agg(F.first("least_bin").alias("least_bin"), F.max(F.struct(F.col("v"), (-F.col("bin")).alias("b")))["b"].alias("m")).select("key", "least_bin", (-F.col("m")).alias("most_bin"))


def first_run(flags: DataFrame) -> DataFrame:
    """(key, start, stop): the first stretch of neighbouring bins (key, bin, inside) that are inside."""
    inside = flags.where("inside")
    numbered = inside.withColumn("k", F.col("bin") - F.row_number().over(W.partitionBy("key").orderBy("bin")))
    runs = numbered.groupBy("key", "k").agg(F.min("bin").alias("start"), (F.max("bin") + 1).alias("stop"))
    return runs.groupBy("key").agg(F.min(F.struct("start", "stop")).alias("r")).select("key", "r.start", "r.stop")


def slab_windows(stacks: DataFrame, depth: int, halo: int) -> DataFrame:
    """(stack, core_start, core_stop, read_start, read_stop): cores of `depth` planes and their reads, clipped."""
    start = F.explode(F.when(F.col("planes") > 0, F.sequence(F.lit(0).cast("long"), F.col("planes") - 1, F.lit(depth).cast("long"))))
    rows = stacks.select("stack", "planes", start.alias("core_start")).withColumn("core_stop", F.least(F.col("core_start") + depth, F.col("planes")))
    return rows.select("stack", "core_start", "core_stop", F.greatest(F.col("core_start") - halo, F.lit(0)).alias("read_start"), F.least(F.col("core_stop") + halo, F.col("planes")).alias("read_stop"))


def chunk_edges(stacks: DataFrame, chunks: int) -> DataFrame:
    """(stack, start, stop): `chunks` near-equal ranges of planes, empty ones dropped."""
    rows = stacks.select("stack", "planes", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("i"))
    edge: list[Column] = [F.floor(F.col("planes") * (F.col("i") + k) / chunks) for k in (0, 1)]
    return rows.select("stack", edge[0].alias("start"), edge[1].alias("stop")).where(F.col("stop") > F.col("start"))


def verdicts(planes: DataFrame, least: int, near: int) -> DataFrame:
    """(key, n, verdict): unverified under `least` confident planes, verified where their median is within `near`, else contradicted."""
    found = planes.groupBy("key").agg(F.count(F.when(F.col("sure"), 1)).alias("n"), F.median(F.when(F.col("sure"), F.abs("shift"))).alias("m"))
    return found.select("key", "n", F.when(F.col("n") < least, "unverified").when(F.col("m") <= near, "verified").otherwise("contradicted").alias("verdict"))


def bead_flags(beads: DataFrame, margin: int, size: int, bright: int, apart: int, cell: int) -> DataFrame:
    """(id, inside, unsaturated, isolated, good)."""
    near = nearest_distance(beads, cell)
    inside = (F.col("px") >= margin) & (F.col("px") < size - margin)
    marked = beads.join(near.hint("merge"), "id").select("id", inside.alias("inside"), (F.col("peak") < bright).alias("unsaturated"), F.coalesce(F.col("d2") > apart * apart, F.lit(True)).alias("isolated"))
    return marked.withColumn("good", F.col("inside") & F.col("unsaturated") & F.col("isolated"))


def encircled(voxels: DataFrame) -> DataFrame:
    """(z, label, around): labels in a plane that touch exactly one other label, and neither background nor the edge."""
    held = voxels.select("z", "y", "x", "label")
    step = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))]))
    out = held.where(F.col("label") > 0).select("z", F.col("label").alias("own"), "y", "x", step.alias("s")).select("z", "own", (F.col("y") + F.col("s.a")).alias("y"), (F.col("x") + F.col("s.b")).alias("x"))
    met = out.join(held, ["z", "y", "x"], "left").withColumn("near", F.coalesce("label", F.lit(0))).where(F.col("near") != F.col("own"))
    found = met.groupBy("z", "own").agg(F.min("near").alias("low"), F.max("near").alias("high"))
    return found.where((F.col("low") == F.col("high")) & (F.col("low") > 0)).select("z", F.col("own").alias("label"), F.col("low").alias("around"))


def mesh_boundary(faces: DataFrame) -> DataFrame:
    """(a, b): edges that exactly one triangle (v0, v1, v2) uses."""
    pairs = F.explode(F.array(*[F.struct(F.least(p, q).alias("a"), F.greatest(p, q).alias("b")) for p, q in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))]))
    return faces.select(pairs.alias("e")).groupBy("e.a", "e.b").agg(F.count("*").alias("n")).where("n = 1").select("a", "b")


def grid_ratios(points: DataFrame, width: int, least: int) -> DataFrame:
    """(gx, gy, ratio, n): median logarithms of ratios by grid cell, cells with under `least` points left out."""
    cells = points.groupBy(F.floor(F.col("px") / width).alias("gx"), F.floor(F.col("py") / width).alias("gy"))
    return cells.agg(F.round(F.median(F.log(F.col("num") / F.col("den"))), 9).alias("ratio"), F.count("*").alias("n")).where(F.col("n") >= least)


def chosen_names(rows: DataFrame, include: str, exclude: str) -> DataFrame:
    """Rows whose name the first expression finds and the second does not."""
    return rows.where(F.col("name").rlike(include) & ~F.col("name").rlike(exclude))


def weighted_centres(voxels: DataFrame, share: int) -> DataFrame:
    """(z, centre_y, centre_x): intensity-weighted centres of planes that hold share percent of the heaviest plane's mass.

    One row a plane is left when planes are compared.
    """
    planes = voxels.groupBy("z").agg(F.sum("v").alias("m"), F.sum(F.col("v") * F.col("y")).alias("my"), F.sum(F.col("v") * F.col("x")).alias("mx"))
    top = F.max("m").over(W.partitionBy())
    return planes.withColumn("top", top).where(F.col("m") * 100 >= F.col("top") * share).select("z", F.round(F.col("my") / F.col("m"), 6).alias("centre_y"), F.round(F.col("mx") / F.col("m"), 6).alias("centre_x"))


def radial_means(voxels: DataFrame, y0: int, x0: int) -> DataFrame:
    """(z, r2, mean, n): means by squared distance from an axis."""
    r2 = (F.col("y") - y0) * (F.col("y") - y0) + (F.col("x") - x0) * (F.col("x") - x0)
    return voxels.groupBy("z", r2.alias("r2")).agg(F.round(F.sum("v") / F.count("v"), 6).alias("mean"), F.count("*").alias("n"))
