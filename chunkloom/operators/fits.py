"""Fits by iteration: each round is a grouped sum over the data and a join with few coefficients.

No round gathers a group's rows in one place: residuals are column expressions, and only sums per group are
shuffled. Rounds are cut through tables, so that a plan doesn't grow with their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.operators.geodesics import geodesics  # noqa: F401
from chunkloom.operators.sweeps import swept


def _line_sums(points: DataFrame, weight: Column) -> DataFrame:
    x, y, w = F.col("x").cast("double"), F.col("y").cast("double"), weight * F.col("n")
    sums = {"s": w, "sx": w * x, "sy": w * y, "sxx": w * x * x, "sxy": w * x * y}
    return points.groupBy("tile").agg(*[F.sum(v).alias(k) for k, v in sums.items()], F.sum("n").alias("rows"))


def huber_lines(rows: DataFrame, ridge: float, delta: float, rounds: int) -> DataFrame:
    """(tile, slope, offset, n) of rows (tile, x, y): lines by reweighted least squares, with a ridge on the slope.

    A residual beyond delta gets the weight delta / |residual|. Equal points are counted once before the rounds.
    """
    points = cut(rows.groupBy("tile", "x", "y").agg(F.count("*").alias("n")))
    line = None
    for k in range(rounds):
        if line is None:
            sums = _line_sums(points, F.lit(1.0))
        else:
            off = F.abs(F.col("y") - F.col("slope") * F.col("x") - F.col("offset"))
            sums = _line_sums(points.join(line.select("tile", "slope", "offset"), "tile"), F.when(off <= delta, 1.0).otherwise(delta / off))
        det = F.col("s") * (F.col("sxx") + ridge) - F.col("sx") * F.col("sx")
        slope = (F.col("s") * F.col("sxy") - F.col("sx") * F.col("sy")) / det
        offset = ((F.col("sxx") + ridge) * F.col("sy") - F.col("sx") * F.col("sxy")) / det
        line = sums.select("tile", slope.alias("slope"), offset.alias("offset"), F.col("rows").alias("n"))
        if k % 5 == 4 or k == rounds - 1:  # few rounds in a plan
            line = cut(line)
    return line


def tile_shifts(edges: DataFrame, anchor: int, huber: float, most: float, rounds: int, tolerance: float = 0.0) -> DataFrame:
    """(axis, tile, at): positions with at(moving) - at(fixed) = shift as nearly as edges (fixed, moving, axis, shift, weight) allow.

    Damped sweeps: a tile moves half the way to the weighted mean of what its edges ask for. A residual beyond
    huber divides an edge's weight by |residual| / huber; positions stay within +-most, and the anchor stays at 0.
    Sweeps end early once no tile moves by more than the tolerance. They go over blocks of tiles; where a tile or a
    block has too many links for one row, over the rows of links.
    """
    kept = cut(edges.where((F.col("fixed") != F.col("moving")) & (F.col("weight") > 0) & F.col("shift").isNotNull()).select("axis", "fixed", "moving", "shift", "weight"), "links")
    found = swept(kept, anchor, huber, most, rounds, tolerance)
    return _shifts_by_rows(kept, anchor, huber, most, rounds, tolerance) if found is None else found


def _shifts_by_rows(kept: DataFrame, anchor: int, huber: float, most: float, rounds: int, tolerance: float) -> DataFrame:
    shift = F.col("shift").cast("double")
    ends = cut(
        kept.select("axis", F.col("moving").alias("tile"), F.col("fixed").alias("other"), shift.alias("ask"), "weight").unionByName(
            kept.select("axis", F.col("fixed").alias("tile"), F.col("moving").alias("other"), (-shift).alias("ask"), "weight")
        )
    )
    now = cut(ends.select("axis", "tile").distinct().withColumn("at", F.lit(0.0)))
    for _ in range(rounds):
        there = now.select("axis", F.col("tile").alias("other"), F.col("at").alias("from"))
        want = F.col("from") + F.col("ask")
        weight = F.col("weight") / F.greatest(F.lit(1.0), F.abs(want - F.col("at")) / huber)
        mean = (F.sum(weight * want) / F.sum(weight)).alias("mean")
        asked = ends.join(there, ["axis", "other"]).join(now, ["axis", "tile"]).groupBy("axis", "tile", "at").agg(mean)
        moved = F.least(F.greatest((F.col("at") + F.col("mean")) / 2, F.lit(-most)), F.lit(most))
        after = cut(asked.select("axis", "tile", F.when(F.col("tile") == anchor, 0.0).otherwise(moved).alias("at"), F.col("at").alias("before")))
        now = after.select("axis", "tile", "at")
        if tolerance and (after.agg(F.max(F.abs(F.col("at") - F.col("before")))).first()[0] or 0.0) <= tolerance:
            break
    return now


def shifts_without_outliers(edges: DataFrame, anchor: int, huber: float, most: float, rounds: int, reject: float, passes: int = 10) -> tuple[DataFrame, DataFrame]:
    """Positions, and the edges kept: solves, leaves out edges with a residual beyond `reject`, and solves again until none is."""
    kept = cut(edges)
    for _ in range(passes):
        found = tile_shifts(kept, anchor, huber, most, rounds)
        left, right = (found.select("axis", F.col("tile").alias(c), F.col("at").alias(f"at_{c}")) for c in ("fixed", "moving"))
        off = F.abs(F.col("at_moving") - F.col("at_fixed") - F.col("shift"))
        within = cut(kept.join(left, ["axis", "fixed"]).join(right, ["axis", "moving"]).where(off <= reject).select(*edges.columns))
        if within.count() == kept.count():
            return found, kept
        kept = within
    raise RuntimeError("the set of edges did not settle")


def peeled_lines(points: DataFrame, most: float, passes: int) -> DataFrame:
    """(tile, n, left_out, slope) of points (tile, x, y), one y for each x: leaves out the worst point, one a pass, while its leave-one-out residual is beyond most.

    The residual against the line of all others is r / (1 - h), with h the point's leverage, so no line is fitted
    twice. At ties the least x goes. Fewer than four points, or one x alone, are no support: nothing goes. Points that
    are left beyond the limit after all passes are an error.
    """
    kept = cut(points.select("tile", "x", "y"))
    x, y = F.col("x").cast("double"), F.col("y").cast("double")

    def fitted() -> DataFrame:
        sums = kept.groupBy("tile").agg(F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("vx"), F.covar_pop(x, y).alias("vxy"))
        return sums.withColumn("slope", F.when((F.col("n") >= 3) & (F.col("vx") > 0), F.col("vxy") / F.col("vx")))

    for _ in range(passes):
        residual = y - F.col("my") - F.col("slope") * (x - F.col("mx"))
        room = 1 - 1 / F.col("n") - (x - F.col("mx")) ** 2 / (F.col("n") * F.col("vx"))
        # Without this point the others share one x: there is no line to hold it against.
        alone = F.when(room > 1e-9, F.round(F.abs(residual / room), 6))
        seen = kept.join(fitted().where((F.col("n") >= 4) & F.col("slope").isNotNull()), "tile").select("tile", "x", alone.alias("off")).where(F.col("off") > most)
        worst = cut(seen.groupBy("tile").agg(F.max(F.struct("off", (-F.col("x")).alias("k"))).alias("m")).select("tile", (-F.col("m.k")).alias("x")))
        if worst.isEmpty():
            break
        kept = cut(kept.join(worst, ["tile", "x"], "left_anti"))
    else:
        raise RuntimeError(f"points beyond the limit are left after {passes} passes")
    counts = points.groupBy("tile").agg(F.count("*").alias("before"))
    return fitted().join(counts, "tile").select("tile", "n", (F.col("before") - F.col("n")).alias("left_out"), "slope")


def entropy_thresholds(histogram: DataFrame, rounds: int) -> DataFrame:
    """(channel, threshold) of histogram (channel, bin, n): minimum cross entropy by fixed-point rounds from the mean.

    With m the mean of the bins up to t and M that of the others, t becomes (M - m) / (ln M - ln m). A bin stands
    for its middle. A channel's bins are one array, as their number is fixed; t stays where one side is empty.
    """
    bins = histogram.groupBy("channel").agg(F.collect_list(F.struct((F.col("bin") + 0.5).alias("v"), "n")).alias("bins"))

    def total(value, keep) -> Column:
        return F.aggregate("bins", F.lit(0.0), lambda s, b: s + F.when(keep(b), value(b)).otherwise(0.0))

    def mean(keep) -> Column:
        return total(lambda b: b["v"] * b["n"], keep) / F.nullif(total(lambda b: b["n"].cast("double"), keep), F.lit(0.0))

    t = mean(lambda b: F.lit(True))
    found = bins.withColumn("t", t)
    for _ in range(rounds):
        low, high = mean(lambda b: b["v"] <= F.col("t")), mean(lambda b: b["v"] > F.col("t"))
        found = found.withColumns({"low": low, "high": high}).withColumn("t", F.coalesce((F.col("high") - F.col("low")) / (F.ln("high") - F.ln("low")), F.col("t")))
    return found.select("channel", F.col("t").alias("threshold"))


def minor_angles(voxels: DataFrame) -> DataFrame:
    """(label, angle): direction of the least spread of a label's voxels in the plane, in radians from x, within (-pi/2, pi/2].

    In closed form from whole-number sums; null where the spread is equal in all directions.
    """
    y, x = F.col("y").cast("long"), F.col("x").cast("long")
    s = voxels.where(F.col("label") != 0).groupBy("label").agg(F.count("*").alias("n"), F.sum(y).alias("y"), F.sum(x).alias("x"), F.sum(y * y).alias("yy"), F.sum(x * x).alias("xx"), F.sum(y * x).alias("yx"))
    both = F.col("n") * F.col("yx") - F.col("y") * F.col("x")
    apart = (F.col("n") * F.col("xx") - F.col("x") * F.col("x")) - (F.col("n") * F.col("yy") - F.col("y") * F.col("y"))
    major = F.atan2((2 * both).cast("double"), apart.cast("double")) / 2
    return s.select("label", F.when((both != 0) | (apart != 0), F.when(major > 0, major - F.pi() / 2).otherwise(major + F.pi() / 2)).alias("angle"))


def smoothed(points: DataFrame, sigma: int) -> DataFrame:
    """(track, tile, at, dz) of points (track, tile, at, dz, score): Gaussian means over points of a track within 3 sigma.

    Weights are exp(-d^2 / 2 sigma^2) * max(score, 0.05). Points meet by cells of 3 sigma, so no pair beyond two cells is made.
    """
    width = 3 * sigma
    cell = F.floor(F.col("at") / width)
    near = points.select("track", F.col("at").alias("there"), F.col("dz").alias("value"), F.col("score").alias("trust"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    d = (F.col("at") - F.col("there")).cast("double")
    weight = F.exp(-d * d / (2.0 * sigma * sigma)) * F.greatest(F.col("trust").cast("double"), F.lit(0.05))
    met = points.select("track", "tile", "at", cell.alias("cell")).join(near, ["track", "cell"]).where(F.abs(d) <= width)
    return met.groupBy("track", "tile", "at").agg((F.sum(weight * F.col("value")) / F.sum(weight)).alias("dz"))
