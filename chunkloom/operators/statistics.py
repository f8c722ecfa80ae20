"""Robust statistics of samples and measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.operators.ranges import quantiles, running


def exact_quantiles(samples: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """(channel, q0, q1, ...): exact quantiles with linear interpolation."""
    return quantiles(samples, "channel", "v", shares).drop("n")


def scaling(samples: DataFrame, low: float, high: float, most: int) -> DataFrame:
    """(channel, offset, scale) that map the quantiles low and high to 0 and most; an empty range is an error."""
    q = exact_quantiles(samples, (low, high))
    width = F.col("q1") - F.col("q0")
    safe = F.when(width > 0, width).otherwise(F.raise_error(F.concat(F.lit("no range in channel "), F.col("channel"))).cast("double"))
    return q.select("channel", F.col("q0").alias("offset"), (most / safe).alias("scale"))


def quantisation(samples: DataFrame, many: int, least: float) -> DataFrame:
    """(channel, n, lower, scale) from the quantiles 0.0001 and 0.9999 (0.999 under `many` values), at least `least` apart around their middle."""
    q = quantiles(samples, "channel", "v", (0.0001, 0.999, 0.9999)).select("channel", "n", F.col("q0").alias("lo"), F.when(F.col("n") >= many, F.col("q2")).otherwise(F.col("q1")).alias("hi"))
    lower = F.when(F.col("hi") - F.col("lo") < least, (F.col("hi") + F.col("lo")) / 2 - least / 2).otherwise(F.col("lo"))
    return q.select("channel", "n", lower.alias("lower"), (65534 / F.greatest(F.col("hi") - F.col("lo"), F.lit(least))).alias("scale"))


def histogram(samples: DataFrame, bins: int) -> DataFrame:
    """(channel, bin, n): equal widths from the least to the most value of a channel, the last bin closed."""
    ends = samples.groupBy("channel").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))))
    return samples.join(ends, "channel").groupBy("channel", place.cast("long").alias("bin")).agg(F.count("*").alias("n"))


def rank_percentiles(samples: DataFrame, shares: tuple[int, ...]) -> DataFrame:
    """(channel, percent, v): the value at rank ceil(percent / 100 * n), from counts of values."""
    reached = running(samples.groupBy("channel", "v").agg(F.count("*").alias("n")), "channel", "v", "n")
    asked = reached.withColumn("percent", F.explode(F.array(*[F.lit(s) for s in shares])))
    rank = F.greatest(F.lit(1), F.ceil(F.col("percent") * F.col("total") / 100))
    return asked.where((F.col("through") >= rank)).groupBy("channel", "percent").agg(F.min("v").alias("v"))


def threshold_cut(samples: DataFrame, share: int) -> DataFrame:
    """(channel, v): the least value by which the running sum of values reaches share percent of the total."""
    run = running(samples.groupBy("channel", "v").agg(F.sum("v").alias("s")), "channel", "v", "s")
    return run.where(F.col("through") * 100 >= F.col("total") * share).groupBy("channel").agg(F.min("v").alias("v"))


def distribution(samples: DataFrame) -> DataFrame:
    """(channel, n, mean, std, median, mad, p16, p84): moments, median absolute deviation and outer quantiles; std of one value is 0."""
    middle = quantiles(samples, "channel", "v", (0.5, 0.16, 0.84)).select("channel", F.col("q0").alias("median"), F.col("q1").alias("p16"), F.col("q2").alias("p84"))
    spread = quantiles(samples.join(middle, "channel").select("channel", F.abs(F.col("v") - F.col("median")).alias("d")), "channel", "d", (0.5,)).select("channel", F.col("q0").alias("mad"))
    moments = samples.groupBy("channel").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.coalesce(F.stddev_samp("v"), F.lit(0.0)).alias("std"))
    return moments.join(middle, "channel").join(spread, "channel").select("channel", "n", "mean", "std", "median", "mad", "p16", "p84")


def robust_keep(samples: DataFrame, times: int) -> DataFrame:
    """(channel, kept, left_out): rows within `times` median absolute deviations of the median, and the others."""
    d = distribution(samples).select("channel", "median", "mad")
    inside = F.abs(F.col("v") - F.col("median")) <= F.col("mad") * times
    return samples.join(d, "channel").groupBy("channel").agg(F.sum(inside.cast("long")).alias("kept"), F.sum((~inside).cast("long")).alias("left_out"))


def quantised(samples: DataFrame, scale: DataFrame, most: int) -> DataFrame:
    """samples with q = rint(clip((v - offset) * scale, 0, most))."""
    raw = (F.col("v") - F.col("offset")) * F.col("scale")
    return samples.join(scale, "channel").withColumn("q", F.rint(F.least(F.greatest(raw, F.lit(0.0)), F.lit(float(most)))).cast("long"))


def track_medians(tracks: DataFrame, least: int) -> DataFrame:
    """(tile, track, dz, score, n): medians over valid rows with a score of at least `least`."""
    return tracks.where(F.col("valid") & (F.col("score") >= least)).groupBy("tile", "track").agg(F.median("dz").alias("dz"), F.median("score").alias("score"), F.count("*").alias("n"))


def tile_balanced(tracks: DataFrame) -> DataFrame:
    """(track, p90): the median over tiles of each tile's 90th percentile of |dz|, so that large tiles weigh no more."""
    own = tracks.groupBy("track", "tile").agg(F.percentile(F.abs("dz"), F.lit(0.9)).alias("p"))
    return own.groupBy("track").agg(F.round(F.median("p"), 6).alias("p90"))


def weighted_moments(voxels: DataFrame) -> DataFrame:
    """(label, weight, mean_z, mean_y, mean_x, zz, zy, zx, yy, yx, xx): intensity-weighted centroid and covariances of each label, from exact sums."""
    d, axes = "decimal(38,0)", "zyx"
    terms = [(a, b) for i, a in enumerate(axes) for b in axes[i:]]
    v = F.col("v").cast(d)
    sums = voxels.where(F.col("label") > 0).groupBy("label").agg(
        F.sum("v").alias("weight"), *[F.sum((v * F.col(a)).cast(d)).alias(f"s{a}") for a in axes], *[F.sum((v * F.col(a) * F.col(b)).cast(d)).alias(f"s{a}{b}") for a, b in terms]
    )
    exact = {c: F.col(c).cast(d) for c in ("weight", *[f"s{a}" for a in axes], *[f"s{a}{b}" for a, b in terms])}
    means = [F.round(exact[f"s{a}"].cast("double") / F.col("weight"), 6).alias(f"mean_{a}") for a in axes]
    apart = lambda a, b: (exact["weight"] * exact[f"s{a}{b}"]).cast(d) - (exact[f"s{a}"] * exact[f"s{b}"]).cast(d)
    return sums.select("label", "weight", *means, *[F.round(apart(a, b).cast("double") / F.col("weight") / F.col("weight"), 6).alias(f"{a}{b}") for a, b in terms])


def correlation(left: Column, right: Column, least: int) -> Column:
    """Pearson's r; null under `least` rows or without variance."""
    n = F.count(F.when(left.isNotNull() & right.isNotNull(), 1))
    return F.when((n >= least) & (F.var_pop(left) > 0) & (F.var_pop(right) > 0), F.corr(left.cast("double"), right.cast("double")))


def linear_fit(tracks: DataFrame) -> DataFrame:
    """(tile, slope, n): score-weighted least squares of dz on score, null under three rows; from exact sums."""
    w, x, y = F.col("score"), F.col("score"), F.col("dz")
    s = tracks.where("valid").groupBy("tile").agg(F.count("*").alias("n"), F.sum(w).alias("w"), F.sum(w * x).alias("wx"), F.sum(w * y).alias("wy"), F.sum(w * x * x).alias("wxx"), F.sum(w * x * y).alias("wxy"))
    below = F.col("w") * F.col("wxx") - F.col("wx") * F.col("wx")
    return s.select("tile", F.when((F.col("n") >= 3) & (below != 0), F.round((F.col("w") * F.col("wxy") - F.col("wx") * F.col("wy")) / below, 9)).alias("slope"), "n")
