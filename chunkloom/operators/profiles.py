"""Shapes of profiles (key, bin, v): half widths, crossings, asymmetry. A bin without a row is not supported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def peaks(profile: DataFrame) -> DataFrame:
    """(key, peak, high, at): the first highest bin, its value, and the values by bin; a profile has few bins."""
    top = F.max(F.struct("v", (-F.col("bin")).alias("b")))
    found = profile.groupBy("key").agg(top.alias("t"), F.map_from_entries(F.collect_list(F.struct("bin", F.col("v").cast("double")))).alias("at"))
    return found.select("key", (-F.col("t.b")).alias("peak"), F.col("t.v").cast("double").alias("high"), "at")


def _bins(keep) -> Column:
    """The bins for which keep(bin, value) holds, in order."""
    return F.array_sort(F.map_keys(F.map_filter("at", keep)))


def half_widths(profile: DataFrame) -> DataFrame:
    """(key, peak, width): distance of the crossings of half the peak nearest to it, null where a side has none or the peak isn't positive."""
    half = F.col("high") / 2
    own = peaks(profile).withColumns(
        {"left": F.array_max(_bins(lambda k, v: (k <= F.col("peak")) & (v < half))), "right": F.array_min(_bins(lambda k, v: (k >= F.col("peak")) & (v < half)))}
    )

    def cross(first: Column, second: Column) -> Column:
        a, b = F.col("at")[first], F.col("at")[second]
        return F.when(a.isNull() | b.isNull() | (a == b), first.cast("double")).otherwise(first + (half - a) / F.nullif(b - a, F.lit(0.0)))

    width = cross(F.col("right") - 1, F.col("right")) - cross(F.col("left"), F.col("left") + 1)
    return own.select("key", "peak", F.when(F.col("high") > 0, width).alias("width"))


def shapes(profile: DataFrame, first: int, last: int, share: float, near: tuple[int, int]) -> DataFrame:
    """(key, ratio, near_ratio, span) of profiles over the bins first to last.

    ratio: sum after the peak by the sum before it, over the offsets that both sides have; near_ratio: the least
    quotient of single offsets from near[0] to near[1]; span: from the first to the last bin of `share` of the peak.
    """
    own = peaks(profile).withColumn("reach", F.least(F.col("peak") - first, F.lit(last) - F.col("peak")))
    steps = F.when(F.col("reach") >= 1, F.sequence(F.lit(1), F.col("reach").cast("int"))).otherwise(F.array().cast("array<int>"))
    both = F.filter(F.transform(steps, lambda o: F.struct(o.alias("o"), F.col("at")[F.col("peak") - o].alias("m"), F.col("at")[F.col("peak") + o].alias("p"))), lambda s: s["m"].isNotNull() & s["p"].isNotNull())
    total = lambda side: F.aggregate("both", F.lit(0.0), lambda t, s: t + F.greatest(s[side], F.lit(0.0)))
    own = own.withColumn("both", both).withColumns({"minus": total("m"), "plus": total("p")})
    single = F.transform(F.filter("both", lambda s: s["o"].between(*near) & (s["m"] > 0)), lambda s: F.greatest(s["p"], F.lit(0.0)) / s["m"])
    above = _bins(lambda k, v: v >= F.col("high") * share)
    return own.select(
        "key",
        F.when((F.col("reach") >= 2) & (F.col("minus") > 0), F.col("plus") / F.col("minus")).alias("ratio"),
        F.when(F.col("reach") >= near[1], F.array_min(single)).alias("near_ratio"),
        F.when(F.col("high") > 0, F.array_max(above) - F.array_min(above) + 1).alias("span"),
    )


def crossings(profile: DataFrame, share: float) -> DataFrame:
    """(key, side, depth, support) of profiles (key, bin, v, n): where the value falls to `share` of the peak, walking away from it.

    Interpolated between the last bin above and the first one not above; a bin without support before that leaves
    none. support is the least n of the peak and the two bins.
    """
    counts = profile.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"))
    own = peaks(profile).join(counts, "key").where(F.col("high") > 0)
    level = F.col("high") * share
    sides = F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.lit(s).alias("step")) for n, s in (("rising", -1), ("falling", 1))]))
    own = own.select("*", sides.alias("s")).select("key", "peak", "high", "at", "counts", "s.side", "s.step")
    first = F.when(F.col("step") > 0, F.array_min(_bins(lambda k, v: (k > F.col("peak")) & (v <= level)))).otherwise(F.array_max(_bins(lambda k, v: (k < F.col("peak")) & (v <= level))))
    own = own.withColumn("hit", first)
    between = F.size(_bins(lambda k, v: (k > F.least("peak", "hit")) & (k < F.greatest("peak", "hit"))))
    whole = between == F.abs(F.col("hit") - F.col("peak")) - 1
    low, high = F.col("at")[F.col("hit")], F.col("at")[F.col("hit") - F.col("step")]
    depth = F.col("hit") - F.col("step") * (level - low) / F.nullif(high - low, F.lit(0.0))
    support = F.least(*[F.col("counts")[b] for b in (F.col("peak"), F.col("hit"), F.col("hit") - F.col("step"))])
    return own.select("key", "side", F.when(whole, depth).alias("depth"), F.when(whole, support).otherwise(0).alias("support"))


def normalised(profile: DataFrame) -> DataFrame:
    """(key, bin, by_peak, by_sum): values by the highest and by the sum of their profile; a profile without either is left out."""
    ends = profile.groupBy("key").agg(F.max("v").alias("high"), F.sum("v").alias("total")).where((F.col("high") > 0) & (F.col("total") > 0))
    return profile.join(ends, "key").select("key", "bin", (F.col("v") / F.col("high")).alias("by_peak"), (F.col("v") / F.col("total")).alias("by_sum"))
