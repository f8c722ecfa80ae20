"""Lines of least pinball loss, exact, by a search over the slope.

For a slope the best offset is a quantile of the residuals, so the loss is a convex function of the slope with straight
pieces. Each round finds, for every key at once, the residuals' quantile by running counts over ranges of them, and
the loss and its slope there by sums; the next slope is where the lines from both sides meet. That is a corner of the
loss after finitely many rounds. Points are only counted and summed, and a key's points may be any share of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.operators.ranges import running

#: Residuals are compared after rounding to so many decimals.
DIGITS = 9
ROUNDS = 200


def _losses(points: DataFrame, slopes: DataFrame, share: float) -> DataFrame:
    """(key, a, b, loss, s): for each key's slopes a, the least best offset b, the loss, and a subgradient s of it."""
    residual = F.round(F.col("y") - F.col("a") * F.col("x"), DIGITS)
    steps = points.join(slopes, "key").groupBy(F.struct("key", "a").alias("at"), residual.alias("r")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("x")).alias("nx"))
    run = running(steps, "at", "r", "n")
    under = F.col("through") - F.col("n")
    # The first residual that the wanted share of points doesn't exceed.
    here = (F.col("through") >= share * F.col("total") - 1e-9) & (under < share * F.col("total") - 1e-9)
    offsets = run.where(here).select("at", F.col("r").alias("b"), under.alias("below"), F.col("n").alias("on"), "total", F.col("nx").alias("onx"))
    off = F.col("r") - F.col("b")
    loss = F.sum(F.col("n") * F.when(off > 0, share * off).otherwise((share - 1) * off)).alias("loss")
    pull = F.sum(F.col("nx") * F.when(off > 0, -share).when(off < 0, 1 - share).otherwise(0.0)).alias("pull")
    sums = steps.join(offsets, "at").groupBy("at", "b", "below", "on", "total", "onx").agg(loss, pull)
    # What the points on the line add, so that the offset stays the best one.
    level = (share * (F.col("total") - F.col("below") - F.col("on")) - (1 - share) * F.col("below")) / F.col("on")
    return sums.select("at.key", "at.a", "b", "loss", (F.col("pull") + level * F.col("onx")).alias("s"))


def quantile_lines(rows: DataFrame, share: float, rounds: int = ROUNDS) -> DataFrame:
    """(key, n, slope, offset, loss) of rows (key, x, y): the line with the least sum of share * r for residuals r above it and (share - 1) * r below.

    Of several such lines the one of least slope, and then of least offset. Rows with nulls take no part; a key with
    one x alone has slope 0. A search that doesn't settle is an error.
    """
    if not 0 < share < 1:
        raise ValueError("the share has to lie between 0 and 1")
    kept = rows.where("key is not null and x is not null and y is not null")
    points = cut(kept.groupBy("key", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).agg(F.count("*").alias("n")))
    spans = points.groupBy("key").agg(F.sum("n").alias("n"), (F.max("x") - F.min("x")).alias("dx"), (F.max("y") - F.min("y")).alias("dy"), F.sum(F.col("n") * F.abs("x")).alias("size"))
    spans = cut(spans)
    wide = spans.where("dx > 0")
    nothing = F.lit(None).cast("double")
    # lo: a slope where the loss falls, hi: one where it doesn't; found by steps that double, from 0.
    state = wide.select("key", F.lit(0.0).alias("a"), *[nothing.alias(f"{e}_{v}") for e in ("lo", "hi") for v in ("a", "b", "loss", "s")], (F.greatest(F.col("dy"), F.lit(1.0)) / F.col("dx")).alias("step"), (F.col("size") * 1e-10).alias("tiny"), F.lit(False).alias("done"))
    state = cut(state)
    for _ in range(rounds):
        found = _losses(points, state.where(~F.col("done")).select("key", "a"), share)
        falls = F.col("s") < -F.col("tiny")
        new = state.join(found, ["key", "a"])
        for end, mine in (("lo", falls), ("hi", ~falls)):
            new = new.withColumns({f"{end}_{v}": F.when(mine, F.col(v)).otherwise(F.col(f"{end}_{v}")) for v in ("a", "b", "loss", "s")})
        met = (F.col("hi_loss") - F.col("lo_loss") + F.col("lo_s") * F.col("lo_a") - F.greatest(F.col("hi_s"), F.lit(0.0)) * F.col("hi_a")) / (F.col("lo_s") - F.greatest(F.col("hi_s"), F.lit(0.0)))
        inside = F.least(F.greatest(met, F.col("lo_a")), F.col("hi_a"))
        after: Column = F.when(F.col("lo_a").isNull(), F.col("hi_a") - F.col("step")).when(F.col("hi_a").isNull(), F.col("lo_a") + F.col("step")).otherwise(inside)
        near = lambda end: F.abs(F.col("next") - F.col(f"{end}_a")) <= 1e-12 * F.greatest(F.lit(1.0), F.abs("next"))
        both = F.col("lo_a").isNotNull() & F.col("hi_a").isNotNull()
        new = new.withColumn("next", after).withColumn("done", both & (near("lo") | near("hi")))
        settled = state.where("done").withColumn("next", F.col("a"))
        new = new.drop("b", "loss", "s").withColumns({"a": F.col("next"), "step": F.col("step") * 2}).unionByName(settled)
        state = cut(new.drop("next"))
        if state.where(~F.col("done")).isEmpty():
            break
    else:
        raise RuntimeError("the slopes did not settle")
    end = F.when(F.col("lo_loss") < F.col("hi_loss") - F.col("tiny"), "lo").otherwise("hi")
    lines = state.select("key", *[F.when(end == "lo", F.col(f"lo_{v}")).otherwise(F.col(f"hi_{v}")).alias(v) for v in ("a", "b", "loss")])
    flat = _losses(points, spans.where("dx = 0").select("key", F.lit(0.0).alias("a")), share).drop("s")
    return spans.select("key", "n").join(lines.unionByName(flat), "key").select("key", "n", F.col("a").alias("slope"), F.col("b").alias("offset"), "loss")
