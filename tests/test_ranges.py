"""Running sums and quantiles of keys with any share of the rows and any spread of values."""

import numpy as np
from pyspark.sql import functions as F

from chunkloom.operators import ranges


def test_parts_are_bounded_at_a_heavy_tail(spark):
    rows = spark.range(20_000).select(F.lit("k").alias("key"), F.when(F.col("id") == 0, 10**12).otherwise(F.col("id")).alias("v"))
    counts = [r["count"] for r in ranges.with_parts(rows, "key", "v", 8).groupBy("part").count().collect()]
    assert len(counts) == 8 and max(counts) < 5_000


def test_running_sums_over_parts(spark):
    rows = [("a", v * v * v, v) for v in range(500)] + [("b", -5, 1), ("b", 10**15, 2), (None, 1, 1)]
    got = ranges.running(spark.createDataFrame(rows, "key string, v long, amount long"), "key", "v", "amount", 6).collect()
    want, totals = {}, {"a": sum(range(500)), "b": 3}
    for key in "ab":
        for k, v in zip(np.cumsum([a for c, _, a in rows if c == key]), [v for c, v, _ in rows if c == key]):
            want[key, v] = (int(k), totals[key])
    assert {(r["key"], r["v"]): (r["through"], r["total"]) for r in got} == want


def test_quantiles_equal_interpolated_ones(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 50, 300), [10**9]])
    rows = [("a", int(v)) for v in values] + [("a", None), ("b", 7)]
    got = {r["key"]: r for r in ranges.quantiles(spark.createDataFrame(rows, "key string, v long"), "key", "v", (0.0, 0.37, 0.5, 0.999, 1.0)).collect()}
    assert np.allclose([got["a"][f"q{i}"] for i in range(5)], np.quantile(values, [0.0, 0.37, 0.5, 0.999, 1.0]))
    assert got["a"]["n"] == 301 and got["b"]["q2"] == 7.0
