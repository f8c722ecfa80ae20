"""Running sums, numbers and exact quantiles of keys that may hold any share of the rows.

Rows are dealt by sampled ranges of (key, value), so that a part holds about as many rows as any other, whatever the
values and however few keys; sums of whole parts shift the sums within one. Only equal values of a key have to share
a part. Rows without a key take no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut


def with_parts(rows: DataFrame, key: str, value: str, parts: int | None = None) -> DataFrame:
    """rows with `part`, ascending with the key and its value; written, so that each row keeps its part. parts: how many at most, by default the session's shuffle partitions."""
    kept = rows.where(F.col(key).isNotNull())
    dealt = kept.repartitionByRange(parts, key, value) if parts else kept.repartitionByRange(key, value)
    return cut(dealt.withColumn("part", F.spark_partition_id()), "parts")


def running(rows: DataFrame, key: str, value: str, amount: str, parts: int | None = None) -> DataFrame:
    """rows (one for each key and value) with `through`, the sum of amount up to and with the value, and the key's `total`."""
    placed = with_parts(rows, key, value, parts)
    sums = placed.groupBy(key, "part").agg(F.sum(amount).alias("_sum"))  # at most one row a part and key
    order = W.partitionBy(key).orderBy("part")
    before = sums.select(key, "part", (F.sum("_sum").over(order) - F.col("_sum")).alias("_before"), F.sum("_sum").over(W.partitionBy(key)).alias("total"))
    here = F.sum(amount).over(W.partitionBy(key, "part").orderBy(value))
    return placed.withColumn("_here", here).join(before, [key, "part"]).withColumn("through", F.col("_before") + F.col("_here")).drop("_before", "_here", "part")


def numbered(rows: DataFrame, key: str, value: str, name: str = "number") -> DataFrame:
    """rows with `number`: 1, 2, ... in order of a value that is unique within the key."""
    counted = running(rows.withColumn("_one", F.lit(1).cast("long")), key, value, "_one")
    return counted.withColumnRenamed("through", name).drop("_one", "total")


def quantiles(samples: DataFrame, key: str, value: str, shares: tuple[float, ...]) -> DataFrame:
    """(key, n, q0, q1, ...): exact quantiles with linear interpolation; nulls take no part."""
    counts = samples.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    run = running(counts, key, value, "_n")
    place = [(F.col("total") - 1) * F.lit(q) for q in shares]

    def at(rank):
        return F.max(F.when((F.col("through") - F.col("_n") <= rank) & (rank < F.col("through")), F.col(value)))

    found = run.groupBy(key).agg(F.max("total").alias("total"), *[f for i, p in enumerate(place) for f in (at(F.floor(p)).alias(f"_lo{i}"), at(F.ceil(p)).alias(f"_hi{i}"))])
    value_of = lambda i, p: F.when(F.floor(p) == F.ceil(p), F.col(f"_lo{i}").cast("double")).otherwise((F.ceil(p) - p) * F.col(f"_lo{i}") + (p - F.floor(p)) * F.col(f"_hi{i}"))
    return found.select(key, F.col("total").alias("n"), *[value_of(i, p).alias(f"q{i}") for i, p in enumerate(place)])
