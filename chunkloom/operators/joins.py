"""Joins in which one key may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than one in this many rows, so there are fewer hot keys than this.
SHARES = 1000
#: Tables of more rows are not broadcast, however small their files are.
MANY = 100_000
#: Bits of a table of keys.
BITS = 1 << 26


def shuffled(rows: DataFrame, total: int) -> DataFrame:
    """rows, to be joined by a shuffle where they are more than MANY; total: their number, or one not below it.

    Spark compares the bytes of files with its limit for broadcasts, and a table in a driver's memory takes many times
    what its compressed columns do.
    """
    return rows.hint("merge") if total > MANY else rows


def hot_left_join(rows: DataFrame, keyed: DataFrame, key: str, by: str, total: int) -> DataFrame:
    """rows left join keyed on key, where one key may hold many of the rows, or be null in many.

    keyed has one row for each key, with the key's number `n` of rows; n goes. total: the number of rows. Hot keys
    are broadcast: fewer than SHARES rows, whatever the tables' sizes. Their rows, and those without a key, find
    their place in the shuffle for the other keys by a hash of the column `by`, and match nothing there.
    """
    values = [c for c in keyed.columns if c not in (key, "n")]
    hot = keyed.where(F.col("n") * SHARES > total).select(key, F.lit(True).alias("_hot"), *[F.col(c).alias(f"_{c}") for c in values])
    marked = rows.join(F.broadcast(hot), key, "left")
    spread = F.when(F.col("_hot") | F.col(key).isNull(), 1 + F.pmod(F.xxhash64(by), F.lit(1 << 20))).otherwise(F.lit(0).cast("long"))
    # Always 0, but no constant: the optimizer would fold one into a filter, and deal the rows by the key alone.
    zero = F.least(F.col("n"), F.lit(0)).cast("long")
    found = marked.withColumn("_spread", spread).join(shuffled(keyed.withColumn("_spread", zero).drop("n"), total), [key, "_spread"], "left")
    return found.select(*rows.columns, *[F.when(F.col("_hot"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in values])


def among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """All rows that hold one of keys (a column of whole numbers) in any of their columns, whole numbers too, and few others, if keys are far fewer than BITS.

    Keys become a table of BITS bits, whatever their number, by their remainders.
    """
    place = F.pmod(F.col(keys.columns[0]).cast("long"), F.lit(BITS)) + 1
    bits = np.zeros(BITS // 8, np.uint8)
    for r in keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).where("bucket > 0").collect():
        own = np.frombuffer(bytes(r["bits"]), np.uint8)
        bits[(r["bucket"] - 1) * len(own) : r["bucket"] * len(own)] = own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.zeros(batch.num_rows, bool)
            for column in batch.columns:
                at = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) & (BITS - 1)
                held |= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1) & column.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(held))

    return rows.mapInArrow(run, rows.schema)
