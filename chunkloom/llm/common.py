"""Reading tables, writing intermediate tables, and bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkloom.functions.scratch import cut
from chunkloom.operators.joins import SHARES, hot_left_join, shuffled

__all__ = ["MAX_BATCH_BYTES", "MAX_BATCH_ROWS", "SHARES", "bounded_batches", "hot_left_join", "materialize", "shuffled", "table"]

MAX_BATCH_ROWS = 1000
MAX_BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, as one text can be long; smaller settings of the session stay.

    The setting holds for the session from then on, as the tables made here are read later.
    """
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", MAX_BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", MAX_BATCH_BYTES),
    ):
        now = str(spark.conf.get(key, str(most))).lower()
        digits = now.rstrip("b")
        if not digits.isdigit() or int(digits) > most or int(digits) <= 0:
            spark.conf.set(key, str(most))


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: cuts lineage and survives lost executors."""
    return cut(df, name, **options)


#: DuckDB SQL: unsigned crc32 of a text of ASCII characters, one step for each bit.
CRC32_SQL = (
    "xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split({text}, ''), "
    "lambda ch: [unicode(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]))), "
    "lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295)"
)
