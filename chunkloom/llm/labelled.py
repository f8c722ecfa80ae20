"""Bounded training samples of labelled documents, and the held-out split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def training_sample(labels: DataFrame, label: str, modulus: int, held_out: int, rows: int) -> DataFrame:
    """At most `rows` labelled ids outside the held-out remainder, those with the least hash: (doc_id, label).

    Null ids and labels take no part; of repeated rows of an id the largest label holds.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(id_remainder("doc_id", modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
