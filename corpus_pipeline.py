"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

quality: documents that the classifier rejects go. near_duplicates: one document of each component stays, the one
with the smallest doc_id; a null doc_id comes last, and rows that share a doc_id are documents of their own.
decontamination: documents with a benchmark window go. secrets: spans found are replaced by a mark, and n_chars
follows. packing: what is kept becomes packed sequences.

Each row is judged by its own text, whatever its doc_id, and null texts are empty ones. Columns besides those of
documents pass through the first four stages unchanged, whatever their names. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.scratch import remove, scope
from chunkloom.llm import decontaminate, jaccard, packing, quality, secrets
from chunkloom.llm.common import materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.kept(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: A trained classifier and a tokenizer have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Once a stage is written, the tables that it was made from are removed."""
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with scope() as paths:
            docs = materialize(stage(spark, docs, sf_dir), name)
        remove(spark, [*last, *paths[:-1]])
        last = paths[-1:]
    return docs
