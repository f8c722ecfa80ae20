"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates.

A document becomes counts of hashed features: each word, each pair of neighbouring words, and each pair of
word shapes (lower, capitalised, upper case, digits; punctuation runs stand for themselves). A pair of equal
words counts as one marker, so that repetition of any word shares a weight. Counts are divided by the number
of features, and the score is the logistic function of a sparse dot product.

Null and empty texts have no features and get the score of the intercept. Every text is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm import kernels as K
from chunkloom.llm.common import bounded_batches, materialize
from chunkloom.llm.labelled import id_remainder, training_sample

#: Labelled rows that training takes at most.
TRAINING_ROWS = 6000
#: Bytes of feature vectors that training takes at most: rows in the order of training, as many as fit, one at least.
TRAINING_BYTES = 64 << 20
BITS = 18
#: Words that are hashed at once.
BLOCK = 1 << 16
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_SHAPE = np.uint64(0xA5A5A5A5DEADBEEF)
_REPEAT = np.uint64(0x1234567890ABCDEF)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float


def features(data: np.ndarray, bounds: np.ndarray, bits: int = BITS, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers of all rows and the row of each, for `block` words after another, so that a long text needs no more memory."""
    starts, ends = K.spans(data, bounds, K.TOKENS)
    for low in range(0, len(starts), block):
        # The word before the block comes along for the pair that it begins.
        own = slice(max(0, low - 1), low + block)
        a, b = starts[own], ends[own]
        words = K.span_hashes(data, a, b)
        row = np.searchsorted(bounds, a, "right") - 1
        part, edges = data[a[0] : b[-1]], np.column_stack([a - a[0], b - a[0]]).ravel()
        kinds = ((part >= 65) & (part <= 90), (part >= 48) & (part <= 57), K.TOKENS[part] == 2)
        upper, digits, marks = (np.add.reduceat(np.append(k, False), edges, dtype=np.int32)[::2] for k in kinds)
        length = b - a
        shape = np.where(digits == length, 3, np.where(upper == 0, 0, np.where((upper == 1) & (length > 1), 1, 2))).astype(np.uint64)
        shape = np.where(marks > 0, words, K.mix(shape + _SHAPE))
        near = row[1:] == row[:-1]
        first, second = words[:-1][near], words[1:][near]
        pairs = np.where(first == second, _REPEAT, first * _PAIR + second)
        shapes = (shape[:-1] * _PAIR + shape[1:])[near] ^ _SHAPE
        new = slice(int(low > 0), None)
        found = K.mix(np.concatenate([words[new], pairs, shapes])) >> np.uint64(64 - bits)
        yield found.astype(np.int64), np.concatenate([row[new], row[1:][near], row[1:][near]])


def counted(data: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, int]:
    """The features of one text, their counts, and the number of all."""
    parts = [f for f, _ in features(data, np.array([0, len(data)]), bits)] if len(data) < K.CHUNK_BYTES else None
    if parts is not None:
        index, count = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_counts=True)
        return index, count, int(count.sum())
    total = np.zeros(1 << bits, np.int64)
    for f, _ in features(data, np.array([0, len(data)]), bits):
        total += np.bincount(f, minlength=1 << bits)
    index = np.flatnonzero(total)
    return index, total[index], int(total.sum())


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> Model:
    """Per-coordinate follow-the-regularised-leader updates over (indices, values, label), in the given order."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i: np.ndarray) -> np.ndarray:
        s = np.sign(z[i])
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - s * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for index, value, label in examples:
            index, value = np.append(index, 1 << bits), np.append(value, 1.0)
            w = weights(index)
            g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / alpha
            z[index] += g - sigma * w
            n[index] += g * g
    w = weights(np.arange((1 << bits) + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


#: Counts are scaled so that a feature in a tenth of all places has value 1.
SCALE = 10.0


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, held_out: int = 1, rows: int = TRAINING_ROWS, most: int = TRAINING_BYTES) -> Model:
    """Train on at most `rows` labelled ids outside the held-out remainder, in the order of their hashes. No labels: a model of zeros.

    Rows that repeat an id are examples of their own, at most twice `rows` in all. A task trains on at most `most` bytes
    of vectors; only the weights reach the driver.
    """
    bounded_batches(documents.sparkSession)
    sample = F.broadcast(training_sample(labels, label, modulus, held_out, rows))  # at most `rows` rows of two numbers

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.column(batch["text"])
            index, value = [], []
            for i in range(batch.num_rows):
                u, c, n = counted(data[offsets[i] : offsets[i + 1]])
                index.append(u.astype(np.int32).tobytes())
                value.append((c * (SCALE / max(1, n))).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_label"], pa.array(index, pa.binary()), pa.array(value, pa.binary())], ["id", "label", "index", "value"])

    texts = documents.select(F.col("doc_id").alias("_id"), "text")
    chosen = texts.join(sample.select(F.col("doc_id").alias("_id"), F.col("label").alias("_label")), "_id")
    vectors = materialize(chosen.mapInArrow(count, "id long, label int, index binary, value binary").withColumn("place", F.xxhash64("id")), "examples")
    order = ["place", "id", "label", "digest"]
    keyed = vectors.withColumn("digest", F.xxhash64("index", "value"))
    sizes = keyed.select(*order, F.octet_length("index").alias("size")).orderBy(*order).limit(2 * rows).collect()
    total, last = 0, None
    for r in sizes:
        total += 2 * r["size"] + 64
        if last is not None and total > most:
            break
        last = r
    if last is None:
        return train([])
    ahead = F.struct(*order) <= F.struct(*[F.lit(last[c]).cast(keyed.schema[c].dataType) for c in order])

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [
            (np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y)
            for batch in batches for i, v, y in zip(batch["index"].to_pylist(), batch["value"].to_pylist(), batch["label"].to_pylist())
        ]
        model = train(seen)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.intercept])], ["weights", "intercept"])

    # One task trains, on the bounded rows in their order.
    found = keyed.where(ahead).repartition(1).sortWithinPartitions(*order).limit(2 * rows).select("label", "index", "value").mapInArrow(trained, "weights binary, intercept double").first()
    return Model(np.frombuffer(found["weights"], np.float32), found["intercept"])


def _scores(values: pa.Array, weights: np.ndarray, intercept: float) -> np.ndarray:
    data, offsets = K.column(values)
    logits = np.full(len(values), intercept)
    for i, j in K.slices(offsets):
        total, n = np.zeros(j - i), np.zeros(j - i)
        for f, row in features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]):
            total += np.bincount(row, weights[f], j - i)
            n += np.bincount(row, minlength=j - i)
        logits[i:j] += total * SCALE / np.maximum(1, n)
    return 1 / (1 + np.exp(-np.clip(logits, -35, 35)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of documents; one narrow pass."""
    bounded_batches(documents.sparkSession)
    weights, intercept = documents.sparkSession.sparkContext.broadcast(model.weights), model.intercept

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(_scores(batch["text"], weights.value, intercept))], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(apply, "doc_id long, score double")


def kept(documents: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of documents, with all their columns, that score `least` or more; one narrow pass."""
    bounded_batches(documents.sparkSession)
    weights, intercept = documents.sparkSession.sparkContext.broadcast(model.weights), model.intercept

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch["text"], weights.value, intercept) >= least))

    return documents.mapInArrow(apply, documents.schema)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of documents."""
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
