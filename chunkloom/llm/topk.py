"""Exact top-k search by inner product: a Voronoi kNN join.

Equal vectors form one class, of which the k + 1 smallest ids are kept: no other row of a class can be among the
k best of any query, as ties go to smaller ids. Classes are then grouped by their nearest pivot (cells), and a
summary of each cell holds its size and radius. A query needs a cell only if

    query . pivot + |query| * radius >= its (k + 1)-th best score in a sample of classes,

which no row of another cell can reach. Cells are split into blocks of about BLOCK classes, and queries into
groups of about QUERIES, by their own nearest pivot. A block goes to the query groups that need it, each pair of
group and block is solved on its own, where only scores that reach the query's sample score are kept, and the best of
all pairs are merged per query. How much a bound can leave out depends on the vectors: where they lie in clusters,
whole cells go; where they fill all directions alike, as random ones do, each query needs nearly every cell.

Vectors that are null, or hold null or non-finite components, take no part, nor do null ids. Vectors of different
lengths never meet; lengths that the sample lacks share SPARE cells around 0. Repeated rows of an id with equal
vectors count once. Fewer than k candidates: all are returned. Columns besides vec_id and embedding are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm.common import bounded_batches, materialize

BLOCK = 1024
QUERIES = 4096
#: Bytes of the sample of classes that is sent to the driver and to tasks; pivots are its first rows.
SAMPLE_BYTES = 4 << 20
PIVOTS = 1024
SPARE = 1024


def integers(embedding: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component as double."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def usable(embedding: Column) -> Column:
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def by_length(values: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    flat, offsets = values.flatten().to_numpy(zero_copy_only=False), values.offsets.to_numpy()
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    out = {}
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        out[int(n)] = rows, flat[offsets[rows][:, None] + np.arange(n)[None, :]]
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in floating point where that is exact, else in integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        rows = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return rows[np.lexsort((ids[rows], -scores[rows]))][:k]
    return np.lexsort((ids, -scores))


class Cells:
    """Pivots for each vector length; a length without pivots has one cell around 0."""

    def __init__(self, sample: dict[int, np.ndarray], pivots: int) -> None:
        self.sample = sample
        self.pivots = {n: np.unique(v[:pivots], axis=0).astype(float) for n, v in sample.items()}
        self.first = {}
        at = 0
        for n in sorted(self.pivots):
            self.first[n] = at
            at += len(self.pivots[n])

    def of(self, n: int) -> tuple[np.ndarray, int]:
        return (self.pivots[n], self.first[n]) if n in self.pivots else (np.zeros((1, n)), -1 - n % SPARE)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pivots, first = self.of(vectors.shape[1])
        v = vectors.astype(float)
        square = np.maximum(0, (v * v).sum(1)[:, None] - 2 * v @ pivots.T + (pivots * pivots).sum(1)[None, :])
        cell = square.argmin(1)
        return cell + first, np.sqrt(square[np.arange(len(v)), cell])


def search(vectors: DataFrame, queries: Column, k: int = 20, block: int = BLOCK, group: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) over vectors (vec_id, v: array of integers); queries: a predicate on vec_id."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    vectors = vectors.where(F.col("vec_id").isNotNull()).select("vec_id", "v", F.xxhash64("v").alias("h"))
    kept = vectors.withColumn("place", F.dense_rank().over(W.partitionBy("h", "v").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    classes = materialize(
        kept.groupBy("h", "v").agg(F.array_sort(F.collect_set("vec_id")).alias("members")).select("h", "v", "members", F.col("members")[0].alias("cls")), "classes"
    )
    asked = materialize(
        vectors.where(queries).select(F.col("vec_id").alias("query_id"), "h", "v").join(classes.select("h", "v", "cls"), ["h", "v"]).select("query_id", "cls").distinct(), "asked"
    )
    n = classes.count()
    width = classes.agg(F.max(F.size("v"))).first()[0] or 1
    taken = max(k + 1, min(SAMPLE_BYTES // (8 * max(1, width)), n))
    rows = classes.select("cls", "v").orderBy(F.xxhash64("cls"), "cls").limit(taken).collect()
    sample: dict[int, list] = {}
    for r in rows:
        sample.setdefault(len(r["v"]), []).append(r["v"])
    cells = Cells({m: np.array(v, np.int64).reshape(len(v), m) for m, v in sample.items()}, max(1, min(PIVOTS, max(math.isqrt(n), -(-n // block)))))
    shared = spark.sparkContext.broadcast(cells)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for at, v in by_length(batch["v"]).values():
                cell[at], far[at] = shared.value.nearest(v)
            yield pa.RecordBatch.from_arrays([batch["cls"], batch["v"], pa.array(cell), pa.array(far)], ["cls", "v", "cell", "far"])

    placed = materialize(classes.select("cls", "v").mapInArrow(assign, "cls long, v array<long>, cell long, far double"), "placed")
    solved = asked.select("cls").distinct().join(placed, "cls")
    # One row a cell: at most PIVOTS for each vector length in the sample, and SPARE.
    size = {r["cell"]: (r["n"], r["far"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
    homes = {r["cell"]: r["n"] for r in solved.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = {c: max(1, math.ceil(m / block)) for c, (m, _) in size.items()}
    groups, at, filled = {}, 0, 0
    for c in sorted(homes):
        if filled and filled + homes[c] > group:
            at, filled = at + 1, 0
        salts = max(1, math.ceil(homes[c] / group))
        groups[c] = (at, salts)
        at, filled = (at, filled + homes[c]) if salts == 1 else (at + salts, 0)
    layout = spark.sparkContext.broadcast((size, blocks, groups))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, blocks, groups = layout.value
        known = shared.value
        for batch in batches:
            ids, home = batch["cls"].to_numpy(), batch["cell"].to_numpy()
            for length, (at, v) in by_length(batch["v"]).items():
                pivots, first = known.of(length)
                norm = np.sqrt((v.astype(float) ** 2).sum(1))
                here = [c for c in range(first, first + len(pivots)) if c in size]
                bound = v.astype(float) @ pivots.T[:, [c - first for c in here]] + norm[:, None] * np.array([size[c][1] for c in here])
                least = np.full(len(v), np.iinfo(np.int64).min)
                near = known.sample.get(length)
                if near is not None and len(near) > k:
                    least = np.partition(products(v, near), len(near) - k - 1, axis=1)[:, len(near) - k - 1]
                need = bound * (1 + 1e-9 * np.sign(bound)) + 1e-3 >= least[:, None]
                out = [(i, c, b) for i, j in zip(*np.nonzero(need)) for c in (here[j],) for b in range(blocks[c])]
                if not out:
                    continue
                rows, cell, part = (np.array(x, np.int64) for x in zip(*out))
                team = np.array([groups[home[a]][0] + ids[a] % groups[home[a]][1] for a in at], np.int64)
                for lo in range(0, len(rows), 4096):
                    r = rows[lo : lo + 4096]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(r) + 1) * length, pa.int32()), pa.array(v[r].ravel().astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at][r]), lists, pa.array(least[r]), pa.array(team[r]), pa.array(cell[lo : lo + 4096]), pa.array(part[lo : lo + 4096])],
                        ["cls", "v", "least", "team", "cell", "part"],
                    )

    routed = solved.select("cls", "v", "cell").mapInArrow(route, "cls long, v array<long>, least long, team long, cell long, part long")
    routed = materialize(routed, "routed")
    in_block = F.broadcast(spark.createDataFrame(list(blocks.items()), "cell long, blocks long"))  # a row a cell
    data = placed.join(in_block, "cell").withColumn("part", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    pairs = routed.select(F.col("team").alias("to_team"), F.col("cell").alias("to_cell"), F.col("part").alias("to_part")).distinct()
    sent = data.join(pairs, (F.col("cell") == F.col("to_cell")) & (F.col("part") == F.col("to_part"))).select("cls", "v", "to_team", "to_cell", "to_part")

    def solve(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = [(), (), ()]
        if asked.num_rows and held.num_rows:
            q, d = asked["v"].combine_chunks(), held["v"].combine_chunks()
            left, right = by_length(q), by_length(d)
            q_ids, d_ids, least = asked["cls"].to_numpy(), held["cls"].to_numpy(), asked["least"].to_numpy()
            found: list[list[np.ndarray]] = [[], [], []]
            for length in left.keys() & right.keys():
                (qi, qv), (di, dv) = left[length], right[length]
                for lo in range(0, len(qi), 512):
                    scores = products(qv[lo : lo + 512], dv)
                    for row, i in zip(scores, qi[lo : lo + 512]):
                        near = np.flatnonzero(row >= least[i])
                        top = near[best(row[near], d_ids[di][near], k + 1)]
                        found[0].append(np.full(len(top), q_ids[i]))
                        found[1].append(d_ids[di][top])
                        found[2].append(row[top])
            out = [np.concatenate(x) if x else () for x in found]
        return pa.table([pa.array(np.asarray(x, np.int64)) for x in out], names=["query", "cls", "score"])

    partial = routed.groupBy("team", "cell", "part").cogroup(sent.groupBy("to_team", "to_cell", "to_part")).applyInArrow(solve, "query long, cls long, score long")
    top = partial.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "cls"))).where(F.col("place") <= k + 1)
    rows = top.join(classes.select("cls", "members"), "cls").select("query", "score", F.explode("members").alias("vec_id"))
    rows = rows.withColumn("place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1)
    full = asked.withColumnRenamed("cls", "query").join(rows, "query").where(F.col("vec_id") != F.col("query_id"))
    return (
        full.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_scores(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """The k best rows of embeddings (vec_id, embedding) for each row whose id is divisible by `every`."""
    vectors = embeddings.where(usable(F.col("embedding"))).select("vec_id", integers(F.col("embedding")).alias("v"))
    return search(vectors, F.col("vec_id") % every == 0, k)


ORACLE = """
with ints as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, d.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i]))::bigint as score
  from ints q join ints d on q.vec_id % 20 = 0 and d.vec_id <> q.vec_id and len(q.v) = len(d.v)),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20"""
