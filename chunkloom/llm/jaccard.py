"""N-gram Jaccard join by parity sketches, and the components of its links.

A document's set holds the distinct shingles of `size` words (lower-cased A-Z, split at ASCII white space); with
fewer words, the whole sequence is its one shingle. Two sets A and B link when
`of * |A & B| >= least * |A | B|`.

1. Equal sets form a class; the class id is a 64-bit digest of the set. Among n different sets about n^2 / 2^65 pairs
   share a digest by chance: 3e-6 of a pair at 10^7 sets, 3e-4 at 10^8.
2. Sizes are divided into bands; a class takes part in the band of its size and in the smaller ones from where a
   link can reach it. In a band, linked sets differ in at most d = (of - least) / (of + least) * (|A| + |B|)
   tokens. Tokens are dealt into m = d + 1 + e pieces of a parity sketch by their hashes, and a piece is the XOR of
   its tokens' hashes. A token in which two sets differ changes one piece, so the number of pieces that differ
   (their Hamming distance) is a lower bound of the symmetric difference, and linked sets agree in at least e + 1
   pieces. Of every class the e pieces with the fewest tokens, which agree by chance most often, can be left out.
3. The pigeonhole join: classes with an equal piece are candidates. No pairs are made; a sorted window links each
   class to its neighbour in the group, and the components of these links are clusters. A link between classes
   never leaves its cluster.
4. Verification: small clusters share tasks. A cluster over BLOCK classes is cut into blocks, each with the same
   about GUIDES classes of the cluster besides, so that one pass over the blocks joins most of what is linked.
   Only where that leaves several components a second pass is needed: between the blocks of the classes outside
   the largest one and all blocks of the cluster, each pair of blocks a task of its own. Inside a task, one-bit
   parity sketches of SKETCH bits (again a lower bound) pass pairs on to the exact comparison, and only links that
   join two components leave the task. Two classes of the largest component need no comparison, any others get one.
5. Components of these links, and their smallest doc_id.

Null and empty texts have an empty set and link with nothing, not even with each other. Rows with the same doc_id
and different texts are separate texts, each with the component of its own text. A null doc_id is no obstacle: texts
are found again by doc_id and a hash of the text, nulls equal nulls, and the class digest settles clashes of the
hash. component_id is null where all of a component's ids are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm import kernels as K
from chunkloom.llm.common import bounded_batches, hot_left_join, materialize, shuffled
from chunkloom.llm.components import components

SIZE = 4
LEAST, OF = 85, 100
BLOCK = 1500
SKETCH = 1024
#: Classes of a large cluster that each of its blocks holds besides its own, on average.
GUIDES = 32
#: Ratio of neighbouring bands.
GROWTH = 1.5
_TURN = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3))


@dataclass(frozen=True)
class Band:
    number: int
    least: int
    most: int
    pieces: int
    spare: int


def bands(size: int, least: int = LEAST, of: int = OF) -> list[Band]:
    """The bands in which a set of `size` tokens takes part."""
    out, low, number = [], 1, 0
    while low <= size:
        nxt = max(low + 1, int(low * GROWTH))
        most = nxt - 1
        reach = most * of // least
        if size <= reach:
            differ = (of - least) * (most + reach) // (of + least)
            spare = 1 + differ // 8 if differ else 0
            out.append(Band(number, low, reach, differ + 1 + spare, spare))
        low, number = nxt, number + 1
    return out


def token_sets(data: np.ndarray, bounds: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data = K.LOWER[data]
    starts, ends = K.spans(data, bounds, K.WORDS)
    words = K.span_hashes(data, starts, ends)
    at = K.owners(bounds, starts)
    out = []
    n = len(words)
    turns = [w for w in _TURN[:size]]
    whole = None
    if n >= size:
        whole = np.zeros(n - size + 1, np.uint64)
        for k, t in enumerate(turns):
            whole += words[k : n - size + 1 + k] * t
        whole = K.mix(whole)
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            out.append(np.unique(whole[a : b - size + 1]))
        elif b > a:
            own = words[a:b]
            out.append(K.mix((own * np.array(turns[: b - a], np.uint64)).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(tokens: np.ndarray) -> int:
    """The class id of a set; two sums of differently mixed hashes make chance collisions unlikely."""
    a = tokens.sum(dtype=np.uint64)
    b = K.mix(tokens ^ _TURN[5]).sum(dtype=np.uint64)
    with np.errstate(over="ignore"):
        return int(K.mix(np.array([a * _TURN[6] + b + np.uint64(len(tokens))], np.uint64)).view(np.int64)[0])


def piece_keys(tokens: np.ndarray, band: Band) -> np.ndarray:
    """Keys of a set's pieces in a band, without the spare ones."""
    piece = ((tokens >> np.uint64(32)) * np.uint64(band.pieces)) >> np.uint64(32)
    order = np.argsort(piece, kind="stable")
    piece = piece[order].astype(np.int64)
    parity = np.zeros(band.pieces, np.uint64)
    first = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
    parity[piece[first]] = np.bitwise_xor.reduceat(K.mix(tokens[order] ^ _TURN[7]), first)
    count = np.bincount(piece, minlength=band.pieces)
    keys = K.mix(parity + K.mix(np.arange(band.pieces, dtype=np.uint64) * _TURN[0] + np.uint64(band.number * 1_000_003) + count.astype(np.uint64) * _TURN[1]))
    if band.spare:  # in an order that depends on the key alone
        keys = keys[np.lexsort((keys, np.minimum(count, 255)))[band.spare :]]
    return keys.view(np.int64)


def sets(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, at, n_shingles, cls) for each row; at is a hash of the text, and an empty set has a null class."""
    bounded_batches(documents.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.column(batch["text"])
            own: list[tuple[int, int | None]] = []
            for i, j in K.slices(offsets):
                own += [(len(t), digest(t) if len(t) else None) for t in token_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["at"], pa.array([n for n, _ in own], pa.int64()), pa.array([c for _, c in own], pa.int64())], ["doc_id", "at", "n_shingles", "cls"])

    return documents.select("doc_id", "text", F.xxhash64("text").alias("at")).mapInArrow(apply, "doc_id long, at long, n_shingles long, cls long")


def sketches(documents: DataFrame, least: int = LEAST, of: int = OF, size: int = SIZE) -> DataFrame:
    """(key, cls): the pieces of each row's sketch in each of its bands."""
    bounded_batches(documents.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[int, list[Band]] = {}
        for batch in batches:
            data, offsets = K.column(batch["text"])
            for i, j in K.slices(offsets):
                keys, classes, seen = [], [], set()
                for t in token_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size):
                    if not len(t):
                        continue
                    own = digest(t)
                    if own in seen:
                        continue
                    seen.add(own)
                    for band in cache.setdefault(len(t), bands(len(t), least, of)):
                        if band.pieces > 1:
                            k = piece_keys(t, band)
                            keys.append(k)
                            classes.append(np.full(len(k), own, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(classes))], ["key", "cls"])

    return documents.select("text").mapInArrow(apply, "key long, cls long")


def parity_bits(tokens: np.ndarray, bits: int = SKETCH) -> np.ndarray:
    """A sketch with one bit toggled for each token."""
    out = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(out.astype(np.uint8)).view(np.uint64)


def linked(a: np.ndarray, b: np.ndarray, least: int = LEAST, of: int = OF) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return of * common >= least * (len(a) + len(b) - common)


def spanning_links(tokens: list[np.ndarray], least: int = LEAST, of: int = OF) -> list[tuple[int, int]]:
    """Links that join the components of the given sets: each set is compared until it is reached."""
    n = len(tokens)
    lengths = np.array([len(t) for t in tokens])
    bits = np.stack([parity_bits(t) for t in tokens])
    todo = np.ones(n, bool)
    out = []
    for root in range(n):
        if not todo[root]:
            continue
        todo[root] = False
        queue = [root]
        while queue:
            u = queue.pop()
            rest = np.flatnonzero(todo)
            if not len(rest):
                break
            total = lengths[rest] + lengths[u]
            near = (of * np.minimum(lengths[rest], lengths[u]) >= least * np.maximum(lengths[rest], lengths[u]))
            rest, total = rest[near], total[near]
            differ = np.bitwise_count(bits[rest] ^ bits[u]).sum(1)
            for v in rest[differ * (of + least) <= (of - least) * total]:
                if linked(tokens[u], tokens[v], least, of):
                    todo[v] = False
                    queue.append(int(v))
                    out.append((u, int(v)))
    return out


def links(documents: DataFrame, classes: DataFrame, least: int = LEAST, of: int = OF, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """(a, b): links between classes that keep the components of all links. classes: (cls, doc_id, at), one row of each class."""
    pairs = sketches(documents, least, of, size).distinct()
    order = W.partitionBy("key").orderBy("cls")
    near = pairs.select("cls", F.lag("cls").over(order).alias("before")).where(F.col("before").isNotNull()).select(F.col("before").alias("a"), F.col("cls").alias("b")).distinct()
    clusters = materialize(components(near), "clusters")  # (node, root)
    sizes = clusters.groupBy("root").agg(F.count("*").alias("members"), F.count("*").alias("n"))
    total = clusters.count()
    bins = max(1, -(-total // block))
    member = materialize(hot_left_join(clusters, sizes, "root", "node", total), "members")
    small, large = member.where(F.col("members") <= block), member.where(F.col("members") > block)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.column(batch["text"])
            own: list[np.ndarray] = []
            for i, j in K.slices(offsets):
                own += token_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
            right = [len(t) > 0 and digest(t) == n for t, n in zip(own, batch["node"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, k in zip(batch["node"].to_pylist(), right) if k], pa.int64()), pa.array([t.tobytes() for t, k in zip(own, right) if k], pa.binary())], ["node", "tokens"])

    def verify(table: pa.Table) -> pa.Table:
        node, root = table["node"].to_numpy(), table["root"].to_numpy()
        own = [np.frombuffer(t, np.uint64) for t in table["tokens"].to_pylist()]
        found: list[tuple[int, int]] = []
        order = np.argsort(root, kind="stable")
        edges = np.flatnonzero(np.append(True, root[order][1:] != root[order][:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(order))):
            at = order[a:b]
            found += [(node[at[i]], node[at[j]]) for i, j in spanning_links([own[x] for x in at], least, of)]
        return pa.table([pa.array([int(x) for x, _ in found], pa.int64()), pa.array([int(y) for _, y in found], pa.int64())], names=["a", "b"])

    def verified(units: DataFrame, nodes: DataFrame) -> DataFrame:
        """Links within the units (node, bin, one, two); nodes: their distinct nodes."""
        wanted = shuffled(nodes, total).join(classes.withColumnRenamed("cls", "node"), "node").select("node", F.col("doc_id").alias("_id"), F.col("at").alias("_at"))
        texts = shuffled(wanted, total).join(documents.select("doc_id", "text"), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_at") == F.xxhash64("text")))
        held = texts.select("node", "text").mapInArrow(tokens, "node long, tokens binary").dropDuplicates(["node"])
        return shuffled(units, total).join(held, "node").groupBy("bin", "one", "two").applyInArrow(verify, "a long, b long")

    blocks = F.ceil(F.col("members") / block).cast("int")
    part = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    guide = F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("members") / GUIDES)) == 0
    binned = small.select("node", "root", F.pmod(F.xxhash64("root"), F.lit(bins)).alias("bin"), F.lit(-1).alias("one"), F.lit(-1).alias("two"))
    own = F.when(guide, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(part))
    first = large.select("node", "root", F.col("root").alias("bin"), F.explode(own).alias("one")).withColumn("two", F.col("one"))
    found = materialize(verified(binned.unionByName(first), member.select("node")), "links")
    if large.isEmpty():
        return found
    apart = materialize(unjoined(large, found, block), "apart")
    return found if apart.isEmpty() else found.unionByName(verified(stray_units(apart), apart.select("node")))


def unjoined(large: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """(node, root, number, strays, whole) of the clusters that links `found` leave in several components.

    large: (node, root, members). A class in its cluster's largest component lies in a block `number` from 0 to
    whole - 1, any other in one from -1 to -strays.
    """
    total = large.count()
    joined = components(found.join(shuffled(large.select(F.col("node").alias("a")), total), "a", "left_semi"), "joined")
    named = large.join(shuffled(joined.withColumnRenamed("root", "component"), total), "node", "left").select("node", "root", F.coalesce("component", "node").alias("component"))
    counts = named.groupBy("root", "component").agg(F.count("*").alias("n"))
    most = counts.groupBy("root").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.max("n").alias("inside"), F.sum("n").alias("members"))
    split = most.where(F.col("inside") < F.col("members")).withColumn("n", F.col("members"))
    dealt = hot_left_join(named, split, "root", "node", total).where(F.col("most").isNotNull())
    strays = F.ceil((F.col("members") - F.col("inside")) / block).cast("int")
    whole = F.ceil(F.col("inside") / block).cast("int")
    stray = F.col("component") != F.col("most")
    own = F.pmod(F.xxhash64("node"), F.when(stray, strays).otherwise(whole).cast("long")).cast("int")
    return dealt.select("node", "root", F.when(stray, -1 - own).otherwise(own).alias("number"), strays.alias("strays"), whole.alias("whole"))


def stray_units(apart: DataFrame) -> DataFrame:
    """(node, root, bin, one, two): every pair of a block of strays, `one`, and a block of their cluster, `two`."""
    number = F.col("number")
    with_strays = F.transform(F.sequence(F.lit(1), F.col("strays")), lambda i: F.struct(F.least(-i, number).alias("one"), F.greatest(-i, number).alias("two")))
    with_whole = F.transform(F.sequence(F.lit(0), F.col("whole") - 1), lambda i: F.struct(number.alias("one"), i.alias("two")))
    units = F.when(number < 0, F.concat(with_strays, with_whole)).otherwise(with_strays)
    return apart.select("node", "root", F.explode(units).alias("u")).select("node", "root", F.col("root").alias("bin"), "u.one", "u.two")


def grouped(documents: DataFrame, least: int, of: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The rows of sets(), and (cls, rows, later, doc_id, at, n, root) of each class: its first row by (doc_id, nulls last, at), of which there are n."""
    own = materialize(sets(documents, size), "sets")
    each = own.where(F.col("cls").isNotNull()).groupBy("cls", "doc_id", "at").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("later"), "doc_id", "at", "n")).alias("first")
    classes = each.groupBy("cls").agg(first, F.sum("n").alias("rows")).select("cls", "rows", "first.*")
    found = materialize(links(documents, classes.select("cls", "doc_id", "at"), least, of, size), "links")
    roots = shuffled(components(found), own.count())  # (node, root), only of linked classes
    return own, materialize(classes.join(roots, classes["cls"] == roots["node"], "left").select(*classes.columns, F.coalesce("root", "cls").alias("root")), "grouped")


def join(documents: DataFrame, least: int = LEAST, of: int = OF, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of documents."""
    own, classes = grouped(documents, least, of, size)
    smallest = classes.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    by_class = hot_left_join(classes.select("cls", "rows", "root"), smallest, "root", "cls", classes.count()).select("cls", "component_id", F.col("rows").alias("n"))
    named = hot_left_join(own.drop("at"), materialize(by_class, "named"), "cls", "doc_id", own.count())
    return named.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(documents: DataFrame, least: int = LEAST, of: int = OF, size: int = SIZE) -> DataFrame:
    """One row of each component, the first by doc_id (nulls last), class and text hash, and every row whose set is empty.

    Of rows with the same doc_id and text one stays, whichever it is.
    """
    _, classes = grouped(documents, least, of, size)
    best = classes.groupBy("root").agg(F.min(F.struct("later", "doc_id", "cls", "at", "n")).alias("best"))
    best = materialize(best.select(F.col("best.doc_id").alias("_id"), F.col("best.at").alias("_at"), F.col("best.n").alias("_n")), "best")
    best = shuffled(best, best.count())
    # Documents travel as one column, so that no name of theirs meets one from here.
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("own"))
    words = F.length(F.translate(F.coalesce("own.text", F.lit("")), " \t\n\v\f\r", "")) > 0
    match = F.col("own.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("own.text") == F.col("_at"))
    full = held.where(words)
    kept = held.where(~words).unionByName(full.join(best.where("_n = 1"), match, "left_semi"))
    repeated = best.where("_n > 1")
    if not repeated.isEmpty():
        again = full.join(repeated, match, "left_semi").withColumns({"_id": F.col("own.doc_id"), "_text": F.col("own.text")})
        kept = kept.unionByName(again.dropDuplicates(["_id", "_text"]).select("own"))
    return kept.select("own.*")


ORACLE = f"""
with recursive cut as (
  select row_number() over () as k, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select k, doc_id, case when len(w) >= {SIZE} then list_sort(list_distinct(list_transform(range(1, len(w) - {SIZE - 2}), lambda i: array_to_string(w[i : i + {SIZE - 1}], ' '))))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s
  from cut),
rows as (select k, doc_id, len(s) as n, case when len(s) > 0 then sha256(array_to_string(s, chr(10))) end as c from sets),
classes as (select c, any_value(n) as n, min(k) as k from rows where c is not null group by c),
tokens as (select c, n, unnest(s) as t from classes join sets using (k)),
pairs as (
  select a.c as a, b.c as b, a.n + b.n as total, count(*) as common from tokens a join tokens b on a.t = b.t and a.c < b.c
  where {OF} * least(a.n, b.n) >= {LEAST} * greatest(a.n, b.n) group by a.c, b.c, a.n, b.n),
links as (select a, b from pairs where {OF} * common >= {LEAST} * (total - common)),
steps as (select a, b from links union all select b, a from links),
reach as (select c, c as r from classes union select steps.b, reach.r from reach join steps on steps.a = reach.c),
roots as (select c, min(r) as root from reach group by c),
least_id as (select root, min(doc_id) as component from rows join roots using (c) group by root)
select doc_id, n::bigint as n_shingles, coalesce(component, doc_id) as component_id
from rows left join roots using (c) left join least_id using (root)"""
