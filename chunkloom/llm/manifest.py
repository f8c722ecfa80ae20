"""Merkle manifest of a dataset: a digest of every document, a tree over them, and a proof for each.

Digests are lowercase hex SHA-256, and a node's input is the text of its children's digests. A leaf is a document's
record; leaves of a language ascend by doc_id, and every FAN consecutive nodes (fewer at the end) become their digest
until one remains, the language's subroot. Subroots by language make the root in the same way.

Nested-struct rollup: leaves get their rank, and ranks are cut into blocks of FAN**LEVELS. A block's rows meet in one
shuffle; within it the digits of the rank are grouped away one after another, lowest first, each group becoming a
struct that nests its children. So a row holds one block, whatever the size of its language, and its digest is a node
of the next tier, where blocks are nested likewise until a language has one. Proofs come back down without joins:
what lies above a block is grouped together with it, and its nested children are exploded level by level, each with
the digests to its left and right.

Ranks: rows are dealt by ranges of (language, doc_id, leaf), sorted and written; a row's rank is its place in its
part, shifted by the parts before.

Null languages are one group, the first one; null doc_ids come first, and rows that share a doc_id follow by their
leaf, so the result depends on the rows alone. Null values are written `-`, unlike any text. Equal rows get leaves of
their own. An empty table gives an empty manifest. Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm.common import CRC32_SQL, materialize

FAN = 8
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def record(values: list[Column]) -> Column:
    """The digest of one document's values: each its number of UTF-8 bytes, a colon and itself, or `-` for null."""
    texts = [v.cast("string") for v in values]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def small_letters(text: Column) -> Column:
    """text with A-Z in lower case; a text of single bytes takes the faster way to the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))


def leaves(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered): tampered is the leaf of the changed text where a document is chosen to be changed, else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    altered = record([small_letters(F.col(c)) if c == "text" else F.col(c) for c in FIELDS])
    return documents.select("doc_id", "lang", record([F.col(c) for c in FIELDS]).alias("leaf"), F.when(chosen, altered).alias("tampered"))


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, int]:
    """rows, as written, with `rank` from 0 within the group, nulls of it being one, and `n`, the group's rows; and the largest n."""
    tied = materialize(rows.withColumn("_tie", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [group, *order, "_tie"]
    dealt = materialize(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie").withColumn("_at", F.monotonically_increasing_id()), f"{name}-sorted")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))
    # One row for each part, and one more for each further group within it.
    parts = dealt.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    own = W.partitionBy(group)
    before = F.sum("_n").over(own.orderBy("_part")) - F.col("_n")
    parts = parts.select(F.col(group).alias("_group"), F.col("_part").alias("_p"), (before - F.col("_first")).alias("_shift"), F.sum("_n").over(own).alias("n"))
    found = dealt.join(parts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_p")))
    largest = dealt.groupBy(group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return found.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_group", "_p", "_part", "_at", "_shift"), largest or 0


def nested(nodes: DataFrame, fan: int, levels: int) -> DataFrame:
    """(grp, block, n, node, digest) from nodes (grp, rank, n, node): node nests fan**levels of them by digit, lowest innermost. n is the number of nodes of the group."""
    digits = [f"d{k}" for k in range(levels)]
    placed = [F.pmod(F.floor(F.col("rank") / fan**k), F.lit(fan)).cast("int").alias(d) for k, d in enumerate(digits)]
    rows = nodes.select("grp", F.floor(F.col("rank") / fan**levels).alias("block"), "n", *placed, "node", F.col("node.digest").alias("digest"))
    rows = rows.repartition("grp", "block")
    for k, digit in enumerate(digits):
        held = F.array_sort(F.collect_list(F.struct(digit, "digest", "node")))
        rows = rows.groupBy("grp", "block", "n", *digits[k + 1 :]).agg(held.alias("held"))
        own = F.transform("held", lambda x: x["digest"])
        # A group that is down to one node stays as it is.
        digest = F.when(F.col("n") > fan**k, sha(F.array_join(own, ""))).otherwise(own[0])
        rows = rows.withColumns({"digest": digest, "node": F.struct(own.alias("digests"), F.transform("held", lambda x: x["node"]).alias("children"))}).drop("held")
    return rows


def unnested(blocks: DataFrame, fan: int, levels: int) -> DataFrame:
    """(grp, node, path, crown) from blocks (grp, n, node, path, crown): each inner node with its path, lowest level first."""
    for k in reversed(range(levels)):
        blocks = blocks.selectExpr("grp", "n", "path", "crown", "node.digests as digests", "posexplode(node.children) as (i, node)")
        step = f"array(struct(array_join(slice(digests, 1, i), '') as left, array_join(slice(digests, i + 2, {fan}), '') as right))"
        blocks = blocks.selectExpr("grp", "n", f"if(n > {fan**k}, concat({step}, path), path) as path", "crown", "node")
    return blocks.drop("n")


def paths(nodes: DataFrame, largest: int, top: Callable[[DataFrame], DataFrame], fan: int, levels: int, name: str) -> DataFrame:
    """(grp, node, path, crown) for nodes (grp, rank, n, node), node a struct with a digest; largest bounds n.

    top gives (grp, path, crown) for the roots (grp, digest): what lies above a root, and a struct that all below it get.
    """
    blocks = materialize(nested(nodes, fan, levels), name)
    span = fan**levels
    if largest > span:
        up = blocks.selectExpr("grp", "block as rank", f"ceil(n / {span}) as n", "struct(digest, block) as node")
        above = paths(up, -(-largest // span), top, fan, levels, name).selectExpr("grp", "node.block as block", "path", "crown")
    else:
        above = top(blocks.select("grp", "digest")).selectExpr("grp", "0L as block", "path", "crown")
    both = blocks.select("grp", "block", "n", "node").unionByName(above, allowMissingColumns=True)
    met = both.groupBy("grp", "block").agg(*[F.first(c, True).alias(c) for c in ("n", "node", "path", "crown")])
    return unnested(met, fan, levels)


def manifest(documents: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(doc_id, lang, leaf, tampered, subroot, root, path) for each document.

    path is an array of (left, right), lowest level first: the digests of the siblings on either side, each side as
    one text. Folding a leaf with it gives the root.
    """

    def crowned(roots: DataFrame) -> DataFrame:
        order, largest = ranked(roots.selectExpr("grp as lang", "digest", "0 as grp"), "grp", ["lang"], "subroots")
        nodes = order.selectExpr("grp", "rank", "n", "struct(digest, lang) as node")
        found = paths(nodes, largest, rooted, fan, levels, "subroots")
        return found.selectExpr("node.lang as grp", "path", "struct(node.digest as subroot, crown.root as root) as crown")

    def rooted(roots: DataFrame) -> DataFrame:
        return roots.selectExpr("grp", "cast(array() as array<struct<left:string,right:string>>) as path", "struct(digest as root) as crown")

    rows, largest = ranked(leaves(documents), "lang", ["doc_id", "leaf"], "leaves")
    nodes = rows.selectExpr("lang as grp", "rank", "n", "struct(leaf as digest, doc_id, tampered) as node")
    found = paths(nodes, largest, crowned, fan, levels, "leaves")
    return found.selectExpr("node.doc_id as doc_id", "grp as lang", "node.digest as leaf", "node.tampered as tampered", "crown.subroot as subroot", "crown.root as root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with its path."""
    return F.aggregate(path, leaf, lambda node, step: sha(F.concat(step["left"], node, step["right"])))


def report(documents: DataFrame, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): proofs of documents, of which some were tampered with after the manifest was made."""
    rows = manifest(documents, fan, levels)
    proof = sha(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""))
    rows = rows.withColumns({"proof_sha256": proof, "folded_root": folded(F.coalesce("tampered", "leaf"), F.col("path"))})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _record_sql(text: str) -> str:
    shown = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({c})::varchar || ':' || {c}, '-')" for c in shown) + ")"


# One tree over all nodes: the languages' trees (t = 0), then the tree of their subroots (t = 1).
ORACLE = f"""
with recursive docs as (
  select doc_id, lang, leaf, case when {CRC32_SQL.format(text="doc_id::varchar")} % 3 = 0 then altered else leaf end as tampered,
    row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by lang) as n
  from (select doc_id, lang, {_record_sql("text")} as leaf, {_record_sql(f"translate(text, '{CAPITALS}', '{SMALL}')")} as altered from documents)
), low as (
  select 0 as k, lang, i, n, leaf as h from docs
  union all
  select k + 1, lang, i // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' order by i)) from low where n > 1 group by k, lang, i // {FAN}, n
), subroots as (
  select lang, h, row_number() over (order by lang nulls first) - 1 as i, count(*) over () as n from low where n = 1
), high as (
  select 0 as k, i, n, h from subroots
  union all
  select k + 1, i // {FAN}, (n + {FAN - 1}) // {FAN}, sha256(string_agg(h, '' order by i)) from high where n > 1 group by k, i // {FAN}, n
), sides as (
  select k, lang, i, coalesce(string_agg(h, '' order by i) over (before rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '' order by i) over (before rows between 1 following and unbounded following), '') as r
  from low where n > 1 window before as (partition by k, lang, i // {FAN} order by i)
), high_sides as (
  select k, i, coalesce(string_agg(h, '' order by i) over (before rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '' order by i) over (before rows between 1 following and unbounded following), '') as r
  from high where n > 1 window before as (partition by k, i // {FAN} order by i)
), climb as (
  select doc_id, lang, leaf, i as spot, 0 as k, i, '' as proof, tampered as h from docs
  union all
  select doc_id, c.lang, leaf, spot, c.k + 1, c.i // {FAN}, proof || l || r, sha256(l || h || r)
  from climb c join sides s on c.k = s.k and c.lang is not distinct from s.lang and c.i = s.i
), middle as (
  select c.*, s.h as subroot, s.i as place from (select *, row_number() over (partition by lang, spot order by k desc) as last from climb) c join subroots s on c.lang is not distinct from s.lang where last = 1
), crown as (
  select doc_id, lang, leaf, spot, subroot, 0 as k, place as i, proof, h from middle
  union all
  select doc_id, lang, leaf, spot, subroot, c.k + 1, c.i // {FAN}, proof || l || r, sha256(l || h || r) from crown c join high_sides s on c.k = s.k and c.i = s.i
), ends as (
  select *, row_number() over (partition by lang, spot order by k desc) as last from crown
)
select doc_id, leaf, subroot, r.h as root, sha256(proof) as proof_sha256, ends.h as folded_root, ends.h = r.h as verified
from ends, (select h from high where n = 1) r where last = 1
"""
