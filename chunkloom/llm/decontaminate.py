"""Benchmark decontamination: one Aho-Corasick automaton over normalised items, one scan of each text.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased. A window is `width`
consecutive words of an item; an item with fewer words, but some, is one window. Patterns and texts are
words joined by single spaces with a space at both ends, so that a match starts and ends at words; match
offsets map to word numbers, and these to code point offsets in the original text.

An automaton takes about 400 bytes of memory for a byte of item text (measured), so items are dealt to parts of at most
`max_item_bytes` bytes, an item that is longer to several that share `width` - 1 words. A part is all that the driver
collects and broadcasts at a time, and each part has an automaton and a pass over the documents. One part, the usual
case, is one narrow pass. With more, the first writes a row for each document and the others write the rows that they
hit, and these meet by row. A single window of more bytes than that is a part of its own. Each row of documents gives
one row, whatever its doc_id.

Null and empty texts have no words; rows that repeat an item_id count as one item; items without words, or with a
null item_id, never hit.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.llm.common import bounded_batches, materialize

WIDTH = 10
#: Bytes of item texts in one automaton.
MAX_ITEM_BYTES = 1 << 20
_LETTERS = bytes(c for c in range(256) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c > 127)
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32) for c in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_RANGES = "array<struct<first:long,stop:long>>"
_SPANS = "array<struct<start:long,stop:long>>"


def normalise(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def spaced(text: str | None) -> bytes:
    """The words with one space before, between and after them."""
    letters = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_FOLD), np.uint8)
    inside = letters != 32
    last = np.append(inside[:-1] & ~inside[1:], False)  # before a gap
    inside[1:] |= last[:-1]
    line = letters[inside].tobytes()
    return b" " + line + (b"" if line.endswith(b" ") else b" ") if line else b""


def windows(text: str | None, width: int = WIDTH) -> list[str]:
    words = normalise(text)
    return [f" {b' '.join(words[i : i + width]).decode('latin-1')} " for i in range(max(1, len(words) - width + 1))] if words else []


def automaton(items: list[tuple[int, str]], width: int) -> ahocorasick.Automaton | None:
    """Windows of all items; a window's value is (its length, its words, the numbers of its items)."""
    by: dict[str, set[int]] = {}
    for item, text in items:
        for w in windows(text, width):
            by.setdefault(w, set()).add(item)
    if not by:
        return None
    found = ahocorasick.Automaton()
    for w, owners in by.items():
        found.add_word(w, (len(w), w.count(" ") - 1, tuple(owners)))
    found.make_automaton()
    return found


def united(ranges: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Ranges (first, stop) that overlap or touch, joined, in order; with (start, end) of the text behind, also those."""
    out: list[tuple[int, ...]] = []
    for r in sorted(ranges):
        if out and r[0] <= out[-1][1]:
            last = out[-1]
            out[-1] = tuple(max(x, y) if k % 2 else x for k, (x, y) in enumerate(zip(last, r)))
        else:
            out.append(r)
    return out


def scan(text: str | None, found: ahocorasick.Automaton | None) -> tuple[int, list[tuple[int, int]], set[int]]:
    """The number of words, the word ranges of matches united, and the items that occur."""
    line = spaced(text)
    n = max(0, line.count(b" ") - 1)
    if not n or found is None:
        return n, [], set()
    ranges, items, gaps = [], set(), None
    for end, (length, count, owners) in found.iter(line.decode("latin-1")):
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        first = int(np.searchsorted(gaps, end - length + 1))
        ranges.append((first, first + count))
        items.update(owners)
    return n, united(ranges), items


def offsets(text: str | None, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code points of the original text from the first to past the last word of each word range."""
    if not ranges:
        return []
    at = [m.span() for m in _WORD.finditer(text or "")]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def pieces(text: str | None, width: int, most: int) -> Iterator[str]:
    """Pieces of at most `most` bytes, or one window, that together hold the windows of a text and no others."""
    words = normalise(text)
    first = 0
    while first < len(words):
        stop, size = first, 0
        while stop < len(words) and (stop - first < width or size + len(words[stop]) + 1 <= most):
            size += len(words[stop]) + 1
            stop += 1
        yield b" ".join(words[first:stop]).decode("utf-8", "surrogatepass")
        if stop == len(words):
            return
        first = stop - width + 1


def _parts(items: DataFrame, width: int, most: int) -> Iterator[list[tuple[int, str]]]:
    """Pieces of items in lists of at most `most` bytes, or one piece."""
    usable = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                own = list(pieces(text, width, most))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.int64()), pa.array(own, pa.string())], ["item_id", "text"])

    part, size = [], 0
    for item, text in usable.mapInArrow(cut, "item_id long, text string").toLocalIterator():
        n = len(text.encode("utf-8", "surrogatepass"))
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append((item, text))
        size += n
    if part:
        yield part


#: The automaton that this process built last, by the name of its part.
_built: dict[str, ahocorasick.Automaton | None] = {}


class _Part:
    """A part of the items at the tasks; its automaton is built once a process."""

    def __init__(self, spark: SparkSession, items: list[tuple[int, str]], width: int) -> None:
        self.name, self.width, self.shared = uuid.uuid4().hex, width, spark.sparkContext.broadcast(items)

    def automaton(self) -> ahocorasick.Automaton | None:
        if self.name not in _built:
            _built.clear()
            _built[self.name] = automaton(self.shared.value, self.width)
        return _built[self.name]


_PAIR = {name: pa.list_(pa.struct([(field, pa.int64()) for field in fields])) for name, fields in (("ranges", ("first", "stop")), ("spans", ("start", "stop")))}


def _pairs(rows: list[list[tuple[int, int]]], name: str) -> pa.Array:
    fields = [f.name for f in _PAIR[name].value_type]
    return pa.array([[dict(zip(fields, r)) for r in row] for row in rows], _PAIR[name])


def _scanned(rows: DataFrame, part: _Part) -> DataFrame:
    """rows with n_words, ranges, spans and items of a part instead of text."""
    others = [f for f in rows.schema.fields if f.name != "text"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = part.automaton()
        for batch in batches:
            texts = batch["text"].to_pylist()
            own = [scan(t, found) for t in texts]
            spans = [offsets(t, r[1]) for t, r in zip(texts, own)]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[f.name] for f in others],
                    pa.array([r[0] for r in own], pa.int64()),
                    _pairs([r[1] for r in own], "ranges"),
                    _pairs(spans, "spans"),
                    pa.array([sorted(r[2]) for r in own], pa.list_(pa.int64())),
                ],
                [*[f.name for f in others], "n_words", "ranges", "spans", "items"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return rows.mapInArrow(apply, f"{kinds}, n_words long, ranges {_RANGES}, spans {_SPANS}, items array<long>")


def _met(passes: list[DataFrame]) -> DataFrame:
    """One row for each row of documents from the passes over it: ranges united, items distinct."""
    each = passes[0]
    for other in passes[1:]:
        each = each.unionByName(other)
    place = F.arrays_zip(F.col("ranges.first").alias("first"), F.col("ranges.stop").alias("stop"), F.col("spans.start").alias("start"), F.col("spans.stop").alias("end"))
    rows = each.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list(place)).alias("places"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [united([(p["first"], p["stop"], p["start"], p["end"]) for p in row]) for row in batch["places"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_words"], _pairs([[r[:2] for r in row] for row in own], "ranges"), _pairs([[r[2:] for r in row] for row in own], "spans"), batch["items"]],
                ["doc_id", "n_words", "ranges", "spans", "items"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(unite, f"doc_id {kind}, n_words long, ranges {_RANGES}, spans {_SPANS}, items array<long>")


def hits(documents: DataFrame, items: DataFrame, width: int = WIDTH, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """(doc_id, n_words, ranges, spans, items) for each row: disjoint word ranges hit, their code points in the original text, and the items with occurring windows."""
    spark = documents.sparkSession
    bounded_batches(spark)
    parts = _parts(items, width, max_item_bytes)
    first, second = next(parts, []), next(parts, None)
    if second is None:
        return _scanned(documents.select("doc_id", "text"), _Part(spark, first, width))
    rows = materialize(documents.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "rows")
    passes = [materialize(_scanned(rows, _Part(spark, first, width)), "scanned")]
    for part in chain([second], parts):
        passes.append(materialize(_scanned(rows, _Part(spark, part, width)).where(F.size("items") > 0), "scanned"))
    return _met(passes)


def _unhit(documents: DataFrame, part: _Part) -> DataFrame:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = part.automaton()
        for batch in batches:
            yield batch.filter(pa.array([not scan(t, found)[1] for t in batch["text"].to_pylist()], pa.bool_()))

    return documents.mapInArrow(apply, documents.schema)


def clean(documents: DataFrame, items: DataFrame, width: int = WIDTH, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """The rows of documents, with all their columns, that no window hits; each row is judged by its own text.

    Each further part of the items is one more pass over the rows that the parts before it kept.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    parts = _parts(items, width, max_item_bytes)
    kept = _unhit(documents, _Part(spark, next(parts, []), width))
    for part in parts:
        kept = _unhit(materialize(kept, "kept"), _Part(spark, part, width))
    return kept


def report(documents: DataFrame, items: DataFrame, width: int = WIDTH, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of documents."""
    found = hits(documents, items, width, max_item_bytes)
    n_hit = F.aggregate("ranges", F.lit(0).cast("long"), lambda s, r: s + r["stop"] - r["first"])
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda x: x.cast("string"))))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated")
    )


ORACLE = r"""
with words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null and text is not null),
wanted as (
  select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as win
  from words, lateral (select unnest(range(1, greatest(1, len(w) - 9) + 1)) as i) where len(w) > 0),
own as (
  select row_number() over () as k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
sizes as (select distinct n from wanted),
places as (select k, w, n, unnest(range(1, len(w) - n + 2)) as i from own, sizes where len(w) >= n),
cut as (select k, n, i, array_to_string(w[i : i + n - 1], ' ') as win from places),
met as (select k, n, i, item_id from cut join wanted using (n, win)),
spots as (select k, count(distinct p) as n_hit from (select distinct k, unnest(range(i, i + n)) as p from met) group by k),
held as (select k, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids from (select distinct k, item_id from met) group by k)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from own left join spots using (k) left join held using (k)"""
