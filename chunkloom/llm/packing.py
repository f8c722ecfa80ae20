"""Packing token sequences: shortest-pack-first over the length histogram.

Documents are tokenised and cut into pieces of `capacity` ids and a shorter rest. The histogram of piece lengths
(at most `capacity` rows) goes to the driver, where lengths are placed longest first, each into the shortest pack
so far; packs with the same contents are one pattern with a count, so the work depends on the number of lengths
and not of documents. Where nothing fits, as many packs open as the pieces of that length fill. Pieces then find their place by rank: the r-th piece of a length takes the r-th slot for it.

Ranks are counted within (length, bucket), and shifted by the sizes of the buckets before. A bucket holds at most about
RANKED pieces, and at most about one in SHARES of all, so that a length shared by many isn't ranked in one task.

Sequences are written with their ids: a piece of `capacity` ids is a sequence as it is, and rests travel to their
sequence, at most `capacity` rows each, where they are laid end to end and padded. What packed() returns is read
from the written sequences.

A null text is empty and has one piece with the end id alone. Rows with the same doc_id are packed like others.
"""

from __future__ import annotations

import os
import re
from bisect import insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chunkloom.llm import kernels as K
from chunkloom.llm.common import bounded_batches, materialize

CAPACITY = 2048
END_ID = 1
#: A real token too: a sequence's `filled` says where padding begins.
PAD_ID = 0
RANKED = 100_000
SHARES = 1000
#: Words of at most LONGEST characters that a process keeps, and places for them.
KNOWN, PLACES, LONGEST = 500_000, 1 << 20, 64

# The vocabulary's own rules for cutting text into words, for characters below U+0250.
_BLANK = r"\t-\r \x85\xa0"
_LETTERS = "a-zªµºß-öø-ɏ"
_NUMBERS = "0-9²³¹¼½¾"
#: Kinds of characters: 0 blanks, 1 letters, 2 numbers, each a word of its own, 3 the rest.
_KIND = np.array([0 if re.match(f"[{_BLANK}]", c) else 1 if re.match(f"[{_LETTERS}]", c) else 2 if re.match(f"[{_NUMBERS}]", c) else 3 for c in map(chr, range(0x250))], np.uint8)
_VALUES = K.values_of(0x250)
#: Characters below U+0250 whose lower case is none of one character below U+0250.
_FAR = "".join(chr(c) for c in range(0x250) if len(chr(c).lower()) > 1 or chr(c).lower() > "ɏ")
#: Texts with such or other characters, or with these strings, go through the tokenizer whole.
_OTHER = re.compile(rf"[{_FAR}ɐ-\U0010ffff]")
_SPECIAL = re.compile(r"<\|(?:startoftext|endoftext)\|>")


def _byte_letters() -> dict[int, str]:
    """The letter that the vocabulary writes for each byte: itself where it prints, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _cut(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-case characters, within bounds.

    Runs of one kind, numbers apart. An apostrophe that is a run by itself takes the s, t, m, d, re, ve or ll after it.
    """
    kind = np.zeros(len(data) + 2, np.uint8)
    kind[1:-1] = _KIND[data]
    change = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    change[bounds] = True
    starts, ends = np.flatnonzero(change & (kind[1:] != 0)), np.flatnonzero(change & (kind[:-1] != 0))
    own = np.flatnonzero((data[starts] == ord("'")) & (ends - starts == 1))
    edge = np.zeros(len(data) + 3, bool)
    edge[bounds] = True
    after = np.append(data, np.zeros(2, data.dtype))
    at = ends[own]
    one, two = after[at], after[at + 1]
    single = np.isin(one, [ord(c) for c in "stmd"]) & ~edge[at]
    double = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~edge[at] & ~edge[at + 1]
    more = single + 2 * double
    own, more = own[more > 0], more[more > 0]
    ends[own] += more
    starts[own + 1] += more
    left = starts < ends
    return starts[left], ends[left]


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes. Words are cut and looked up by array operations.

    A process keeps the first KNOWN words, which are the frequent ones, by a 64-bit hash, and gives others to the
    tokenizer's model once a slice of the texts. That a word of a corpus with 10^8 different ones shares its hash with
    a known word happens with a chance of 3e-6.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.keys, self.nth = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.int32)
        self.known = self.used = 0
        #: Where a word's ids begin, and how many it has. What comes after the known words is of the slice at hand.
        self.first, self.count, self.ids = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key's word, -1 where it isn't known."""
        out = np.full(len(keys), -1, np.int64)
        todo, at = np.arange(len(keys)), (keys & np.uint64(PLACES - 1)).astype(np.int64)
        while len(todo):
            held = self.keys[at]
            same = held == keys[todo]
            out[todo[same]] = self.nth[at[same]]
            on = ~same & (held != 0)
            todo, at = todo[on], (at[on] + 1) & (PLACES - 1)
        return out

    def _keep(self, keys: np.ndarray, nth: np.ndarray) -> None:
        """Different keys, none of them known."""
        at = (keys & np.uint64(PLACES - 1)).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            own = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[own]], self.nth[at[own]] = keys[own], nth[own]
            on = np.ones(len(keys), bool)
            on[own] = False
            keys, nth, at = keys[on], nth[on], (at[on] + 1) & (PLACES - 1)

    def _put(self, words: list[str]) -> None:
        """The ids of words, after those of the known ones."""
        own = [[t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(self.letters))] for w in words]
        count = np.array([len(x) for x in own], np.int32)
        ids = np.array([i for x in own for i in x], "<u4")
        n, m = self.known + len(count), self.used + len(ids)
        if n > len(self.first):
            self.first, self.count = (np.append(x[: self.known], np.zeros(2 * n - self.known, np.int32)) for x in (self.first, self.count))
        if m > len(self.ids):
            self.ids = np.append(self.ids[: self.used], np.zeros(2 * m - self.used, "<u4"))
        self.first[self.known : n] = self.used + np.cumsum(count) - count
        self.count[self.known : n] = count
        self.ids[self.used : m] = ids

    def _slice(self, texts: list[str]) -> list[bytes]:
        """The ids of each of lower-case texts of characters below U+0250."""
        text = "".join(texts)
        data = np.frombuffer(text.encode("utf-16-le"), "<u2")
        bounds = np.cumsum([0, *map(len, texts)])
        starts, ends = _cut(data, bounds)
        keys = K.span_hashes(data, starts, ends, _VALUES)
        keys[keys == 0] = 1
        nth = self._find(keys)
        long = ends - starts > LONGEST
        nth[long] = -1
        new = np.flatnonzero(nth < 0)
        # Long words are looked up one by one, behind the others.
        short, far = new[~long[new]], new[long[new]]
        different, place, inverse = np.unique(keys[short], return_index=True, return_inverse=True)
        each = np.append(short[place], far)
        self._put([text[a:b] for a, b in zip(starts[each].tolist(), ends[each].tolist())])
        nth[short] = self.known + inverse
        nth[far] = self.known + len(different) + np.arange(len(far))
        count = self.count[nth].astype(np.int64)
        until = np.cumsum(count)
        ids = self.ids[np.repeat(self.first[nth] - until + count, count) + np.arange(until[-1] if len(until) else 0)]
        if keep := min(len(different), KNOWN - self.known):
            self._keep(different[:keep], self.known + np.arange(keep))
            self.used += int(self.count[self.known : self.known + keep].sum())
            self.known += keep
        at = np.append(0, until)[K.owners(bounds, starts)].tolist()
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        out, low, own, size = [b""] * len(texts), [], [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if not text.isascii() and _OTHER.search(text) or "<|" in text and _SPECIAL.search(text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            if low and size + len(text) > K.CHUNK_BYTES:
                for k, ids in zip(own, self._slice(low)):
                    out[k] = ids
                low, own, size = [], [], 0
            low.append(text.lower())
            own.append(i)
            size += len(text)
        for k, ids in zip(own, self._slice(low) if low else []):
            out[k] = ids
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each path and process: a worker keeps its words from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def squeeze(ids: bytes) -> bytes:
    """Little-endian unsigned 32-bit ids, compressed: all low halves first, then the high ones, which are mostly zero."""
    return pa.compress(np.frombuffer(ids, "<u2").reshape(-1, 2).T.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes, length: int) -> bytes:
    return np.frombuffer(pa.decompress(data, 4 * length, codec="zstd", asbytes=True), "<u2").reshape(2, -1).T.tobytes()


def pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, nth, ids): the ids of each piece as squeeze() has them. nth counts the task's pieces of `capacity` ids before this one."""
    bounded_batches(documents.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own, nth = encoder(tokenizer_path), 0
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc, ids in zip(batch["doc_id"].to_pylist(), own.encode_all(batch["text"].to_pylist())):
                ids += end
                for at in range(0, len(ids), 4 * capacity):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(out, (doc, at // 4, len(part) // 4, len(ids) // 4, nth, squeeze(part))):
                        column.append(value)
                    nth += len(part) == 4 * capacity
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (*[pa.int64()] * 5, pa.binary()))], ["doc_id", "start", "length", "doc_tokens", "nth", "ids"])

    return documents.select("doc_id", "text").mapInArrow(apply, "doc_id long, start long, length long, doc_tokens long, nth long, ids binary")


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of packs for the given numbers of pieces by length: longest first, shortest pack first."""
    open_packs: dict[int, list[tuple[int, tuple]]] = {}  # by space left
    spaces: list[int] = []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = spaces[-1] if spaces and spaces[-1] >= length else None
            if space is None:
                count, held, space = -(-left // (capacity // length)), (), capacity
            else:
                count, held = open_packs[space].pop()
                if not open_packs[space]:
                    del open_packs[space]
                    spaces.pop()
            used = min(count, left)
            for n, s, pack in ((count - used, space, held), (used, space - length, (length, held))):
                if n:
                    if s not in open_packs:
                        open_packs[s] = []
                        insort(spaces, s)
                    open_packs[s].append((n, pack))
            left -= used
    found: dict[tuple[int, ...], int] = {}
    for packs in open_packs.values():
        for n, pack in packs:
            lengths = []
            while pack:
                lengths.append(pack[0])
                pack = pack[1]
            if lengths:
                key = tuple(reversed(lengths))
                found[key] = found.get(key, 0) + n
    return [(n, key) for key, n in sorted(found.items(), reverse=True)]


def slots(packs: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """For each length, columns of first rank, first sequence and offset, by rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for count, lengths in packs:
        offset = 0
        for length in lengths:
            out.setdefault(length, []).append((ranks.get(length, 0), sequence, offset))
            ranks[length] = ranks.get(length, 0) + count
            offset += length
        sequence += count
    return {k: np.array(v, np.int64) for k, v in out.items()}


def ranked(table: DataFrame, histogram: dict[int, int], order: list[str], most: int | None = None) -> DataFrame:
    """table with `rank`: 0, 1, ... within each length, in buckets of about `most` rows."""
    most = most or max(1, min(RANKED, sum(histogram.values()) // SHARES))
    many = [(k, -(-n // most)) for k, n in histogram.items() if n > most]
    buckets = F.coalesce(F.create_map(*[F.lit(x) for pair in many for x in pair])[F.col("length")], F.lit(1)) if many else F.lit(1)
    table = table.withColumn("bucket", F.pmod(F.xxhash64(*order), buckets.cast("long")))
    counts = table.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))).drop("n")
    here = F.row_number().over(W.partitionBy("length", "bucket").orderBy(*order)) - 1
    return table.withColumn("here", here).join(before, ["length", "bucket"]).withColumn("rank", (F.coalesce("before", F.lit(0)) + F.col("here")).cast("long")).drop("here", "before", "bucket")


def pack(table: DataFrame, capacity: int = CAPACITY, plan: Callable[[dict[int, int], int], list[tuple[int, tuple[int, ...]]]] = patterns) -> DataFrame:
    """table (doc_id, start, length and others) with sequence_id and offset. table should be cheap to read twice.

    plan gives the packs, (count, lengths), for the numbers of pieces by length and the capacity.
    """
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    if any(not 0 < k <= capacity for k in histogram):
        raise ValueError(f"piece lengths have to be from 1 to {capacity}")
    shared = table.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))
    order = [c for c in table.columns if table.schema[c].dataType.typeName() in ("long", "integer", "string")]
    rows = ranked(table, histogram, order)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                table = shared.value[int(k)]
                at = np.searchsorted(table[:, 0], rank[own], "right") - 1
                sequence[own] = table[at, 1] + rank[own] - table[at, 0]
                offset[own] = table[at, 2]
            kept = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in kept], pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    added = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    return rows.mapInArrow(place, T.StructType([f for f in rows.schema.fields if f.name != "rank"] + added))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def filled(rows: DataFrame, capacity: int = CAPACITY, pad_id: int = PAD_ID) -> DataFrame:
    """(sequence_id, filled, ids, pieces) from rows of pieces, whose partitions hold whole sequences in order of sequence_id and offset. ids are little-endian unsigned 32-bit bytes, padded to `capacity`."""
    pad = np.array([pad_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "doc_tokens", "offset"]
    held = pa.list_(pa.struct([(n, pa.int64()) for n in names]))

    def written(done: list[tuple[int, list, list]]) -> pa.RecordBatch:
        for _, blobs, own in done:
            if any(p["offset"] != q["offset"] + q["length"] for p, q in zip(own, [{"offset": 0, "length": 0}, *own])):
                raise ValueError("pieces of a sequence overlap or leave a gap")
        sizes = [sum(p["length"] for p in own) for _, _, own in done]
        if max(sizes) > capacity:
            raise ValueError(f"a sequence has more than {capacity} ids")
        ids = [b"".join([*[unsqueeze(b, p["length"]) for b, p in zip(blobs, own)], pad * (capacity - n)]) for (_, blobs, own), n in zip(done, sizes)]
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array([d[2] for d in done], held)], ["sequence_id", "filled", "ids", "pieces"])

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, list, list]] = []
        for batch in batches:
            own = batch.select(names).to_pylist()
            for sequence, blob, piece in zip(batch["sequence_id"].to_pylist(), batch["ids"].to_pylist(), own):
                if not done or done[-1][0] != sequence:
                    if len(done) == 200:
                        yield written(done)
                        done = []
                    done.append((sequence, [], []))
                done[-1][1].append(blob)
                done[-1][2].append(piece)
        if done:
            yield written(done)

    return rows.select(*names, "sequence_id", "ids").mapInArrow(lay, f"sequence_id long, filled long, ids binary, pieces array<struct<{','.join(f'{n}:bigint' for n in names)}>>")


def sequences(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY, pad_id: int = PAD_ID, plan: Callable = patterns) -> DataFrame:
    """The padded sequences of all documents, written: (sequence_id, filled, ids, pieces), see filled() and pack()."""
    spark = documents.sparkSession
    cut = materialize(pieces(documents, path or tokenizer_path(), capacity).withColumns({"piece": F.monotonically_increasing_id(), "task": F.spark_partition_id()}), "pieces")
    whole, rest = cut.where(F.col("length") == capacity), cut.where(F.col("length") < capacity)
    before, total = [], 0
    for r in whole.groupBy("task").agg(F.count("*").alias("n")).orderBy("task").collect():  # one row for each task that wrote
        before.append((r["task"], total))
        total += r["n"]
    shift = F.broadcast(spark.createDataFrame(before, "task int, before long"))
    whole = whole.join(shift, "task").withColumns({"sequence_id": F.col("before") + F.col("nth"), "offset": F.lit(0).cast("long")})
    places = pack(rest.select("doc_id", "start", "length", "doc_tokens", "piece"), capacity, plan).select("piece", (F.col("sequence_id") + total).alias("sequence_id"), "offset")
    rest = rest.join(materialize(places, "places"), "piece").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return materialize(filled(rest, capacity, pad_id).unionByName(filled(whole, capacity, pad_id)), "sequences", compression="zstd")


def placed(sequences: DataFrame) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece in written sequences."""
    own = "transform(pieces, p -> struct(p.doc_id, p.start, p.length, crc32(substring(ids, int(4 * p.offset + 1), int(4 * p.length))) as ids_crc32, p.doc_tokens, sequence_id, p.offset))"
    return sequences.selectExpr(f"inline({own})")


def packed(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of each piece, read from the written sequences."""
    return placed(sequences(documents, path))
