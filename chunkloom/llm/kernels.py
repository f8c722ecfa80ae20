"""Vectorised text kernels over Arrow string columns: word spans and 64-bit hashes, without a Python loop over words.

A word's hash is a polynomial over its bytes modulo 2**64, mixed at the end. The same word has the same
hash on every machine and in every batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _powers_of(base: np.uint64) -> np.ndarray:
    p = np.full(CHUNK_BYTES + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_POWERS, _INVERSES = _powers_of(_BASE), _powers_of(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kinds(*classes: bytes, rest: int) -> np.ndarray:
    """The kind of each byte: 0 for the first class, 1 for the second and so on, else rest."""
    out = np.full(256, rest, np.uint8)
    for k, members in enumerate(classes):
        out[np.frombuffer(members, np.uint8)] = k
    return out


#: A-Z to a-z, the rest as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words end at a space or one of the five ASCII control characters that are white space.
WORDS = kinds(b" \t\n\v\f\r", rest=1)
#: The same, with punctuation as words of their own: 1 letters, digits and non-ASCII, 2 the rest.
TOKENS = kinds(
    b" \t\n\v\f\r",
    b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256)),
    rest=2,
)


def column(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its offsets (one more than rows, from 0); null: empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values.cast(pa.large_string()), "")
    if len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def spans(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of data: longest runs of bytes of one kind other than 0, within bounds."""
    now = np.zeros(len(data) + 2, np.uint8)
    now[1:-1] = kind[data]
    change = now[1:] != now[:-1]
    change[bounds] = True
    starts = np.flatnonzero(change & (now[1:] != 0))
    ends = np.flatnonzero(change & (now[:-1] != 0))
    return starts, ends


def values_of(n: int) -> np.ndarray:
    """What each of n units, bytes or characters, adds to a hash."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_BYTE_VALUE = values_of(256)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE_VALUE) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, or of other units with values of their own; spans are in order. Memory beyond the result is that of one block."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right"))
        first = int(starts[i])
        if j > i:
            block = data[first : ends[j - 1]]
            total = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(values[block] * _POWERS[: len(block)], out=total[1:])
            out[i:j] = (total[ends[i:j] - first] - total[starts[i:j] - first]) * _INVERSES[starts[i:j] - first]
            i = j
            continue
        for at in range(first, int(ends[i]), CHUNK_BYTES):  # a word longer than a block
            block = data[at : min(at + CHUNK_BYTES, int(ends[i]))]
            part = (values[block] * _POWERS[: len(block)]).sum(dtype=np.uint64)
            with np.errstate(over="ignore"):
                out[i] += part * np.uint64(pow(int(_BASE), at - first, 1 << 64))
        i += 1
    return mix(out + (ends - starts).astype(np.uint64))


def owners(bounds: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each of bounds, the number of words that start before it: word ranges of rows."""
    return np.searchsorted(starts, bounds, "left")
