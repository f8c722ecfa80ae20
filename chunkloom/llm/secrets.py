"""Secret scans: fixed patterns, and a randomness test battery over long unbroken runs.

Patterns, leftmost and non-overlapping per kind: `assign`, `access` and `hex` (see PATTERNS). The battery looks
at runs of 20 or more of `A-Za-z0-9+/_=-`. It infers an encoding (hex, base32, base64, alphanumeric) and asks three
questions of a run, each twice:

* uniformity: are the symbols used alike, or like the letters of written words?
* runs: do high and low symbols, or cases, digits and marks, take turns as by chance, or as in words and names?
* serial correlation: is a symbol independent of the one before, or do vowels and consonants alternate?

Against written words, each answer is a likelihood ratio of the encoding's random strings to a fixed model of text
in which the three are separate factors. If the run were text, their product would reach 1 / p with a chance of p at
most, at any length, so 1 / product is a p-value that knows the run's length: evidence adds up with each symbol.
Benjamini-Hochberg at `rate` over all runs of a document, with weights that grow with the logarithm of the length,
controls the false discoveries. Against random strings, the classical tests (chi-squared, runs, serial correlation,
and the share of marks) must not reject at level `fit`, Bonferroni over the four.

Runs for which both hold become spans of kind `random`, unless a pattern's span overlaps them. Null texts are
empty; texts are scanned whole; offsets are code points, ends exclusive. Rows with one doc_id are scanned apart.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm import kernels as K
from chunkloom.llm.common import bounded_batches

# Fixed values.
KINDS = ("assign", "access", "hex")
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Lower-case strings one of which any match of `assign` holds.
HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
RUN = 20
FIT = 0.02
RATE = 1e-3

# Fixed values of the model of text: how often a letter occurs in European languages (percent, rounded), how often a
# lower-case letter, capital, digit or mark follows each of these, how often a vowel follows a vowel or consonant, and
# how often a symbol is the one before again.
LETTERS = {
    "e": 13.5, "a": 8.5, "n": 8.0, "i": 7.5, "s": 7.0, "r": 6.8, "t": 7.0, "o": 6.0, "l": 4.5, "d": 4.5, "u": 4.5, "h": 3.2, "c": 3.2,
    "m": 2.7, "p": 2.2, "g": 1.9, "b": 1.6, "f": 1.5, "v": 1.5, "w": 1.1, "k": 1.0, "y": 0.9, "z": 0.8, "q": 0.6, "j": 0.5, "x": 0.4,
}
FOLLOWS = ((0.89, 0.05, 0.02, 0.04), (0.54, 0.36, 0.04, 0.06), (0.13, 0.10, 0.64, 0.13), (0.53, 0.22, 0.15, 0.10))
VOWELS = "aeiouy"
VOWEL_AFTER_VOWEL, VOWEL_AFTER_CONSONANT, VOWEL_FIRST = 0.18, 0.58, 0.4
REPEATED = 0.04

_ALNUM = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
_IN_RUN = np.zeros(256, np.uint8)
_IN_RUN[np.frombuffer(_ALNUM + b"+/_=-", np.uint8)] = 1
_IN_HEX = np.zeros(256, np.uint8)
_IN_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = 1
_ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("lower letters", "abcdefghijklmnopqrstuvwxyz"),
    ("upper letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("alphanumeric", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)


def encoding(run: str) -> tuple[str, str] | None:
    """The smallest alphabet that covers the run without its padding."""
    used = set(run)
    return next(((name, letters) for name, letters in _ALPHABETS if used <= set(letters)), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def randomness(run: str) -> float:
    """The least p-value of the four classical tests, times four, for a random string of the inferred encoding."""
    run = run.rstrip("=")
    kind = encoding(run)
    n = len(run)
    if kind is None or n < 8:
        return 0.0
    place = {c: i for i, c in enumerate(kind[1])}
    x = np.array([place[c] for c in run], float)
    k = len(kind[1])
    # Symbols fall into few equal cells, so that each expects five or more.
    cells = max(2, min(k, n // 5))
    counts = np.bincount((x * cells // k).astype(int), minlength=cells)
    widths = np.bincount((np.arange(k) * cells // k), minlength=cells) / k * n
    chi, df = float(((counts - widths) ** 2 / widths).sum()), cells - 1
    cube = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    uniform = 0.5 * math.erfc(cube / math.sqrt(2))
    high = x >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    if a == 0 or b == 0:
        return 0.0
    mean = 1 + 2 * a * b / n
    spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    turns = _normal_tail((1 + int((high[1:] != high[:-1]).sum()) - mean) / spread)
    d = x - x.mean()
    power = float(d @ d)
    serial = _normal_tail((float(d[1:] @ d[:-1]) / power + 1 / n) * math.sqrt(n)) if power else 0.0
    marks = [c for c in kind[1] if not c.isalnum()]
    marked = at_least(n, sum(run.count(c) for c in marks), len(marks) / k) if marks else 1.0
    return min(1.0, 4 * min(uniform, turns, serial, marked))


def at_least(n: int, least: int, chance: float) -> float:
    """The chance of `least` or more successes in n trials. Summed outwards from one side of the mean, so terms only fall; sums stop where the rest is below a float's precision."""
    if least <= 0:
        return 1.0
    if least > n:
        return 0.0
    upper = least > n * chance
    i, odds = least if upper else least - 1, chance / (1 - chance)
    first = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(chance) + (n - i) * math.log1p(-chance)
    total = term = 1.0  # as multiples of the first term
    while True:
        ratio = (n - i) / (i + 1) * odds if upper else i / (n - i + 1) / odds
        term *= ratio
        total += term
        i += 1 if upper else -1
        if term <= 1e-17 * total * (1 - ratio):
            break
    tail = math.exp(min(0.0, first + math.log(total)))
    return tail if upper else 1 - tail


def _logs() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """By byte: its kind (lower, upper, digit, mark), whether a vowel, whether a letter, the log share among letters of its sort or digits."""
    kind, vowel, letter, share = np.full(128, 3), np.zeros(128, bool), np.zeros(128, bool), np.zeros(128)
    for c, p in LETTERS.items():
        same = sum(q for d, q in LETTERS.items() if (d in VOWELS) == (c in VOWELS))
        for x, k in ((c, 0), (c.upper(), 1)):
            kind[ord(x)], vowel[ord(x)], letter[ord(x)], share[ord(x)] = k, c in VOWELS, True, math.log(p / same)
    for c in "0123456789":
        kind[ord(c)], share[ord(c)] = 2, math.log(0.1)
    for c in "+/_=-":
        share[ord(c)] = math.log(0.5)
    return kind, vowel, letter, share


_KIND_OF, _VOWEL_OF, _LETTER_OF, _SHARE_OF = _logs()


def tests(run: str) -> tuple[float, float, float]:
    """Log likelihood ratios of the inferred encoding's random strings to text: uniformity, runs, serial correlation."""
    run = run.rstrip("=")
    alphabet = encoding(run)
    if alphabet is None or not run:
        return -math.inf, 0.0, 0.0
    own, x = np.frombuffer(alphabet[1].encode(), np.uint8), np.frombuffer(run.encode(), np.uint8)
    kinds, vowels, letters = _KIND_OF[x], _VOWEL_OF[x], _LETTER_OF[x]
    # The encoding, in the same factors: a kind, for letters vowel or consonant, and a symbol of that sort.
    sort = lambda c: _KIND_OF[c] * 2 + _VOWEL_OF[c]
    by_kind, by_sort = np.bincount(_KIND_OF[own], minlength=4), np.bincount(sort(own), minlength=8)
    uniform = -np.log(by_sort[sort(x)]) - _SHARE_OF[x]
    turns = np.append(0.0, np.log(by_kind[kinds[1:]] / len(own)) - np.log(np.array(FOLLOWS))[kinds[:-1], kinds[1:]])
    v = vowels[letters]
    before = np.where(v[:-1], VOWEL_AFTER_VOWEL, VOWEL_AFTER_CONSONANT)
    text = np.append(VOWEL_FIRST, before)[: len(v)]
    serial = np.zeros(len(x))
    serial[letters] = np.log(by_sort[sort(x)] / by_kind[kinds])[letters] - np.log(np.where(v, text, 1 - text))
    # Text repeats a symbol with the chance REPEATED, or else goes on as above.
    chance = np.exp(-math.log(len(own)) - uniform - turns - serial)
    again = np.append(False, x[1:] == x[:-1])
    serial -= np.log1p(-REPEATED + np.where(again, REPEATED / chance, 0.0))
    return float(uniform.sum()), float(turns.sum()), float(serial.sum())


def unlike_text(run: str) -> float:
    """A p-value of the run under the model of text."""
    return math.exp(min(0.0, -sum(tests(run))))


def discoveries(p: list[float], rate: float = RATE, lengths: list[int] | None = None) -> list[bool]:
    """Benjamini-Hochberg: which hypotheses are rejected; weights grow with the logarithm of the length, and are 1 on average."""
    if lengths:
        weight = [math.log2(1 + n) for n in lengths]
        mean = sum(weight) / len(weight)
        p = [x * mean / w for x, w in zip(p, weight)]
    order = sorted(range(len(p)), key=p.__getitem__)
    last = max((k + 1 for k, i in enumerate(order) if p[i] <= rate * (k + 1) / len(p)), default=0)
    out = [False] * len(p)
    for i in order[:last]:
        out[i] = True
    return out


def _runs(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = K.spans(data, bounds, kind)
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    for kind in KINDS:
        for m in PATTERNS[kind].finditer(text):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def random_spans(text: str, runs: list[tuple[int, int]], taken: list[tuple[str, int, int]], fit: float = FIT, rate: float = RATE) -> list[tuple[str, int, int]]:
    """Runs (code point ranges) that fit a random string and not text."""
    p = [unlike_text(text[a:b]) for a, b in runs]
    spans = sorted((s, e) for _, s, e in taken)
    starts, reach = [s for s, _ in spans], [0, *accumulate((e for _, e in spans), max)]
    return [
        ("random", a, b)
        for (a, b), found in zip(runs, discoveries(p, rate, [b - a for a, b in runs]))
        if found and randomness(text[a:b]) > fit and reach[bisect_left(starts, b)] <= a
    ]


def scan_batch(values: pa.Array) -> list[tuple[list, list]]:
    """For each text its base spans and its random spans."""
    data, offsets = K.column(values)
    out: list[tuple[list, list]] = []
    for i, j in K.slices(offsets):
        part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        raw = part.tobytes()
        low = raw.lower()
        pattern = np.zeros(j - i, bool)
        starts, _ = _runs(part, bounds, _IN_HEX, LEAST["hex"])
        pattern[np.searchsorted(bounds, starts, "right") - 1] = True
        for where, hints in ((low, HINTS), (raw, (b"AKIA",))):
            for hint in hints:
                at = where.find(hint)
                while at >= 0:
                    row = int(np.searchsorted(bounds, at, "right")) - 1
                    pattern[row] = True
                    at = where.find(hint, int(bounds[row + 1]) if row + 1 < len(bounds) else len(where))
        starts, ends = _runs(part, bounds, _IN_RUN, RUN)
        rows = np.searchsorted(bounds, starts, "right") - 1
        firsts, lasts = np.searchsorted(rows, np.arange(j - i), "left"), np.searchsorted(rows, np.arange(j - i), "right")
        for k in range(j - i):
            if not pattern[k] and firsts[k] == lasts[k]:
                out.append(([], []))
                continue
            own = raw[bounds[k] : bounds[k + 1]]
            text = own.decode("utf-8", "surrogatepass")
            base = base_spans(text) if pattern[k] else []
            runs = []
            byte = point = 0  # the same place, in bytes and in code points
            for r in range(firsts[k], lasts[k]):
                a, b = int(starts[r] - bounds[k]), int(ends[r] - bounds[k])
                if len(text) != len(own):
                    byte, point = a, point + len(own[byte:a].decode("utf-8", "surrogatepass"))
                    a, b = point, point + b - a
                runs.append((a, b))
            out.append((base, random_spans(text, runs, base)))
    return out


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if b > at:
            out += [text[at : max(a, at)], mark if a >= at else ""]
            at = b
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each document."""
    bounded_batches(documents.sparkSession)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = scan_batch(batch["text"])
            order = {k: i for i, k in enumerate((*KINDS, "random"))}
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"]]
                + [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS]
                + [
                    pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in rows], pa.string()),
                    pa.array([_joined(sorted(base + more, key=lambda s: (s[1], order[s[0]]))) for base, more in rows], pa.string()),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return documents.select("doc_id", "text").mapInArrow(apply, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(documents: DataFrame) -> DataFrame:
    """documents with every span in `text` replaced by a mark; a null text stays null, other columns stay."""
    bounded_batches(documents.sparkSession)
    place = documents.columns.index("text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = scan_batch(batch["text"])
            texts = [t if t is None or not (a or b) else redact(t, a + b) for t, (a, b) in zip(batch["text"].to_pylist(), rows)]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return documents.mapInArrow(apply, documents.schema)
