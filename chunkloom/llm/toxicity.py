"""Toxicity: a weighted finite-state pattern grammar over clauses.

A lexicon (insults, threats, targets, negations, reporting verbs) maps each word of a clause to a symbol with a
weight. Five weighted transducers read these symbols from left to right, each reading what the one before writes:
negation (an insult or threat up to `NEGATION_REACH` words after it is set off), reported speech (so is any in the
rest of its clause), insult (one right after another weighs half), threat (it counts with a target up to
`THREAT_REACH` words after it) and target (at the end, whether the clause is aimed at somebody). compose() turns them
into one machine, and that one runs. The score of a document is a logistic function of the weights of its matched
clauses, with coefficients learned from labels, so an isolated word counts less than one aimed at somebody.

Insults are a fixed list plus terms learned from labels: words, and word beginnings of 4 to 7 characters (so that
inflected forms of one stem share a weight), whose use in toxic documents a likelihood-ratio test sets apart. Copies
and near copies count once there, so that the other words of a text with many copies are not taken for insults.

Null and empty texts match nothing and get the score of the intercept. Texts are read whole. Rows that repeat a
doc_id are scored each by its own text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkloom.llm import kernels as K
from chunkloom.llm.common import bounded_batches, materialize
from chunkloom.llm.jaccard import token_sets
from chunkloom.llm.labelled import id_remainder, training_sample

#: Labelled rows that training takes at most, and learned terms at most.
TRAINING_ROWS = 8000
TERMS = 2000
#: Least likelihood-ratio statistic (one degree of freedom), log odds and toxic documents of a learned term.
LEAST_RATIO, LEAST_ODDS, LEAST_DOCS = 16.0, 2.0, 4
#: Least share of toxic documents among those with a learned term.
LEAST_SHARE = 0.9
#: Minimum hashes of word triples by which near copies are told; documents that share one count once.
COPIES = 4
#: Lengths of the word beginnings that can become terms.
STEMS = (4, 5, 6, 7)
NEGATION_REACH = THREAT_REACH = 3

# Fixed word lists.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown", "dumb", "imbecile", "bastard", "filth", "vermin")
THREATS = ("kill", "hurt", "destroy", "beat", "shoot", "stab", "hang", "burn")
TARGETS = frozenset(("you", "your", "youre", "u", "he", "she", "they", "them", "him", "her", "these", "those", "everyone", "tu", "vous", "du", "ihr", "sie", "usted", "ellos"))
NEGATIONS = frozenset(("not", "no", "never", "isnt", "arent", "wasnt", "dont", "doesnt", "without", "nicht", "kein", "keine", "pas", "jamais", "nunca"))
REPORTS = frozenset(("said", "says", "called", "calls", "wrote", "quote", "quoted", "reported", "claimed", "alleged"))

_CLAUSE = re.compile(r"[.!?;:\n]")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
FEATURES = 7
SYMBOLS = ("word", "insult", "threat", "target", "negation", "report", "end")


@dataclass(frozen=True)
class Transducer:
    """Deterministic arcs (state, symbol) -> (state, symbol written, weight); a pair not listed keeps its state and passes the symbol on."""

    start: object
    arcs: dict[tuple, tuple]

    def step(self, state: object, symbol: str) -> tuple:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def compose(machines: tuple[Transducer, ...], symbols: tuple[str, ...] = SYMBOLS) -> Transducer:
    """One machine over the reachable tuples of states: each machine reads what the one before it writes, and weights multiply."""
    start = tuple(m.start for m in machines)
    arcs: dict[tuple, tuple] = {}
    todo = [start]
    while todo:
        states = todo.pop()
        for symbol in symbols:
            now, written, weight = [], symbol, 1.0
            for m, s in zip(machines, states):
                s, written, w = m.step(s, written)
                now.append(s)
                weight *= w
            arcs[states, symbol] = (tuple(now), written, weight)
            if (tuple(now), symbols[0]) not in arcs and tuple(now) not in todo:
                todo.append(tuple(now))
    return Transducer(start, arcs)


def negation(reach: int = NEGATION_REACH) -> Transducer:
    arcs = {(k, "negation"): (reach, "negation", 1.0) for k in range(reach + 1)}
    for k in range(1, reach + 1):
        arcs |= {(k, s): (k - 1, "negated" if s in ("insult", "threat") else s, 1.0) for s in SYMBOLS if s != "negation"}
    return Transducer(0, arcs)


def reported_speech() -> Transducer:
    return Transducer(False, {(False, "report"): (True, "report", 1.0), **{(True, s): (True, "reported", 1.0) for s in ("insult", "threat", "negated")}})


def insult() -> Transducer:
    arcs = {(False, "insult"): (True, "insult", 1.0), (True, "insult"): (True, "insult", 0.5)}
    return Transducer(False, arcs | {(True, s): (False, s, 1.0) for s in (*SYMBOLS, "negated", "reported") if s != "insult"})


def threat(reach: int = THREAT_REACH) -> Transducer:
    """`threat` becomes `word`, and the target that follows in time `menace`."""
    arcs = {(k, "threat"): (reach, "word", 1.0) for k in range(reach + 1)}
    for k in range(1, reach + 1):
        arcs |= {(k, s): (0, "menace", 1.0) if s == "target" else (k - 1, s, 1.0) for s in (*SYMBOLS, "negated", "reported") if s != "threat"}
    return Transducer(0, arcs)


def target() -> Transducer:
    """At the end: `aimed` or `open`."""
    arcs = {(seen, s): (True, s, 1.0) for seen in (False, True) for s in ("target", "menace")}
    return Transducer(False, arcs | {(False, "end"): (False, "open", 1.0), (True, "end"): (True, "aimed", 1.0)})


GRAMMAR = compose((negation(), reported_speech(), insult(), threat(), target()))


@dataclass(frozen=True)
class Grammar:
    """Terms as (text, whole word, kind, weight), and the logistic coefficients of clause features."""

    terms: tuple[tuple[str, bool, str, float], ...]
    coefficients: tuple[float, ...]


def seed_terms() -> list[tuple[str, bool, str, float]]:
    return [(w, True, "insult", 3.0) for w in INSULTS] + [(w, True, "threat", 0.5) for w in THREATS]


def matcher(terms: tuple[tuple[str, bool, str, float], ...]) -> ahocorasick.Automaton | None:
    by: dict[str, list] = {}
    for text, whole, kind, weight in terms:
        by.setdefault(text, []).append((len(text), whole, kind, weight))
    if not by:
        return None
    found = ahocorasick.Automaton()
    for text, value in by.items():
        found.add_word(text, value)
    found.make_automaton()
    return found


def _inside(c: str) -> bool:
    return c.isalpha() or c == "'"


def clause_weights(words: list[tuple[str, str, float]], machine: Transducer = GRAMMAR) -> tuple[float, float, float, float, float]:
    """Run the machine over the (word, kind, weight) of a clause: weights of open and aimed insults, of what is negated and reported, and of menaces."""
    found = {"insult": 0.0, "negated": 0.0, "reported": 0.0, "menace": 0.0}
    state = machine.start
    for word, kind, weight in words:
        symbol = "negation" if word in NEGATIONS else "report" if word in REPORTS else kind or ("target" if word in TARGETS else "word")
        state, written, factor = machine.arcs[state, symbol]
        if written in found:
            found[written] += factor * (weight or 1.0)
    aimed = machine.arcs[state, "end"][1] == "aimed"
    return 0.0 if aimed else found["insult"], found["insult"] if aimed else 0.0, found["negated"], found["reported"], found["menace"]


def features(text: str | None, found: ahocorasick.Automaton | None) -> np.ndarray:
    """Logarithms of the clauses' weights: open and aimed insults, what is set off, the largest clause, menaces, what is reported; and whether any counts."""
    out = np.zeros(FEATURES)
    if not text or found is None:
        return out
    low = text.lower()
    hits: dict[int, tuple[int, str, float]] = {}  # start of a word: its strongest term
    for end, values in found.iter(low):
        for length, whole, kind, weight in values:
            start = end - length + 1
            if (start and _inside(low[start - 1])) or (whole and end + 1 < len(low) and _inside(low[end + 1])):
                continue
            if start not in hits or weight > hits[start][2]:
                hits[start] = (length, kind, weight)
    if not hits:
        return out
    at = 0
    for start in sorted(hits):
        if start < at:
            continue
        begin = max(low.rfind(c, at, start) for c in ".!?;:\n") + 1  # the clause before ends at one of them
        stop = _CLAUSE.search(low, start)
        at = stop.start() if stop else len(low)
        words = [(m[0].replace("'", ""), *hits.get(m.start(), (0, "", 0.0))[1:]) for m in _WORD.finditer(low, begin, at)]
        plain, aimed, negated, reported, menace = clause_weights(words)
        out[:3] += plain, aimed, negated + reported
        out[3] = max(out[3], plain + aimed + menace)
        out[4:6] += menace, reported
    return np.append(np.log1p(out[:6]), float(out[0] + out[1] + out[4] > 0))


def _minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of the word triples of each text for COPIES seeds; texts without words are left out."""
    for batch in batches:
        data, offsets = K.column(batch["text"])
        own = [t for i, j in K.slices(offsets) for t in token_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], 3)]
        kept = [i for i, t in enumerate(own) if len(t)]
        least = [[int(K.mix(own[i] + np.uint64(k + 1)).min().view(np.int64)) for i in kept] for k in range(COPIES)]
        yield pa.RecordBatch.from_arrays(
            [batch["label"].take(pa.array(kept, pa.int64())), batch["text"].take(pa.array(kept, pa.int64())), *[pa.array(m, pa.int64()) for m in least]],
            ["label", "text", *[f"m{k}" for k in range(COPIES)]],
        )


def _learned(sample: DataFrame) -> list[tuple[str, bool, str, float]]:
    """Terms set apart by the labels of sample (text, label); at most TERMS rows reach the driver."""
    sample = sample.mapInArrow(_minima, "label int, text string, " + ", ".join(f"m{k} long" for k in range(COPIES)))
    for k in range(COPIES):  # of rows with an equal minimum the first by hash and text stays, whatever the partitions
        first = F.min(F.struct(F.xxhash64("text").alias("h"), "text", *[f"m{n}" for n in range(COPIES)])).alias("first")
        sample = sample.groupBy("label", F.col(f"m{k}").alias("own")).agg(first).select("label", *[f"first.{c}" for c in ("text", *[f"m{n}" for n in range(COPIES)])])
    sample = materialize(sample.select("label", "text"), "apart")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    begins = F.flatten(F.transform(words, lambda w: F.transform(F.filter(F.array(*[F.lit(k) for k in STEMS]), lambda k: F.length(w) > k), lambda k: F.concat(F.substring(w, F.lit(1), k), F.lit("*")))))
    terms = sample.select("label", F.explode(F.array_distinct(F.concat(F.filter(words, lambda w: F.length(w) >= 3), begins))).alias("term"))
    totals = sample.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    toxic, rows = totals["p"] or 0, totals["n"]
    if not toxic or toxic == rows:
        return []
    counts = terms.groupBy("term").agg(F.sum("label").alias("k"), F.count("*").alias("m")).where(F.col("k") >= LEAST_DOCS)
    base = toxic / rows
    rest = F.col("m") - F.col("k")
    ratio = 2 * (F.col("k") * F.log(F.col("k") / (F.col("m") * base)) + F.when(rest > 0, rest * F.log(rest / (F.col("m") * (1 - base)))).otherwise(0.0))
    odds = F.log((F.col("k") + 0.5) / (toxic - F.col("k") + 0.5)) - F.log((rest + 0.5) / (rows - toxic - rest + 0.5))
    found = counts.select("term", ratio.alias("ratio"), odds.alias("odds"), (F.col("k") / F.col("m")).alias("share")).where(
        (F.col("ratio") >= LEAST_RATIO) & (F.col("odds") >= LEAST_ODDS) & (F.col("share") >= LEAST_SHARE)
    )
    rows = found.orderBy(F.desc("ratio"), "term").limit(TERMS).collect()
    stems: list[str] = []
    out = []
    for r in sorted(rows, key=lambda r: (len(r["term"]), r["term"])):
        term, stem = r["term"].rstrip("*"), r["term"].endswith("*")
        if not any(term.startswith(s) for s in stems):
            out.append((term, not stem, "insult", min(6.0, r["odds"])))
            stems += [term] * stem
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps; the intercept is the last coefficient."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _featured(df: DataFrame, terms: tuple, extra: str) -> DataFrame:
    """(doc_id, extra columns, x): clause features of each text."""
    shared = df.sparkSession.sparkContext.broadcast(terms)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = matcher(shared.value)
        for batch in batches:
            x = [features(t, found) for t in batch["text"].to_pylist()]
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in keep], pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    return df.mapInArrow(apply, f"doc_id long, {extra} x array<double>")


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, held_out: int = 2, rows: int = TRAINING_ROWS) -> Grammar:
    """Learn terms and coefficients from at most `rows` labelled documents outside the held-out remainder."""
    bounded_batches(documents.sparkSession)
    ids = F.broadcast(training_sample(labels, label, modulus, held_out, rows))  # at most `rows` rows of two numbers
    sample = documents.select("doc_id", "text").join(ids, "doc_id")
    terms = tuple(seed_terms() + _learned(sample.select("text", "label")))
    seen = _featured(sample.select("doc_id", "label", "text"), terms, "label int,").orderBy(F.xxhash64("doc_id"), "doc_id", "label", "x").limit(2 * rows).collect()
    if not seen:
        return Grammar(terms, (1.0, 1.0, 0.2, 1.0, 1.0, 0.0, 1.0, -3.0))
    w = _logistic(np.array([r["x"] for r in seen]), np.array([r["label"] for r in seen], float))
    return Grammar(terms, tuple(float(c) for c in w))


def score(documents: DataFrame, grammar: Grammar) -> DataFrame:
    """(doc_id, score) for each row."""
    bounded_batches(documents.sparkSession)
    *w, b = grammar.coefficients
    x = _featured(documents.select("doc_id", "text"), grammar.terms, "")
    logit = sum((F.col("x")[i] * c for i, c in enumerate(w)), F.lit(b))
    return x.select("doc_id", (1 / (1 + F.exp(-logit))).alias("score"))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of documents."""
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
