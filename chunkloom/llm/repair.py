"""Repair of conversation structure: the cheapest edits that make a conversation's roles (s?(ua)+)?, as an audit string.

Rows become symbols of a role (system, user, assistant or another) and a fault: rows that have to go, truncated rows
and sound ones, nine symbols in all. Grammar-compressed DP: Re-Pair over the symbol sequences of all conversations
gives rules (pairs of symbols that occur often, among them symbols of earlier rules). Each symbol has one min-plus
transfer matrix over the four states of the role grammar, with a rope for each entry: a base symbol's rope is a short
text of edits, a rule's rope joins one of each of its two parts. Matrices are evaluated bottom-up, once for each rule,
and all conversations share them; a conversation folds the matrices of its compressed sequence from its end.

Ties go to the least audit in ASCII order without writing audits out. Edits of a run of rows end with that of a row
(inserts come before it, or at the conversation's end), so of two audits of equal rows none begins with the other
unless they are equal; hence the order of two joined ropes is that of their first parts, then of their second ones,
and each matrix carries the ranks of its entries.

The grammar has at most ROUNDS * PAIRS rules, so it is small at any size; what it doesn't cover is folded symbol by
symbol, and the result doesn't depend on the rules. Pairs are counted over distinct sequences, weighted by the
conversations that have them, and only counts reach the driver.

A conversation's rows are read in order within a task, a batch at a time, with its audit before them, so that memory
holds one audit and one symbol sequence, a byte a row, and no texts; its digest is one sequential hash, so one
conversation is one task's work.

Rows come by turn (nulls first), then role, then text. Null roles and texts are one space, and null ids and turns are
written as one in what the damage hashes; rows with a null conversation id form one conversation. Repeated rows are
duplicates, of which the first stays. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chunkloom.llm.common import CRC32_SQL, bounded_batches, materialize

BLANKS = "\t\n\x0b\x0c\r "
#: Re-Pair: rounds over the sequences, and the rules that each adds at most.
ROUNDS = 6
PAIRS = 32
#: Distinct sequences whose audits a task keeps.
CACHE = 50_000
RULE = 0xE000
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a row of a role leads to, from each state that allows it.
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GONE = "-"
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1

Entry = tuple[int, int, object]  # cost, rank among the matrix's ropes, rope


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, kept): rows after damage by their crc32; a row that it drops stays with kept false, so that its conversation does."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = (F.crc32(F.concat_ws(":", *shown).cast("binary")) % 20).alias("kind")
    rows = conversations.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")], kind)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.col("kind") != 0, F.when(F.col("kind") == 3, 2).otherwise(1))).alias("kept")
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies)


def with_faults(rows: DataFrame) -> DataFrame:
    """rows, dealt by conversation, with `fault` (blank, duplicate, truncated or null), `symbol`, null for rows that aren't kept, and `seen`, which orders equal rows."""
    seen = F.row_number().over(W.partitionBy("conv_id", "kept", "role", "text").orderBy("turn"))
    rows = rows.repartition("conv_id").withColumns({"seen": seen, "_end": F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)})
    fault = F.when(F.col("_end") == "", "blank").when(F.col("seen") > 1, "duplicate").when(~F.col("_end").isin(".", "!", "?"), "truncated")
    return rows.withColumn("fault", F.when(F.col("kept"), fault)).withColumn("symbol", F.when(F.col("kept"), _symbol(F.substring("role", 1, 1), F.col("fault")))).drop("_end")


def _symbol(initial: Column, fault: Column) -> Column:
    """The role's letter, a capital for truncated rows, or GONE."""
    letter = F.when(initial.isin(*STEPS), initial).otherwise("x")
    return F.when(fault.isin("blank", "duplicate"), GONE).when(fault == "truncated", F.upper(letter)).otherwise(letter)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def sequences(rows: DataFrame) -> DataFrame:
    """(conv_id, symbols, gaps, blank, duplicate, truncated, illegal) of each conversation, from with_faults()."""
    faults = {"blank": 1, "duplicate": 2, "truncated": 3}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, begun = None, False
        done: list[tuple] = []
        for batch in batches:
            for own, turn, initial, fault, symbol in zip(*[c.to_pylist() for c in batch.columns]):
                if not begun or own != conv:
                    if begun:
                        done.append((conv, "".join(symbols), span[1] - span[0] + 1 - span[2] if span else 0, *counts))
                    conv, begun, symbols, span, counts, before = own, True, [], None, [0, 0, 0, 0], None
                if symbol is None:
                    continue
                symbols.append(symbol)
                if turn is not None:
                    span = (span[0], turn, span[2] + (turn != span[1])) if span else (turn, turn, 1)
                if fault:
                    counts[faults[fault] - 1] += 1
                if before is not None and before + initial not in ("su", "ua", "au"):
                    counts[3] += 1
                before = initial
            if done:
                yield _batch(done)
                done = []
        if begun:
            done.append((conv, "".join(symbols), span[1] - span[0] + 1 - span[2] if span else 0, *counts))
            yield _batch(done)

    def _batch(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["conv_id", "symbols", *_COUNTS])

    bounded_batches(rows.sparkSession)
    ordered = rows.sortWithinPartitions("conv_id", "turn", "role", "text", "seen")
    return ordered.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.substring("role", 1, 1), "fault", "symbol").mapInArrow(gather, "conv_id long, symbols string, " + ", ".join(f"{c} long" for c in _COUNTS))


class Grammar:
    """Rules of pairs of symbols, and the matrices of all symbols: matrix[symbol][from][to] is an entry or None."""

    def __init__(self, rules: list[str]) -> None:
        self.rules = rules
        self.matrix: dict[str, list[list[Entry | None]]] = {s: _base(s) for s in "suaxSUAX" + GONE}
        self.texts: dict[tuple[str, int, int], str] = {}
        for k, (first, second) in enumerate(rules):
            self.matrix[chr(RULE + k)] = _product(self.matrix[first], self.matrix[second])

    def compress(self, symbols: str) -> str:
        for k, pair in enumerate(self.rules):
            if pair in symbols:
                symbols = symbols.replace(pair, chr(RULE + k))
        return symbols

    def text(self, symbol: str, start: int, end: int) -> str:
        """The audit of an entry, from its rope; texts of rules are kept, each at most 2**ROUNDS rows long."""
        rope = self.matrix[symbol][start][end][2]
        if isinstance(rope, str):
            return rope
        key = (symbol, start, end)
        if key not in self.texts:
            first, second = self.rules[ord(symbol) - RULE]
            self.texts[key] = self.text(first, start, rope) + self.text(second, rope, end)
        return self.texts[key]

    def solve(self, symbols: str) -> tuple[int, str]:
        """The least cost, and the least audit of that cost, of a conversation's symbols."""
        packed = self.compress(symbols)
        # For each state, what is left costs so much and has this rank; a repaired conversation is empty or ends with an assistant.
        costs, ranks, chosen = [0, 2 * INSERT, INSERT, 0], [0, 2, 1, 0], []
        for symbol in reversed(packed):
            best = []
            for row in self.matrix[symbol]:
                best.append(min((e[0] + costs[t], e[1], ranks[t], t) for t, e in enumerate(row) if e))
            order = {key: k for k, key in enumerate(sorted({(b[1], b[2]) for b in best}))}
            costs, ranks = [b[0] for b in best], [order[b[1], b[2]] for b in best]
            chosen.append(bytes(b[3] for b in best))
        state, out = START, []
        for symbol, to in zip(packed, reversed(chosen)):
            out.append(self.text(symbol, state, to[state]))
            state = to[state]
        return costs[START], "".join(out) + "I" * {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]


def _base(symbol: str) -> list[list[Entry | None]]:
    """Inserts and then the one row: kept, with another role, or deleted."""
    low = symbol.lower()
    extra = TRUNCATED if symbol != low else 0
    found: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(4)]
    for start in range(4):
        state, inserts = start, 0
        while inserts < 3:
            moves = [(DELETE, "D", state)]
            if symbol != GONE:
                moves += [(extra, "K", STEPS[low][state])] if state in STEPS.get(low, {}) else []
                moves += [(REROLE + extra, "R", STEPS[role][state]) for role in "ua" if state in STEPS[role]]
            for cost, letter, end in moves:
                option = (cost + inserts * INSERT, "I" * inserts + letter)
                if found[start][end] is None or option < found[start][end]:
                    found[start][end] = option
            state, inserts = (ASSISTANT if state == USER else USER), inserts + 1
    ranks = {t: k for k, t in enumerate(sorted({e[1] for row in found for e in row if e}))}
    return [[e and (e[0], ranks[e[1]], e[1]) for e in row] for row in found]


def _product(first: list[list[Entry | None]], second: list[list[Entry | None]]) -> list[list[Entry | None]]:
    found = [[min(((a[0] + b[0], a[1], b[1], m) for m, a in enumerate(row) if a and (b := second[m][t])), default=None) for t in range(4)] for row in first]
    ranks = {key: k for k, key in enumerate(sorted({e[1:3] for row in found for e in row if e}))}
    return [[e and (e[0], ranks[e[1:3]], e[3]) for e in row] for row in found]


def grammar(found: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> list[str]:
    """The rules of Re-Pair over found (symbols): in each round the most frequent pairs that occur twice, ties in order of symbols."""
    distinct = materialize(found.where(F.length("symbols") > 1).groupBy("symbols").agg(F.count("*").alias("n")), "symbols")
    rules: list[str] = []
    for _ in range(rounds):
        shared = list(rules)

        def count(batches: Iterator[pa.RecordBatch], shared: list[str] = shared) -> Iterator[pa.RecordBatch]:
            own, seen = Grammar(shared), Counter()
            for batch in batches:
                for symbols, n in zip(batch["symbols"].to_pylist(), batch["n"].to_pylist()):
                    packed = own.compress(symbols)
                    for pair, k in Counter(zip(packed, packed[1:])).items():
                        seen["".join(pair)] += n * k
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["pair", "n"])

        counts = distinct.mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        new = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(pairs).collect()
        if not new:
            break
        rules += [r["pair"] for r in new]
    return rules


def audits(found: DataFrame, rules: list[str]) -> DataFrame:
    """found (conv_id, symbols and others) with cost and audit instead of symbols."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Grammar(rules), {}
        for batch in batches:
            if len(known) > CACHE:
                known = {}
            solved = []
            for symbols in batch["symbols"].to_pylist():
                if symbols not in known:
                    known[symbols] = own.solve(symbols)
                solved.append(known[symbols])
            kept = [c for c in batch.schema.names if c != "symbols"]
            columns = [pa.array([s[0] for s in solved], pa.int64()), pa.array([s[1] for s in solved], pa.string())]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in kept], *columns], [*kept, "cost", "audit"])

    return found.mapInArrow(solve, "conv_id long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cost long, audit string")


class Editor:
    """Applies an audit to the rows of one conversation, one after another."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _added(self) -> str:
        role = "assistant" if self.state == USER else "user"
        self.state = STEPS[role[0]][self.state]
        return role

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._added(), "", "I"

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of inserted rows and of this one, unless it is deleted."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEPS[role[0]][self.state]
            yield role, text, edit
        elif edit == "R":
            yield self._added(), text, edit


def _planned(conversations: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> DataFrame:
    """Each conversation's counts and audit, then its rows in order, dealt by conversation."""
    rows = damaged(conversations)
    found = materialize(sequences(with_faults(rows)), "conversations")
    planned = audits(found, grammar(found, rounds, pairs))
    texts = rows.where("kept").selectExpr("cast(conv_id as long) as conv_id", "1 as place", "turn", "role", "text")
    both = planned.withColumn("place", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "turn", "role", "text").select("conv_id", "place", "role", "text", "audit", *_COUNTS, "cost")


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, nth, role, text, edit): the rows of damaged conversations after repair, numbered from 0; edit is K, R or I."""

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        editor, conv, nth = None, None, 0
        for batch in batches:
            out: list[tuple] = []
            for own, place, role, text, audit in zip(*[c.to_pylist() for c in batch.columns]):
                if place == 0:
                    made = [(conv, *r) for r in editor.inserted()] if editor else []
                else:
                    made = [(conv, *r) for r in editor.row(role, text)]
                for r in made:
                    out.append((r[0], nth, *r[1:]))
                    nth += 1
                if place == 0:
                    editor, conv, nth = Editor(audit), own, 0
            yield _rows(out)
        yield _rows([(conv, nth + k, *r) for k, r in enumerate(editor.inserted())] if editor else [])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), *[pa.string()] * 3))], ["conv_id", "nth", "role", "text", "edit"])

    return _planned(conversations).select("conv_id", "place", "role", "text", "audit").mapInArrow(edit, "conv_id long, nth long, role string, text string, edit string")


def report(conversations: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    names = ["conv_id", *_COUNTS, "cost", "audit", "repaired_sha256"]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: tuple | None = None
        editor = sha = None

        def take(made: Iterator[tuple[str, str, str]]) -> None:
            nonlocal first
            for role, text, _ in made:
                sha.update((role + ":" + text if first else "\n" + role + ":" + text).encode("utf-8", "surrogatepass"))
                first = False

        first = True
        for batch in batches:
            done: list[tuple] = []
            for own, place, role, text, audit, *counts in zip(*[c.to_pylist() for c in batch.columns]):
                if place:
                    take(editor.row(role, text))
                    continue
                if head:
                    take(editor.inserted())
                    done.append((*head, sha.hexdigest()))
                head, editor, sha, first = (own, *counts, audit), Editor(audit), hashlib.sha256(), True
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if head:
            take(editor.inserted())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*head, sha.hexdigest()), kinds)], names)

    return _planned(conversations, rounds, pairs).mapInArrow(digest, ", ".join(f"{n} {'string' if n in names[-2:] else 'long'}" for n in names))


_SHOWN = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
_BLANK = r"\x20\x09-\x0D"

# The plain DP, row by row from the end, over (state, cost, audit).
ORACLE = rf"""
with recursive chosen as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {CRC32_SQL.format(text="(" + _SHOWN + ")")} % 20 as kind from conversations
), damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case kind when 3 then 2 else 1 end)) as copy
  from chosen where kind <> 0
), numbered as (
  select *, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen from damaged
), faults as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, seen) as i, left(role, 1) as initial,
    case when not regexp_matches(text, '[^{_BLANK}]') then 'b' when seen > 1 then 'd' when not regexp_matches(text, '[.!?][{_BLANK}]*\z') then 't' else '' end as fault
  from numbered
), pairs as (
  select *, lag(initial) over (partition by conv_id order by i) || initial as pair from faults
), counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
    count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from pairs group by conv_id
), inserts(s, m, k) as (
  values (0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (0, 2, 1), (1, 2, 1), (3, 2, 1), (2, 3, 1), (0, 3, 2), (1, 3, 2)
), roles(initial, m, t) as (
  values ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)
), moves as (
  select conv_id, i, m, t, case fault when 't' then 1 else 0 end as cost, 'K' as letter from faults join roles using (initial) where fault not in ('b', 'd')
  union all
  select conv_id, i, m, t, case fault when 't' then 3 else 2 end, 'R' from faults, roles where fault not in ('b', 'd') and roles.initial in ('u', 'a')
  union all
  select conv_id, i, m, m, 3, 'D' from faults, (values (0), (1), (2), (3)) v(m)
), edits as (
  select conv_id, i, s, t, cost + 2 * k as cost, repeat('I', k) || letter as letters from moves join inserts using (m)
), ends(s, cost, audit) as (
  values (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')
), solved as (
  select conv_id, n as i, s, {{'c': cost, 'a': audit}} as best from counts, ends
  union all
  select v.conv_id, v.i - 1, e.s, min({{'c': e.cost + v.best.c, 'a': e.letters || v.best.a}})
  from solved v join edits e on v.conv_id is not distinct from e.conv_id and v.i = e.i and v.s = e.t group by v.conv_id, v.i, e.s
), audits as (
  select conv_id, best.c as cost, best.a as audit from solved where i = 0 and s = 0
), letters as (
  select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from audits
), marked as (
  select conv_id, p, substr(audit, p, 1) as letter, p - length(replace(substr(audit, 1, p), 'I', '')) as added, sum(case substr(audit, p, 1) when 'D' then 0 else 1 end) over (partition by conv_id order by p) as q
  from letters
), placed as (
  select m.conv_id, p, letter, q, f.role, f.text, f.initial from marked m left join faults f on m.conv_id is not distinct from f.conv_id and f.i = p - added and letter <> 'I' where letter <> 'D'
), lines as (
  select conv_id, p, case when letter = 'K' then role
    when (q - max(case when q = 1 and letter = 'K' and initial = 's' then 1 else 0 end) over (partition by conv_id)) % 2 = 1 then 'user' else 'assistant' end
    || ':' || case letter when 'I' then '' else text end as line
  from placed
), repaired as (
  select conv_id, sha256(string_agg(line, chr(10) order by p)) as repaired_sha256 from lines group by conv_id
)
select d.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) d left join counts c on d.conv_id is not distinct from c.conv_id
left join audits a on d.conv_id is not distinct from a.conv_id left join repaired r on d.conv_id is not distinct from r.conv_id
"""
