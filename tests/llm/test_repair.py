"""Conversation repair against every possible edit, a plain DP, and a plain version of the whole."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from chunkloom.llm import repair

WANTED = re.compile(r"(s?(ua)+)?")
BLANKS = "\t\n\x0b\x0c\r "


def every_edit(symbols):
    """The least (cost, audit), by trying all edits of rows and up to two inserts anywhere."""
    best = None
    gaps = itertools.product(range(3), repeat=len(symbols) + 1)
    for inserts, rows in itertools.product(gaps, itertools.product("KRD", repeat=len(symbols))):
        if any(s == "-" and e != "D" for s, e in zip(symbols, rows)):
            continue
        audit = "".join("I" * n + e for n, e in zip(inserts, rows)) + "I" * inserts[-1]
        cost = sum(2 * (e == "R") + 3 * (e == "D") + (s.isupper() and e != "D") for s, e in zip(symbols, rows)) + 2 * sum(inserts)
        if best and (cost, audit) >= best:
            continue
        # Each place takes the role of the row, or either of two.
        places = ["*" * n + ("" if e == "D" else "*" if e == "R" else s.lower()) for n, e, s in zip(inserts, rows, symbols)]
        shape = "".join(places) + "*" * inserts[-1]
        if any(WANTED.fullmatch("".join(made)) for made in itertools.product(*["ua" if c == "*" else c for c in shape])):
            best = (cost, audit)
    return best


def plain(symbols):
    """The same row by row from the end, with whole audits."""
    left = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    step = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    for s in reversed(symbols):
        new = {}
        for start in range(4):
            options, state, extra = [], start, s.isupper()
            for k in range(3):
                moves = [(3, "D", state)]
                if s != "-":
                    moves += [(extra, "K", step[s.lower(), state])] if (s.lower(), state) in step else []
                    moves += [(2 + extra, "R", step[r, state]) for r in "ua" if (r, state) in step]
                options += [(c + 2 * k + left[t][0], "I" * k + e + left[t][1]) for c, e, t in moves]
                state = 3 if state == 2 else 2
            new[start] = min(options)
        left = new
    return left[0]


def test_base_matrices_against_every_edit():
    own = repair.Grammar([])
    for n in range(3):
        for symbols in itertools.product("suaxSU-", repeat=n):
            assert own.solve("".join(symbols)) == every_edit("".join(symbols))
    rnd = random.Random(0)
    for _ in range(25):
        symbols = "".join(rnd.choice("suaxSUAX-") for _ in range(3))
        assert own.solve(symbols) == every_edit(symbols) == plain(symbols)


def test_rules_do_not_change_audits():
    rnd = random.Random(1)
    rules = ["ua", "\ue000\ue000", "uu", "\ue001\ue002", "xU", "-u", "\ue003\ue001", "aa", "\ue004\ue005", "\ue007\ue007"]
    own = repair.Grammar(rules)
    for n in (1, 5, 20, 60):
        for _ in range(120):
            symbols = "".join(rnd.choice(("ua", "uaua", "uu", "xU-u", "s", "aa", rnd.choice("suaxSUAX-"))) for _ in range(n))
            assert own.solve(symbols) == plain(symbols)
    long = "uaUxa-us" * 50_000
    cost, audit = own.solve(long)
    assert cost > 0 and len(audit.replace("I", "")) == len(long)


def whole(rows):
    """The result of the contract in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        own = convs.setdefault(conv, [])
        role, text = [" " if v is None else v for v in (role, text)]
        kind = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns, faults, symbols, seen = [t for t, *_ in own if t is not None], [], "", set()
        for _, role, text in own:
            end = text.strip(BLANKS)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = plain(symbols)
        lines, state, left = [], 0, iter(own)
        for edit in audit:
            _, role, text = next(left) if edit != "I" else (None, None, "")
            if edit != "D":
                role = role if edit == "K" else "assistant" if state == 2 else "user"
                state = 1 if role[0] == "s" else 2 if role[0] == "u" else 3
                lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, kind string, symbol int"


def made(n=150, seed=2):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rnd.randrange(12)):
            role = rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", None, "", "User", "agent"])
            rows.append((rnd.choice([conv, conv, conv, None]), rnd.choice([turn, turn, turn, None, turn * 3]), role, rnd.choice(["Hi.", "Hi", " \n", None, "Why?  ", "été !", "a. b", "x "])))
    return rows + rows[:40]


@pytest.mark.parametrize("rounds", [0, 3])
def test_report_against_a_plain_version(spark, rounds):
    rows = made()
    got = repair.report(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), rounds, 4)
    assert sorted(map(tuple, got.collect()), key=repr) == whole(rows)


def test_repaired_rows_and_empty_tables(spark):
    rows = made(40, 5)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    held = {r["conv_id"]: [] for r in table.collect()}
    for r in sorted(repair.repaired(table).collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["nth"])):
        assert r["nth"] == len(held[r["conv_id"]])
        held[r["conv_id"]].append(r["role"] + ":" + r["text"])
    want = {r[0]: r[-1] for r in whole(rows)}
    assert {c: hashlib.sha256("\n".join(v).encode()).hexdigest() for c, v in held.items()} == want
    assert repair.report(table.limit(0)).count() == 0 and repair.repaired(table.limit(0)).count() == 0


def test_grammar_has_frequent_pairs(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for i in range(60) for t in range(12)]
    found = repair.sequences(repair.with_faults(repair.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    rules = repair.grammar(found, 3, 2)
    assert rules[0] == "ua" and len(rules) <= 6 and any("\ue000" in r for r in rules)
