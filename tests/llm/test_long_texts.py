"""Work that grows in proportion to one text's length, and rules and spans that tie."""

import hashlib
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import chat, decontaminate, secrets, topk, toxicity, urls


def seconds(run, text):
    began = time.process_time()
    run(text)
    return time.process_time() - began


@pytest.mark.parametrize("name", ["secrets", "toxicity", "decontaminate"])
def test_time_a_byte_stays_the_same(name):
    if name == "decontaminate":  # disjoint hits, one every 60 bytes
        found = decontaminate.automaton([(1, "one two three"), (2, "four five")], 3)
        unit, run = "here one two three and then é four five ends, with other words ", lambda t: decontaminate.offsets(t, decontaminate.scan(t, found)[1])
    elif name == "secrets":
        unit, run = "é some words and xk29qz7vbn3m8wq0rt5y then more of them follow here ", lambda t: secrets.scan_batch(pa.array([t]))
    else:
        found = toxicity.matcher((("idiot", True, "insult", 1.0),))
        unit, run = "you are an idiot. some words follow here, and then more of them\n", lambda t: toxicity.features(t, found)
    run(unit)
    short, long = (unit * (n // len(unit)) for n in (500_000, 2_000_000))
    assert seconds(run, long) / len(long) < 5 * seconds(run, short) / len(short)


def test_a_conversation_of_many_turns(spark):
    n = 40_000  # a fold that appends, or reading each text from the start, takes minutes
    role, text = lambda i: ("user", "assistant", "a%b")[i % 3], lambda i: f"<|im_end|> é😀 {i}" if i % 7 else ""
    df = spark.createDataFrame([(None, i, role(i), text(i)) for i in range(n)], "conv_id long, turn long, role string, text string")
    began = time.time()
    got = {r["conv_id"]: r for r in chat.report(df).collect()}[None]
    assert time.time() - began < 60
    spoken = "".join(text(i) for i in range(n) if role(i) == "assistant")
    assert (got["n_turns"], got["loss_chars"], got["loss_sha256"]) == (n, len(spoken), hashlib.sha256(spoken.encode()).hexdigest())
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{role(i)}\n{text(i)}\n" for i in range(n)).encode()).hexdigest()


def test_ranges_across_blocks_and_running_sums(spark):
    text = "".join(chr(97 + i % 26) if i % 5 else "😀" for i in range(5 * chat.BLOCK))
    at = [(0, 0), (0, 1), (chat.BLOCK - 1, chat.BLOCK + 1), (chat.BLOCK, chat.BLOCK), (7, 3 * chat.BLOCK + 9), (2 * chat.BLOCK, 3 * chat.BLOCK), (5 * chat.BLOCK - 2, 5 * chat.BLOCK), (5 * chat.BLOCK, 5 * chat.BLOCK)]
    df = spark.createDataFrame([(text, at, list(range(37))), ("", [], []), (None, None, None)], "text string, at array<struct<start:long,stop:long>>, v array<long>")
    got = df.select(chat.masked(F.col("text"), F.col("at"), lambda t: F.concat(t, F.lit("."))), chat.running(F.col("v"))).collect()
    assert got[0][0] == "".join(text[a:b] + "." for a, b in at) and got[0][1] == [i * (i + 1) // 2 for i in range(37)]
    assert tuple(got[1]) == ("", []) and tuple(got[2]) == (None, None)


def test_pieces_of_an_item_hold_its_windows():
    rnd = random.Random(6)
    for n in (0, 1, 9, 10, 11, 40, 200):
        text = " ".join(rnd.choice(("a", "bb", "cccc", "dddddddd" * 4)) for _ in range(n))
        for most in (0, 30, 90, 10_000):
            own = list(decontaminate.pieces(text, 10, most))
            assert {w for p in own for w in decontaminate.windows(p, 10)} == set(decontaminate.windows(text, 10))
            assert all(len(p) <= most or len(p.split()) <= 10 for p in own)


def test_a_benchmark_of_many_parts_hits_as_one_does(spark):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(i, " ".join(rnd.choices(words, k=rnd.choice((3, 30, 400))))) for i in range(12)], "item_id long, text string")
    own = [r["text"].split() for r in items.collect()]
    texts = [" ".join(rnd.choices(words, k=50) + (o := rnd.choice(own))[len(o) // 4 :] + rnd.choices(words, k=50)) for _ in range(40)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = (sorted(map(repr, decontaminate.hits(table, items, max_item_bytes=n).select("doc_id", "n_words", "ranges", "spans", "items").collect())) for n in (1 << 20, 900))
    assert one == many and len(one) == 40
    assert decontaminate.clean(table, items, max_item_bytes=900).count() == decontaminate.clean(table, items).count()


def test_random_spans_keep_clear_of_fixed_ones():
    rnd = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    parts = ["".join(rnd.choice(letters) for _ in range(40)) for _ in range(30)]
    text, runs = "é", []
    for p in parts:
        runs.append((len(text) + 1, len(text) + 41))
        text += f" {p}"
    whole = secrets.random_spans(text, runs, [])
    taken = [("assign", a + d, a + d + n) for (a, _), d, n in zip(runs[::3], (-1, 39, 40, 10, -1, 0, -1, 39, 41, 2), (1, 4, 1, 3, 200, 40, 2, 1, 3, 1))]
    assert len(whole) > 20
    assert secrets.random_spans(text, runs, taken) == [r for r in whole if not any(s < r[2] and r[1] < e for _, s, e in taken)]
    assert [text[a:b] for _, a, b in whole] == [p for p in parts if p in {text[a:b] for _, a, b in whole}]


def test_code_points_of_many_runs():
    text = "".join(f"é{'ß' * (i % 3)} xk29qz7vbn3m8wq0rt{i:03d} ü\n" for i in range(200))
    spans = secrets.scan_batch(pa.array([text]))[0][1]
    assert len(spans) > 150 and all(text[a:b].startswith("xk29qz7vbn3m8wq0rt") and b - a == 21 for _, a, b in spans)


def test_rules_that_tie_agree_on_both_paths(spark):
    rules = (
        urls.host_rule("allow", "com", "/ab"), urls.host_rule("block", "b.com", "/"), urls.host_rule("block", "a.com", "/x/"), urls.host_rule("allow", "a.com", "/y/"),
        urls.pattern_rule("allow", "aa"), urls.pattern_rule("block", "bbbb"), urls.pattern_rule("block", "cc"),
    )
    names = ["http://b.com/ab/x", "http://a.com/x/y/", "http://x.org/aa/bbbb", "http://x.org/bbbb-cc", "http://aa.b.com/bbbb", "http://com/ab"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(names * 2)], "page_id long, url string")
    inline, joined = ({tuple(r) for r in urls.judge(pages, rules, n).collect()} for n in (100, 0))
    assert inline == joined
    found = {r[0]: r[3:] for r in inline}
    assert found[0] == found[6] == ("b.com/", "block") and found[2] == (None, "allow") and found[3] == (None, "block")


def test_pivots_grow_with_the_rows(spark, monkeypatch):
    made = []
    begin = topk.Cells.__init__
    monkeypatch.setattr(topk.Cells, "__init__", lambda self, sample, pivots: made.append(pivots) or begin(self, sample, pivots))
    rnd = random.Random(3)
    rows = [(i, [rnd.random() for _ in range(4)]) for i in range(400)]
    assert topk.top_scores(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).count() == 400
    assert made == [20]
