"""The numbered operators against brute force, with nulls, empty tables, ties, repeats and clashing columns."""

import hashlib
import json
import math
import os
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.llm import chat, decontaminate, jaccard, kernels, licenses, packing, quality, secrets, topk, toxicity, urls
from chunkloom.llm.common import hot_left_join
from chunkloom.llm.components import components
from chunkloom.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def docs(spark, texts, first=0):
    """Documents with columns whose names clash with the operators' own."""
    rows = [(first + i, t, "en", "s", len(t or ""), 1.0, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC + ", score double, items string")


def made_texts(seed=0, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 4, 5, 30, 60, 200]))) for _ in range(n)]
    out = list(base)
    for t in base:
        own = t.split()
        for _ in range(rnd.randrange(3)):
            copy = list(own)
            for _ in range(rnd.randrange(4)):
                if copy:
                    copy[rnd.randrange(len(copy))] = rnd.choice(words)
            out.append(" ".join(copy))
    return out + [None, "", "  \n", "A b C d", "a B c D", "é" * 5000 + " x" * 300]


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "pages", "documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    wanted = con.execute("select " + ", ".join(columns) + f" from ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, wanted))


def test_topk_with_ties_repeats_and_bad_vectors(spark):
    rnd = random.Random(1)
    rows = [(i, [float(rnd.randrange(3)) for _ in range(4)], 0) for i in range(120)] + [(200 + i, [1.0, 1.0, 1.0, 1.0], 0) for i in range(60)]
    bad = [(500, None, 0), (520, [1.0, None, 0.0, 0.0], 0), (540, [float("nan")] * 4, 0), (560, [float("inf")] * 4, 0), (580, [1.0, 2.0], 0), (None, [1.0] * 4, 0), (0, rows[0][1], 0)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score int")
    got = {}
    vectors = df.where(topk.usable(F.col("embedding"))).select("vec_id", topk.integers(F.col("embedding")).alias("v"), F.lit(1).alias("cls"), F.lit("x").alias("cell"))
    for r in topk.search(vectors, F.col("vec_id") % 20 == 0, 5, block=16, group=4).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ok = {i: np.floor(np.array(v) * 64).astype(int) for i, v, _ in rows}
    want = {}
    for q in ok:
        if q % 20 == 0:
            scored = sorted((-int(ok[q] @ ok[d]), d) for d in ok if d != q)[:5]
            want[q] = [(k + 1, d, -s) for k, (s, d) in enumerate(scored)]
    assert {q: sorted(v) for q, v in got.items()} == want
    assert topk.top_scores(df.limit(0)).count() == 0


def test_topk_with_many_lengths_and_little_sample(spark, monkeypatch):
    monkeypatch.setattr(topk, "SAMPLE_BYTES", 4000)
    monkeypatch.setattr(topk, "SPARE", 3)
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.integers(-9, 9, 1 + i % 40 if i % 3 else 8)], "c") for i in range(600)] + [(1000, [1.0] * 30000, "long"), (1001, [2.0] * 30000, "long")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = {}
    vectors = df.select("vec_id", topk.integers(F.col("embedding")).alias("v"))
    for r in topk.search(vectors, F.col("vec_id") % 20 == 0, 4, block=25, group=7).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for i, v, _ in rows:
        if i % 20 == 0:
            same = sorted((-int(4096 * (np.array(v) @ np.array(w))), j) for j, w, _ in rows if j != i and len(v) == len(w))[:4]
            assert sorted(got.get(i, [])) == [(k + 1, j, -s) for k, (s, j) in enumerate(same)]


def test_patterns_place_every_piece():
    rnd = random.Random(2)
    for _ in range(20):
        h = {rnd.randrange(1, 65): rnd.randrange(1, 500) for _ in range(30)}
        packs = packing.patterns(h, 64)
        assert all(sum(p) <= 64 for _, p in packs)
        placed = {}
        for n, p in packs:
            for length in p:
                placed[length] = placed.get(length, 0) + n
        assert placed == h


def test_encoder_is_the_tokenizer():
    e = packing.encoder(packing.tokenizer_path())
    texts = ["Plain words, it's 42!", "É ÀÇ naïve ² ½ a\x85b\xa0c \x1c d", "İstanbul ΣΑΣ", "<|endoftext|> x <|startoftext|>", "e\u0301 中文 ab１２", "I'LL don't 'S", "", "\n\t ", "x" * 3000]
    assert [e.encode(t) for t in texts] == [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_encoder_at_every_character_below_u0250():
    e = packing.encoder(packing.tokenizer_path())
    for c in map(chr, range(0x250)):
        for t in (f"a{c}b", f"{c}", f"A{c} 1{c}2"):
            assert e.encode(t) == np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_encoder_asks_the_model_once_for_a_word_of_a_slice(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN", 3)
    e = packing.Encoder(packing.tokenizer_path())
    texts = ["we're 'start ''s it's'", "a b c d e f g " * 50, None, "x" * 200 + " y", "'", "s", "²3 \x85é\xa0'LL'", "b" * 64 + " " + "b" * 65] * 3
    want = [np.array(e.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    asked, kept = [], e._put
    monkeypatch.setattr(e, "_put", lambda words: asked.extend(words) or kept(words))
    assert e.encode_all(texts) == want
    assert len(set(w for w in asked if len(w) <= packing.LONGEST)) == sum(len(w) <= packing.LONGEST for w in asked)
    assert e.known == 3
    assert e.encode_all(texts[::-1]) == want[::-1] and [e.encode(t) for t in texts] == want


def test_packing_is_gapless_and_whole(spark):
    texts = made_texts(3) + ["word " * 7000, "x"]
    rows = packing.packed(docs(spark, texts)).collect()
    e = packing.encoder(packing.tokenizer_path())
    ids = {i: e.encode(t) + np.array([1], "<u4").tobytes() for i, t in enumerate(texts)}
    at = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == at.get(r["doc_id"], 0) and r["doc_tokens"] == len(own) // 4
        at[r["doc_id"]] = r["start"] + r["length"]
        assert r["ids_crc32"] == zlib.crc32(own[4 * r["start"] : 4 * at[r["doc_id"]]])
    assert at == {i: len(v) // 4 for i, v in ids.items()}
    fill = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill.get(r["sequence_id"], 0)
        fill[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(fill.values()) <= 2048 and sorted(fill) == list(range(len(fill)))
    assert packing.packed(docs(spark, ["a"]).limit(0)).count() == 0


def test_sequences_hold_every_id_once_and_are_padded(spark):
    texts = made_texts(4, 20) + ["word " * 7000, None, "x " * 2047, "x " * 2048, "日本語 🙂 " * 900]
    table = docs(spark, texts)
    table = table.union(table.where("doc_id < 9")).union(table.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    e = packing.encoder(packing.tokenizer_path())
    want = sorted(e.encode(r["text"]) + np.array([1], "<u4").tobytes() for r in table.select("text").collect())
    parts, n = {}, 0
    for r in packing.sequences(table.repartition(3), pad_id=7).collect():
        ids, at = np.frombuffer(r["ids"], "<u4"), 0
        assert len(ids) == 2048 and (ids[r["filled"] :] == 7).all()
        for p in r["pieces"]:
            assert p["offset"] == at
            at += p["length"]
            parts.setdefault((p["doc_id"], p["start"], p["doc_tokens"]), []).append(ids[p["offset"] : at].tobytes())
        assert at == r["filled"] > 0
        n += 1
    assert sum(map(len, want)) <= 8192 * n < sum(map(len, want)) + 8192 * 2
    # Rows with one doc_id have equal texts here, so any of its pieces at a start continues the one before.
    got = [b for k in parts if not k[1] for b in [b"".join(parts[k[0], s, k[2]][i] for s in range(0, k[2], 2048)) for i in range(len(parts[k]))]]
    assert sorted(got) == want
    assert packing.unsqueeze(packing.squeeze(np.array([0, 65536, 2**32 - 1], "<u4").tobytes()), 3) == np.array([0, 65536, 2**32 - 1], "<u4").tobytes()


def test_ranks_with_small_buckets(spark):
    table = spark.createDataFrame([(i, 0, 5 if i % 3 else 7) for i in range(300)], "doc_id long, start long, length long")
    found = packing.ranked(table, {5: 200, 7: 100}, ["doc_id", "start"], most=9).collect()
    for length, n in ((5, 200), (7, 100)):
        assert sorted(r["rank"] for r in found if r["length"] == length) == list(range(n))


def brute_licenses(text):
    words = [w for w in re.split(r"[^a-z0-9]+", (text or "").lower()) if w]
    held = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    out = set()
    for name, template in licenses.TEMPLATES:
        own = [w for w in re.split(r"[^a-z0-9]+", template.lower()) if w]
        want = {tuple(own[i : i + 5]) for i in range(len(own) - 4)}
        if want <= held:
            out.add(name)
    return out


def test_license_scan_finds_whole_templates(spark):
    rnd = random.Random(4)
    texts = [None, "", "license", "under"]
    for name, template in licenses.TEMPLATES:
        for before in (0, 1, 7, 50):
            texts.append(" ".join(["pad%d" % rnd.randrange(99) for _ in range(before)]) + " " + template.upper() + " tail words here")
    got = {}
    for r in licenses.matches(docs(spark, texts)).collect():
        if r["containment"] == 1.0:
            got.setdefault(r["doc_id"], set()).add(r["license"])
            words = [w for w in re.split(r"[^a-z0-9]+", texts[r["doc_id"]].lower()) if w]
            assert words[r["first_word"]] == re.split(r"[^a-z0-9]+", dict(licenses.TEMPLATES)[r["license"]].lower())[0]
    assert got == {i: brute_licenses(t) for i, t in enumerate(texts) if brute_licenses(t)}
    assert licenses.matches(docs(spark, ["a"]).limit(0)).count() == 0


def test_chat_round_trip(spark):
    rnd = random.Random(5)
    bits = ["<|im_end|>", "<|im_start|>", "<\\|", "<", "|", "\\", "\n", "assistant", "%0A", "é", "😀", ""]
    rows = [(c, t, rnd.choice(["user", "assistant", "a\nb%<|", None]), rnd.choice([None, "".join(rnd.choice(bits) for _ in range(9))])) for c in range(30) for t in range(rnd.randrange(1, 6))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.report(df).collect()}
    assert set(got) == {c for c, *_ in rows} | {-1}
    for c, r in got.items():
        own = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == c), key=lambda x: (x[1], x[2] or "", x[3] or ""))] if c >= 0 else [("user", chat.EXTRA), ("assistant", chat.EXTRA)]
        spoken = "".join(t for role, t in own if role == "assistant")
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(spoken))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
    assert chat.report(df.limit(0)).count() == 1


def test_layouts_by_fingerprint(spark):
    records = [
        ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"instruction": "i", "input": "x", "output": "o"}, [("user", "i\n\nx"), ("assistant", "o")]),
        ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
        ({"something": 1}, None),
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(records)], "id int, j string").select("id", F.parse_json("j").alias("record"))
    got = {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in chat.turns(df).select("id", "turns").collect()}
    assert got == {i: t for i, (_, t) in enumerate(records)}
    # The same as structs in which absent fields are null.
    kind = "prompt string, completion string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, conversations array<struct<`from`:string,value:string>>, something int"
    typed = spark.createDataFrame([(i, json.dumps(r)) for i, (r, _) in enumerate(records)], "id int, j string").select("id", F.from_json("j", kind).alias("record"))
    same = chat.turns(typed).select("id", "turns", "fingerprint").collect()
    assert {r["id"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in same} == got
    marks = {r["id"]: r["fingerprint"] for r in chat.turns(df).select("id", "fingerprint").collect()}
    assert {r["id"]: r["fingerprint"] for r in same} == marks and len(set(marks.values())) == len(records)


def test_chat_with_null_ids_clashing_columns_and_the_added_id(spark):
    rows = [(None, 0, "user", "a", 1, "x"), (None, 1, "assistant", "b", 2, "y"), (-1, 5, "assistant", "mine", 3, "z"), (4, None, "assistant", "x" * 200_000, 4, "w"), (4, None, "assistant", "x" * 200_000, 4, "w")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, record int, turns string")
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.report(df).collect()}
    assert got == {None: (2, 1), -1: (3, len(chat.EXTRA) + 4), 4: (2, 400_000)}


def brute_jaccard(texts):
    sets = []
    for t in texts:
        w = [x for x in re.split(r"[ \t\n\v\f\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in enumerate(sets)}


@pytest.mark.parametrize("block, guides", [(jaccard.BLOCK, jaccard.GUIDES), (3, jaccard.GUIDES), (3, 0.5)])
def test_jaccard_join_keeps_every_component(spark, monkeypatch, block, guides):
    texts = made_texts(6, 80)
    real = jaccard.links
    monkeypatch.setattr(jaccard, "GUIDES", guides)
    monkeypatch.setattr(jaccard, "links", lambda *a, **k: real(*a, **{**k, "block": block}))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs(spark, texts)).collect()}
    assert got == brute_jaccard(texts)
    assert jaccard.join(docs(spark, ["a"]).limit(0)).count() == 0


def test_one_row_of_each_component_with_null_and_repeated_ids(spark):
    import corpus_pipeline as P

    long = [f"{c}{i}" for c in "abcd" for i in range(40)]
    a, b, c, d = (long[k : k + 40] for k in range(0, 160, 40))
    near = lambda words, k: " ".join([*words[:-k], *(f"new{k}{i}" for i in range(k))])
    rows = [
        (1, " ".join(a)), (1, " ".join(b)),  # one id, two texts
        (2, near(a, 1)), (2, near(b, 1)),
        (3, " ".join(c)), (None, near(c, 2)), (4, "x y " + near(c[2:], 2)),  # 3 and 4 are joined by the row without an id alone
        (None, " ".join(d)), (None, " ".join(d)), (None, near(d, 1)),  # no id in the component
        (5, "own words"), (5, "own words"), (None, None), (None, ""), (6, " \t"), (6, " \t"),
    ]
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)
    joined = sorted((r["component_id"] for r in jaccard.join(table).collect()), key=str)
    assert joined == [1] * 4 + [3] * 3 + [5] * 2 + [6] * 2 + [None] * 5
    root = {i: r for i, (_, r) in brute_jaccard([t for _, t in rows]).items()}
    got = P.drop_near_duplicates(spark, table, DATA).collect()
    for k in sorted(set(root.values())):
        own = [rows[i] for i in root if root[i] == k]
        texts = {t for _, t in own}
        stay = [(r["doc_id"], r["text"]) for r in got if r["text"] in texts]
        if (own[0][1] or "").strip():
            assert len(stay) == 1 and stay[0] in own and stay[0][0] == min((i for i, _ in own if i), default=None)
    assert sorted(((r["doc_id"], r["text"]) for r in got if not (r["text"] or "").strip()), key=str) == sorted(((i, t) for i, t in rows if not (t or "").strip()), key=str)


@needs_data
def test_jaccard_join_on_the_table(spark):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    order = sorted(texts)
    want = brute_jaccard([texts[i] for i in order])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(table).collect()}
    assert got == {order[i]: (n, order[c]) for i, (n, c) in want.items()}


def test_pieces_of_linked_sets_agree():
    rnd = random.Random(7)
    for _ in range(300):
        n = rnd.randrange(6, 300)
        a = {rnd.getrandbits(64) for _ in range(n)}
        b = set(a)
        for x in rnd.sample(sorted(a), rnd.randrange(0, n // 12 + 1)):
            b.discard(x)
            b.add(rnd.getrandbits(64))
        if a != b and 100 * len(a & b) >= 85 * len(a | b):
            x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
            keys = [{int(k) for band in jaccard.bands(len(s)) for k in jaccard.piece_keys(s, band)} for s in (x, y)]
            assert keys[0] & keys[1]


def test_components(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(50)] + [(90, 91), (91, 90), (3, 3), (None, 4)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(51)}, 90: 90, 91: 90}


def test_url_rules_and_the_joined_path(spark):
    names = ["http://a.example.com/en/x", "http://WWW.example.com/en/", "x://notexample.com/en/", "http://com", "http://com/", "http://b.net/es/a?b#c", "http://b.net?/es/", "no scheme", None, "", "http://x.org/casino", "http://www.example.com/enx", "a://b.net/fr/://c", "http://poker.net/fr/"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(names)], "page_id long, url string, html string, host string")
    inline = {tuple(r) for r in urls.judge(pages).collect()}
    assert inline == {tuple(r) for r in urls.judge(pages, inline=0).collect()}
    rule = {r[0]: (r[3], r[4]) for r in inline}
    assert [rule[i][0] for i in range(len(names))] == ["example.com/en/", "www.example.com/en/", "com/", None, "com/", "net/es/", None, None, None, None, None, "com/", "net/fr/", "net/fr/"]
    assert rule[10] == (None, "block") and rule[8] == (None, "allow")
    assert urls.judge(pages.limit(0)).count() == 0


def brute_secrets(text):
    found = []
    for kind, p, least in (
        ("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6), ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)
    ):
        for m in re.finditer(p, text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                found.append((m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def test_secret_spans(spark):
    rnd = random.Random(8)
    random_key = "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(40))
    texts = [None, "", 'é Password : "abc123" x', "API_KEY=short", "apikey='longenough'", "AKIA" + "B" * 16, "AKIAB", "0123456789abcdef01234567é89abcdef", "ſecret=abcdef12", f"mein Schlüssel {random_key} ende", "averyveryverylongordinaryword " * 5, "token=token=abcdefgh", "secret" * 3 + "=zzzzzz"]
    rows = {r["doc_id"]: r for r in secrets.scan(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        base = brute_secrets(t)
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), t
        assert [s for s in rows[i]["spans"].split(",") if s and not s.startswith("random")] == base
    assert rows[9]["spans"] == f"random:{texts[9].index(random_key)}:{texts[9].index(random_key) + 40}" and rows[10]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(docs(spark, texts)).collect()}
    assert clean[9] == "mein Schlüssel [SECRET] ende" and clean[0] is None and clean[10] == texts[10]


@pytest.mark.parametrize("n", [1, 19, 200, 1100, 5000])
def test_tails_are_whole_at_any_length(n):
    terms = [math.comb(n, i) * 3**i * 47 ** (n - i) for i in range(n + 1)]
    for least in sorted({0, 1, n // 50, n * 3 // 50, n * 3 // 50 + 1, n // 12, n // 5, n * 62 // 100, n}):
        assert secrets.at_least(n, least, 0.06) == pytest.approx(float(Fraction(sum(terms[least:]), 50**n)), rel=1e-8, abs=1e-300)


@pytest.mark.parametrize("n", [1000, 1070, 2000, 100_000, 1_000_000])
def test_unbroken_runs_of_any_length(spark, n):
    rnd = random.Random(n)
    blob = "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
    words = "".join(rnd.choices(["under", "score", "Camel", "Case", "number", "some7", "-", "_"], k=n))[:n]
    quiet = "".join(rnd.choices(["understand", "Numbering"], [9, 1], k=n))[:n]  # fewer changes than usual
    assert secrets.unlike_text(quiet) > 0.9 and secrets.unlike_text("a" * n) == 1.0 and secrets.unlike_text(blob) < 1e-99
    # A quiet run is no discovery, whether alone or beside a random one.
    rows = {r["doc_id"]: r["spans"] for r in secrets.scan(docs(spark, [blob, words, "z" * n, f"é {blob} {quiet} ende", quiet])).collect()}
    assert rows == {0: f"random:0:{n}", 1: "", 2: "", 3: f"random:2:{n + 2}", 4: ""}


ENCODINGS = {
    "hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "letters": "abcdefghijklmnopqrstuvwxyz", "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
NAMES = (
    "getHTTPResponseCode2ValueX src/main/java/com/example/App MAX_CONNECTION_POOL_SIZE_V2 user_id_2_session_id_5_tok covid19-sars-cov2-b1-617-2 internationalization_of_things "
    "Donaudampfschifffahrtsgesellschaft anticonstitutionnellement electroencefalografista 2024-01-01-000123-4567890 00000000000000000000 12345678901234567890 "
    "abcdefghijklmnopqrstuvwxyz --------------------- XMLHttpRequestEventTarget very_long_function_name_for_unit_tests AbstractSingletonProxyFactoryBean"
).split()


@pytest.mark.parametrize("name", sorted(ENCODINGS))
def test_random_strings_are_found_by_encoding_and_length(name):
    rnd = random.Random(12)
    for n, least in ((32, 0.95), (64, 0.95), (400, 0.95)):
        runs = ["".join(rnd.choices(ENCODINGS[name], k=n)) for _ in range(200)]
        assert sum(bool(secrets.random_spans(r, [(0, n)], [])) for r in runs) >= least * 200, n


def test_names_paths_and_numbers_are_no_secrets():
    text = " ".join(NAMES)
    runs = [(text.index(x), text.index(x) + len(x)) for x in NAMES]
    assert secrets.random_spans(text, runs, []) == [] and all(not secrets.random_spans(x, [(0, len(x))], []) for x in NAMES)


def test_false_discovery_control():
    assert secrets.discoveries([0.9, 0.00001, 0.5, 0.002], 0.01) == [False, True, False, True]
    assert secrets.discoveries([]) == []


def brute_hits(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    own = words(text)
    hit, found = set(), set()
    for i, t in items:
        w = words(t)
        for win in [w[k : k + 10] for k in range(max(1, len(w) - 9))] if w else []:
            for at in range(len(own) - len(win) + 1):
                if own[at : at + len(win)] == win:
                    hit |= set(range(at, at + len(win)))
                    found.add(i)
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("most", [decontaminate.MAX_ITEM_BYTES, 400, 120])  # one automaton, and parts after one another
def test_decontamination(spark, most):
    rnd = random.Random(9)
    items = [(i, " ".join(rnd.choice("a b c d é1 F".split()) for _ in range(rnd.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(20)] + [(99, None), (100, "!!"), (7, "é é é"), (None, "a b c d")]
    texts = [" ".join(rnd.choice("a b c d É1 é1 f".split()) for _ in range(40)) for _ in range(30)] + [None, "", "a-b,c" * 20] + [f"x, {t} y" for _, t in items if t]
    # Rows that share an id, or have none, are judged apart.
    ids = [None if i % 7 == 6 else i // 2 for i in range(len(texts))]
    table = spark.createDataFrame([(k, t, float(i), str(i)) for i, (k, t) in enumerate(zip(ids, texts))], "doc_id long, text string, row double, ranges string")
    wanted = spark.createDataFrame(items, "item_id long, text string")
    usable = [x for x in items if x[0] is not None]
    got = decontaminate.report(table, wanted, max_item_bytes=most).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=repr)
    assert got == sorted(((k, *brute_hits(t, usable)) for k, t in zip(ids, texts)), key=repr)
    kept = decontaminate.clean(table, wanted, max_item_bytes=most)
    assert kept.columns == table.columns
    assert sorted(map(repr, kept.collect())) == sorted(repr(r) for r in table.collect() if not brute_hits(r["text"], usable)[1])
    for r in decontaminate.hits(table, wanted, max_item_bytes=most).where("size(ranges) > 0").collect():
        own = [t for k, t in zip(ids, texts) if k == r["doc_id"]]
        cut = [[decontaminate.normalise(t[a["start"] : a["stop"]]) for a in r["spans"]] for t in own if t]
        assert any(c == [decontaminate.normalise(t)[a["first"] : a["stop"]] for a in r["ranges"]] for t, c in zip([t for t in own if t], cut))
    assert decontaminate.report(table.limit(0), wanted, max_item_bytes=most).count() == decontaminate.clean(table.limit(0), wanted, max_item_bytes=most).count() == 0
    assert decontaminate.clean(table, wanted.limit(0), max_item_bytes=most).count() == len(texts)


def test_word_offsets_point_into_the_text():
    text = "Ab, é9--x"
    assert [text[a:b] for a, b in decontaminate.offsets(text, [(0, 1), (1, 2), (1, 3)])] == ["Ab", "é9", "é9--x"]
    assert decontaminate.offsets(None, []) == []


def test_word_hashes_do_not_depend_on_blocks():
    rnd = random.Random(11)
    words = ["w" * rnd.randrange(1, 60) + str(i % 97) for i in range(20000)] + ["x" * (3 * kernels.CHUNK_BYTES + 5), "end"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends = kernels.spans(data, np.array([0, len(data)]), kernels.WORDS)
    found = kernels.span_hashes(data, starts, ends)
    one = lambda w: int(kernels.span_hashes(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0])
    assert [int(h) for h in found[:500]] == [one(w) for w in words[:500]] and [int(h) for h in found[-2:]] == [one(w) for w in words[-2:]]


def held_out(rows, labels, least):
    pairs = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / max(1, len(good) * len(bad)) >= least


@needs_data
@pytest.mark.parametrize("name,label,cut", [("op8_toxicity", "toxic", 0.3), ("op10_quality", "quality", 0.5)])
def test_classifiers_on_held_out_rows(spark, name, label, cut):
    data = DATA.replace("0.001", "0.01")
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = QUERIES[name](spark, data).collect()
    assert all(r["predicted"] == (r["score"] >= cut) for r in rows) and len(rows) == 1000
    assert held_out(rows, labels, 0.99 if label == "quality" else 0.75)


@pytest.mark.parametrize("op,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifiers_without_labels_or_texts(spark, op, label):
    labels = spark.createDataFrame([(1, 1), (None, 1), (2, None), (1, 0)], f"doc_id long, {label} int")
    rows = op.classify(docs(spark, [None, "", "some words", "some words"]), labels).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
    assert op.classify(docs(spark, ["a"]).limit(0), labels.limit(0)).count() == 0


def brute_logits(train, texts, bits=quality.BITS, alpha=0.5, beta=1.0, l1=1e-3, l2=1e-3):
    """Features as dicts and coordinate-wise updates, one at a time."""
    mask, m = (1 << 64) - 1, lambda x: int(kernels.mix(np.array([x & ((1 << 64) - 1)], np.uint64))[0])
    base, value = int(kernels._BASE), [int(x) for x in kernels._BYTE_VALUE]

    def word_hash(w):
        return m(sum(value[b] * pow(base, i, 1 << 64) for i, b in enumerate(w)) + len(w))

    def feats(text):
        words = re.findall(rb"[A-Za-z0-9\x80-\xff]+|[^ \t\n\v\f\rA-Za-z0-9\x80-\xff]+", (text or "").encode())
        h = [word_hash(w) for w in words]
        shape = []
        for w, x in zip(words, h):
            up, dig = len(re.findall(rb"[A-Z]", w)), len(re.findall(rb"[0-9]", w))
            sort = 3 if dig == len(w) else 0 if up == 0 else 1 if up == 1 and len(w) > 1 else 2
            shape.append(m(sort + int(quality._SHAPE)) if re.match(rb"[A-Za-z0-9\x80-\xff]", w) else x)
        keys = list(h)
        for i in range(len(h) - 1):
            keys.append(int(quality._REPEAT) if h[i] == h[i + 1] else (h[i] * int(quality._PAIR) + h[i + 1]) & mask)
            keys.append(((shape[i] * int(quality._PAIR) + shape[i + 1]) & mask) ^ int(quality._SHAPE))
        out = {}
        for k in keys:
            f = m(k) >> (64 - bits)
            out[f] = out.get(f, 0) + quality.SCALE / len(keys)
        return out | {"one": 1.0}

    z, n = {}, {}

    def weight(f):
        if abs(z.get(f, 0)) <= l1:
            return 0.0
        return -(z[f] - math.copysign(l1, z[f])) / ((beta + math.sqrt(n[f])) / alpha + l2)

    train = [(feats(t), y) for t, y in train]
    for _ in range(4):
        for x, y in train:
            w = {f: weight(f) for f in x}
            p = 1 / (1 + math.exp(-sum(w[f] * v for f, v in x.items())))
            for f, v in x.items():
                g = (p - y) * v
                z[f] = z.get(f, 0) + g - (math.sqrt(n.get(f, 0) + g * g) - math.sqrt(n.get(f, 0))) / alpha * w[f]
                n[f] = n.get(f, 0) + g * g
    return [sum(weight(f) * v for f, v in feats(t).items()) for t in texts]


def test_quality_against_brute_force(spark):
    rnd = random.Random(13)
    good, bad = "The house stands here . We walked , then ate".split(), "BUY now now !!! 99 $ click 4u zz".split()
    texts = [" ".join(rnd.choices(good if i % 2 else bad, k=rnd.choice([1, 5, 40]))) for i in range(60)] + ["", None, "é É 7"]
    labels = [(i, i % 2) for i in range(40)] + [(None, 1), (41, None)]
    rows = {r["doc_id"]: r for r in quality.classify(docs(spark, texts).repartition(5), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in range(len(texts))}
    order = [r["i"] for r in spark.range(40).withColumnRenamed("id", "i").orderBy(F.xxhash64("i"), "i").collect() if not held[r["i"]]]
    want = brute_logits([(texts[i], i % 2) for i in order], texts)
    for i, z in enumerate(want):
        assert rows[i]["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4), texts[i]
        assert rows[i]["held_out"] == held[i] and rows[i]["predicted"] == (rows[i]["score"] >= 0.5)


def test_quality_training_is_bounded_and_repeatable(spark):
    texts = ["good words here " * (1 + i % 5) if i % 2 else "bad " * (1 + i % 7) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    table = docs(spark, texts)
    twice = [quality.fit(table.repartition(n), labels).weights for n in (2, 7)]
    assert (twice[0] == twice[1]).all()
    assert not (quality.fit(table, labels, most=1).weights == twice[0]).all()
    long = "Some words, and more. " * 60000
    f = lambda block: np.sort(np.concatenate([x for x, _ in quality.features(np.frombuffer(long.encode(), np.uint8), np.array([0, len(long)]), block=block)]))
    assert (f(1 << 30) == f(1000)).all() and quality.counted(np.frombuffer(long.encode(), np.uint8))[2] == len(f(1000))


def brute_toxic(text, terms):
    """The grammar's features by rules, clause by clause, without transducers."""
    words_of = {(t, whole): (kind, w) for t, whole, kind, w in terms}
    out = dict.fromkeys(("open", "aimed", "off", "most", "menace", "reported"), 0.0)
    for clause in re.split(r"[.!?;:\n]", (text or "").lower()):
        words, negated, reported, threat, after = [w for w in re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause)], 0, False, 0, False
        insults = menace = 0.0
        aimed = False
        for w in words:
            plain = w.replace("'", "")
            kind, weight = max((v for (t, whole), v in words_of.items() if (w == t if whole else w.startswith(t))), key=lambda v: v[1], default=("", 0.0))
            was, after = after, False
            if plain in toxicity.NEGATIONS:
                negated, threat = 4, max(0, threat - 1)
            elif plain in toxicity.REPORTS:
                reported, threat = True, max(0, threat - 1)
            elif kind and (negated or reported):
                out["off"] += weight
                out["reported"] += weight if reported else 0
                threat = max(0, threat - 1)
            elif kind == "insult":
                insults, after, threat = insults + weight * (0.5 if was else 1), True, max(0, threat - 1)
            elif kind == "threat":
                threat = 3
            elif plain in toxicity.TARGETS:
                aimed, menace, threat = True, menace + (threat > 0), 0
            else:
                threat = max(0, threat - 1)
            negated = max(0, negated - 1)
        out["aimed" if aimed else "open"] += insults
        out["menace"] += menace
        out["most"] = max(out["most"], insults + menace)
    return [math.log1p(v) for v in out.values()] + [float(out["open"] + out["aimed"] + out["menace"] > 0)]


def test_grammar_against_rules():
    rnd = random.Random(14)
    terms = (*toxicity.seed_terms(), ("schurk", False, "insult", 2.0))
    found = toxicity.matcher(terms)
    bits = "you idiot moron kill hurt not never said they house the schurken . ! isn't scum a b them".split()
    for _ in range(500):
        text = " ".join(rnd.choices(bits, k=rnd.randrange(0, 25)))
        assert list(toxicity.features(text, found)) == pytest.approx(brute_toxic(text, terms)), text


def test_toxicity_does_not_depend_on_partitions(spark):
    rnd = random.Random(15)
    words = [f"wort{c}" for c in "abcdefghij"]
    texts = [" ".join(rnd.choices(words, k=30) + (["boshaftig", "boshaftes"] if i % 4 == 0 else [])) for i in range(200)] + ["worta wortb boshaftig"] * 30
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(200 + i, 1) for i in range(30)], "doc_id long, toxic int")
    table = docs(spark, texts)
    first, second = (toxicity.fit(table.repartition(n), labels) for n in (3, 8))
    assert first == second and any(t[0].startswith("bosh") for t in first.terms)


def test_grammar_sets_off_negation_and_reports():
    found = toxicity.matcher(tuple(toxicity.seed_terms()))
    plain, aimed, negated, reported = (toxicity.features(t, found) for t in ("an idiot here", "you are an idiot", "he is not an idiot", "she said idiot"))
    assert plain[0] > 0 and plain[1] == 0 and aimed[1] > 0
    assert negated[2] > 0 and negated[0] == negated[1] == 0 and reported[2] > 0
    assert not toxicity.features("idiotic notions", toxicity.matcher((("idiot", True, "insult", 1.0),))).any()


@needs_data
def test_pipeline_against_its_parts(spark):
    import corpus_pipeline as P

    table = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {r["doc_id"]: r["text"] for r in P.keep_quality(spark, table, DATA).collect()}
    order = sorted(kept)
    components_of = brute_jaccard([kept[i] for i in order])
    kept = {i: kept[i] for k, i in enumerate(order) if components_of[k][1] == k}
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    kept = {i: t for i, t in kept.items() if not brute_hits(t, items)[4]}
    e = packing.encoder(packing.tokenizer_path())
    tokens = {}
    for i, t in kept.items():
        base = secrets.base_spans(t)
        tokens[i] = len(e.encode(secrets.redact(t, base))) // 4 + 1
    got = {}
    for r in P.run(spark, DATA).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == tokens


def test_pipeline_stages_keep_rows_and_columns_whole(spark):
    import corpus_pipeline as P

    base = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(40).collect()}
    names = DOC + ", score double, _id string, place int, n string, cls long, ranges int"
    rows = [(i, t, "en", None, None, 7.25, "own", 3, "n", 1, 2) for i, t in base.items()]
    rows += [(rows[0][0], None, *rows[0][2:]), (None, rows[1][1] + " more of it", *rows[1][2:]), (None, None, *([None] * 9)), rows[2], (5000, "", *rows[0][2:])]
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").where("text is not null").first()["text"]
    rows += [(rows[3][0], f"{item} {item}", *rows[3][2:])]  # shares its id with a clean row
    table = spark.createDataFrame(rows, names)
    before = table.collect()
    cut = lambda r: tuple(v for n, v in r.asDict().items() if n not in ("text", "n_chars"))
    for name, stage in P.STAGES[:4]:
        got = stage(spark, table, DATA)
        assert got.columns == table.columns, name
        kept = got.collect()
        if name == "secret_scan":
            assert sorted(map(repr, map(cut, kept))) == sorted(map(repr, map(cut, before)))
        else:
            assert {repr(r) for r in kept} <= {repr(r) for r in before}, name
        if name == "benchmark_decontamination":
            assert sum(r["doc_id"] == rows[3][0] for r in kept) == 1
        assert stage(spark, table.limit(0), DATA).count() == 0, name
    assert P.STAGES[4][1](spark, table, DATA).count() >= len(rows) and P.STAGES[4][1](spark, table.limit(0), DATA).count() == 0


def test_hot_and_null_keys_join_like_others(spark):
    rows = [(i, 1) for i in range(60)] + [(100 + i, None) for i in range(20)] + [(200, 2), (201, 3)]
    table = spark.createDataFrame(rows, "id long, k long")
    keyed = spark.createDataFrame([(1, "hot", 60), (2, "cold", 1), (9, "unused", 0)], "k long, v string, n long")
    wanted = sorted((i, k, {1: "hot", 2: "cold"}.get(k)) for i, k in rows)
    for total in (len(rows), 10**9):  # hot keys, and none; 1 row in 1000 makes any key of 82 rows hot
        got = hot_left_join(table, keyed, "k", "id", total).collect()
        assert sorted(((r["id"], r["k"], r["v"]) for r in got), key=lambda x: x[0]) == wanted
    assert hot_left_join(table.limit(0), keyed, "k", "id", 0).count() == 0
