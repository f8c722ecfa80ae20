"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest

from chunkloom.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))


def climb(nodes, fan):
    """The root, and for each node the (left, right) of each level."""
    paths, owners, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(level) > 1:
        up, up_owners = [], []
        for at in range(0, len(level), fan):
            run = level[at : at + fan]
            for k in range(len(run)):
                for i in owners[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha("".join(run)))
            up_owners.append([i for o in owners[at : at + fan] for i in o])
        level, owners = up, up_owners
    return level[0], paths


def plain(rows, fan):
    key = lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[1]))
    langs = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: sorted((r for r in rows if r[2] == g), key=key) for g in langs}
    below = {g: climb([leaf_of(r, r[1]) for r in own], fan) for g, own in trees.items()}
    root, above = climb([below[g][0] for g in langs], fan)
    out = []
    for g, over in zip(langs, above):
        for r, path in zip(trees[g], below[g][1]):
            changed = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and changed is not None:
                changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in changed)
            at = leaf_of(r, changed)
            for left, right in path + over:
                at = sha(left + at + right)
            out.append((r[0], leaf_of(r, r[1]), below[g][0], root, sha("".join(a + b for a, b in path + over)), at, at == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
TEXTS = ["Some Text", "ÄÖ Ab", "", None, "x" * 3000, "a b\nC", "-", "no capitals"]


def rows_of(n, lang=lambda i: ("en", "de", None, "é")[i % 4]):
    return [(i, TEXTS[i % len(TEXTS)], lang(i), None if i % 5 == 0 else "s", len(TEXTS[i % len(TEXTS)] or ""), 1.5, "x") for i in range(n)]


def made(spark, rows):
    """Documents with columns whose names clash with the operator's own."""
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank double, node string")


@pytest.mark.parametrize("n, fan, levels", [(1, 8, 3), (9, 8, 3), (150, 2, 2), (150, 3, 1), (90, 8, 3)])
def test_proofs_against_a_plain_tree(spark, n, fan, levels):
    rows = rows_of(n) + [(n, "One Only", "zz", "s", 8, 0.0, "x")]
    got = manifest.report(made(spark, rows), fan, levels)
    assert got.columns == list(COLUMNS)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, fan)


def test_repeated_and_null_ids_and_empty_tables(spark):
    same = [(7, "Same Row", "en", "s", 8, 0.0, "x")] * 20
    rows = same + [(7, "Other", "en", "s", 5, 0.0, "x"), (None, "No Id", "en", None, None, None, None), (None, None, None, None, None, None, None), (None, "No Id", "en", None, None, None, None)]
    got = manifest.report(made(spark, rows), 3, 1)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows, 3)
    assert manifest.report(made(spark, rows).limit(0)).count() == 0


def test_only_changed_documents_fail(spark):
    rows = rows_of(100)
    got = {r["doc_id"]: r["verified"] for r in manifest.report(made(spark, rows)).collect()}
    changed = {i for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 0 and t is not None and any("A" <= c <= "Z" for c in t)}
    assert changed and {i for i, ok in got.items() if not ok} == changed
