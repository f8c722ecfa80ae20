"""Distances within a radius, by blocks of sources."""

import numpy as np
import pyarrow as pa

from chunkloom.operators import geodesics as G


def brute(links, sources, radius):
    near = {}
    for a, b, n in links:
        if a != b:
            near.setdefault(a, []).append((b, n))
            near.setdefault(b, []).append((a, n))
    out = []
    for s in sources:
        known, front = {s: 0}, [s]
        while front:
            at = front.pop()
            for b, n in near.get(at, []):
                if known[at] + n <= radius and known[at] + n < known.get(b, radius + 1):
                    known[b] = known[at] + n
                    front.append(b)
        out += [(s, b, d) for b, d in known.items()]
    return sorted(out)


def linked(n=60, many=150, seed=3):
    rng = np.random.default_rng(seed)
    return [(int(a), int(b), int(w)) for a, b, w in zip(rng.integers(0, n, many) * 7, rng.integers(0, n, many) * 7, rng.integers(1, 6, many))]


def test_blocks_give_all_distances_and_no_row_of_them_is_shuffled(spark, monkeypatch, capsys):
    monkeypatch.setattr(G, "SOURCES", 7)
    links = linked()
    sources = sorted({a for a, _, _ in links} | {5000})
    found = G.geodesics(spark.createDataFrame(links, "a long, b long, length long"), spark.createDataFrame([(s,) for s in sources] + [(None,), (sources[0],)], "node long"), 6)
    assert sorted(map(tuple, found.collect())) == brute(links, sources, 6)
    found.explain()
    assert "hashpartitioning(source" not in capsys.readouterr().out


def test_sources_are_solved_fewer_at_once_where_they_take_many_steps(monkeypatch):
    monkeypatch.setattr(G, "STEPS", 40)
    links = linked(seed=4)
    sources = sorted({a for a, _, _ in links})
    both = [(a, b, n) for a, b, n in links if a != b] + [(b, a, n) for a, b, n in links if a != b] + [(s, s, None) for s in sources]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*both)], names=["a", "b", "length"])
    parts = list(G._solve(7)(iter([batch])))
    assert len(parts) > 1
    assert sorted((r["source"], r["node"], r["distance"]) for p in parts for r in p.to_pylist()) == brute(links, sources, 7)


def test_distances_that_are_no_whole_numbers(spark):
    links = spark.createDataFrame([(0, 1, 0.5), (1, 2, 0.25), (0, 2, 2.0)], "a long, b long, length double")
    assert sorted(map(tuple, G.geodesics(links, spark.createDataFrame([(0,)], "node long"), 1).collect())) == [(0, 0, 0.0), (0, 1, 0.5), (0, 2, 0.75)]
    assert G.geodesics(links.limit(0), spark.createDataFrame([], "node long"), 1).count() == 0
