"""Components by parts of the edges."""

import numpy as np

from chunkloom.operators import graphs


def brute(edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    while True:
        before = dict(root)
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def test_parts_of_any_size_give_the_same_components(spark, monkeypatch):
    rng = np.random.default_rng(9)
    chain = [(k, k + 1) for k in range(1000, 1040)][::-1]
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (170, 2))] + chain + [(7000, int(k)) for k in range(6900, 6950)] + [(3, 3), (9999, 9999)]
    table = spark.createDataFrame([*edges, (1, None), (None, None)], "a long, b long")
    wanted = brute(edges)
    for size in (500, 60, 11):
        monkeypatch.setattr(graphs, "EDGES", size)
        assert found(graphs.components(table)) == wanted
    assert found(graphs.star_components(table)) == wanted


def test_a_graph_of_few_parts_takes_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(graphs, "EDGES", 100)
    written = []
    kept = graphs.cut
    monkeypatch.setattr(graphs, "cut", lambda df, *name: written.append(name) or kept(df, *name))
    edges = [(k, k + 1) for k in range(300)]
    assert set(found(graphs.components(spark.createDataFrame(edges, "a long, b long"))).values()) == {0}
    assert len(written) == 6


def test_more_ranges_than_asked_for_leave_no_component_split(spark, monkeypatch):
    frame = type(spark.range(0))
    kept = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, many, *cols: kept(self, max(many, 7), *cols))
    edges = [(k, k + 1) for k in range(300)]
    assert set(found(graphs.components(spark.createDataFrame(edges, "a long, b long"))).values()) == {0}


def test_links_of_texts_take_no_rounds_where_they_fit_a_part(spark, monkeypatch):
    from chunkloom.llm.components import components

    written = []
    kept = graphs.cut
    monkeypatch.setattr(graphs, "cut", lambda df, *name: written.append(name) or kept(df, *name))
    edges = [(k, k + 1) for k in range(300)]
    assert set(found(components(spark.createDataFrame(edges, "a long, b long"))).values()) == {0}
    assert len(written) == 2
