"""Label volumes against dense loops, in blocks smaller than the volume."""

import itertools

import numpy as np
import pytest

from chunkloom.operators import stencils

NEAR = [o for o in itertools.product((-1, 0, 1), repeat=3) if any(o)]


def volume(seed, shape=(7, 9, 8), labels=3):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, labels + 1, tuple(-(-n // 3) for n in shape)).repeat(3, 0).repeat(3, 1).repeat(3, 2)[: shape[0], : shape[1], : shape[2]].astype(np.int64)
    noise = rng.random(shape) < 0.15
    a[noise] = rng.integers(0, labels + 1, noise.sum())
    return a


def frame(spark, a):
    rows = [(*map(int, p), int(a[p])) for p in np.ndindex(a.shape) if a[p]]
    return spark.createDataFrame(rows, "z int, y int, x int, label long")


def dense(df, shape):
    a = np.zeros(shape, np.int64)
    for r in df.collect():
        assert a[r["z"], r["y"], r["x"]] == 0
        a[r["z"], r["y"], r["x"]] = r["label"]
    return a


def around(a, p, offsets=NEAR):
    at = [tuple(np.add(p, o)) for o in offsets]
    return [int(a[q]) for q in at if all(0 <= i < n for i, n in zip(q, a.shape))]


def smooth(a, fill, margin, least):
    out = a.copy()
    for p in np.ndindex(a.shape):
        own, near = a[p], around(a, p)
        same, others = near.count(own), [v for v in near if v > 0 and v != own]
        if own and same < 26 and not others and near.count(0) > same:
            out[p] = 0
        elif own and len(set(others)) == 1 and same + len(others) >= least and len(others) > same + margin:
            out[p] = others[0]
        elif not own and len(set(others)) == 1 and len(others) >= fill:
            out[p] = others[0]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_smoothing_is_that_of_the_whole_volume(spark, seed):
    a = volume(seed)
    want = smooth(smooth(a, 10, 1, 4), 10, 1, 4)
    assert (want != a).any() and (dense(stencils.smoothed_labels(frame(spark, a), a.shape, 2, 10, 1, 4, (3, 4, 5)), a.shape) == want).all()


@pytest.mark.parametrize("radius", [1, 2])
def test_thin_parts_are_what_an_opening_removes(spark, radius):
    a = volume(5, (11, 10, 9), 2)
    a[1:8, 1:8, 1:8] = 1
    want = np.zeros_like(a)
    cube = list(itertools.product(range(-radius, radius + 1), repeat=3))
    whole = {p for p in np.ndindex(a.shape) if a[p] and around(a, p, cube).count(a[p]) == len(cube)}
    for p in np.ndindex(a.shape):
        if a[p] and not any(tuple(np.add(p, o)) in whole and a[tuple(np.add(p, o))] == a[p] for o in cube):
            want[p] = a[p]
    assert whole and (dense(stencils.thin_parts(frame(spark, a), a.shape, radius, (5, 4, 6)), a.shape) == want).all()


def test_pieces_get_labels_of_their_own(spark):
    a = volume(9)
    want, at = a.copy(), int(a.max())
    for label in range(1, at + 1):
        left, first = {p for p in np.ndindex(a.shape) if a[p] == label}, True
        for p in sorted(left):
            if p not in left:
                continue
            piece, front = {p}, [p]
            while front:
                q = front.pop()
                for o in [o for o in NEAR if sum(map(abs, o)) == 1]:
                    n = tuple(int(v) for v in np.add(q, o))
                    if n in left and n not in piece:
                        piece.add(n)
                        front.append(n)
            left -= piece
            if not first:
                at += 1
                for q in piece:
                    want[q] = at
            first = False
    got = dense(stencils.relabelled(frame(spark, a), a.shape, (3, 4, 5)), a.shape)
    assert at > a.max() and (got == want).all()


def test_piece_sizes_are_counted_before_names_are_joined(spark, capsys):
    a = (np.random.default_rng(12).integers(0, 3, (7, 9, 11))).astype(np.int64)
    named = dense(stencils.relabelled(frame(spark, a), a.shape, (3, 4, 5)), a.shape)
    want = {}
    for label, piece in zip(a[a > 0].tolist(), named[a > 0].tolist()):
        want[label, piece] = want.get((label, piece), 0) + 1
    found = stencils.piece_sizes(frame(spark, a), a.shape, (3, 4, 5))
    assert {(r["label"], r["piece"]): r["n"] for r in found.collect()} == want and len(want) > 5
    capsys.readouterr()
    found.explain()
    plan = capsys.readouterr().out
    # No voxel's place is read again, so none meets another table.
    assert "ReadSchema: struct<label:bigint,node:bigint>" in plan and "ReadSchema: struct<z" not in plan
    assert stencils.piece_sizes(frame(spark, np.zeros((2, 2, 2), np.int64)), (0, 0, 0)).count() == 0


def test_empty_volumes(spark):
    none = frame(spark, np.zeros((2, 2, 2), np.int64))
    assert stencils.smoothed_labels(none, (0, 0, 0)).count() == stencils.thin_parts(none, (0, 0, 0), 1).count() == stencils.relabelled(none, (0, 0, 0)).count() == 0
