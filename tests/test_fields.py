"""Fits by sums of products against dense solves."""

import numpy as np
import pytest

from chunkloom.operators import fields

PAIRS = "pair string, sx double, sy double, sz double, tx double, ty double, tz double"
POINTS = "key string, id long, z double, y double, x double, dz double, dy double, dx double"
ROWS = "pair long, z long, ya double, xa double, yb double, xb double, target double"


def affine_rows(rng, n=60):
    source = rng.uniform(-50, 300, (n, 3))
    true = np.array([[1.01, 0.02, 0], [-0.01, 0.98, 0.03], [0.0, 0.01, 1.0]]), np.array([3.0, -7.0, 12.0])
    target = source @ true[0].T + true[1] + rng.normal(0, 0.2, (n, 3))
    target[:5] += 80
    return source, target, [f"p{i % 7 if i > 20 else 0}" for i in range(n)], true


def affine(source, target, pairs, delta, rounds):
    design = np.c_[source, np.ones(len(source))]
    base = np.array([1 / pairs.count(p) for p in pairs])
    w = base
    for _ in range(rounds):
        c = np.linalg.lstsq(design * np.sqrt(w)[:, None], target * np.sqrt(w)[:, None], rcond=None)[0]
        w = base * np.minimum(1, delta / np.maximum(np.linalg.norm(design @ c - target, axis=1), 1e-9))
    return c[:3].T, c[3]


def test_affine_recovers_a_planted_one(spark):
    source, target, pairs, true = affine_rows(np.random.default_rng(1))
    table = spark.createDataFrame([(p, *map(float, s), *map(float, t)) for p, s, t in zip(pairs, source, target)], PAIRS)
    matrix, shift = fields.balanced_affine(table)
    want = affine(source, target, pairs, 2.0, 30)
    assert np.allclose(matrix, want[0], atol=1e-8) and np.allclose(shift, want[1], atol=1e-6)
    assert np.allclose(matrix, true[0], atol=0.01) and np.allclose(shift, true[1], atol=1.0)


def test_affine_without_support_is_an_error(spark):
    flat = [("p", float(i), float(j), 0.0, float(i), float(j), 0.0) for i in range(4) for j in range(4)]
    for rows in (flat, flat[:3], [*flat, ("p", 1.0, 1.0, float("nan"), 1.0, 1.0, 1.0)], []):
        with pytest.raises(ValueError):
            fields.balanced_affine(spark.createDataFrame(rows, PAIRS))


def window(rng, n=80, flat=False):
    points = rng.uniform(0, 100, (n, 3)).round(2)
    if flat:
        points[:, 0] = 5.0
        points[:, 2] = 2 * points[:, 1] + 1
    moved = points @ rng.normal(0, 0.02, (3, 3)) + rng.normal(0, 3, 3) + rng.normal(0, 0.1, (n, 3))
    moved[:4] += 25
    return points, moved


def cauchy(points, moved, scale, rounds):
    vary = np.ptp(points, axis=0) > 0
    u = (points[:, vary] - points[:, vary].mean(0)) / points[:, vary].std(0)
    design = np.c_[np.ones(len(points)), u]
    c = np.zeros((design.shape[1], 3))
    c[0] = np.median(moved, axis=0)
    for _ in range(rounds):
        w = 1 / (1 + ((moved - design @ c) / scale) ** 2)
        c = np.stack([np.linalg.lstsq(design * np.sqrt(w[:, [k]]), moved[:, k] * np.sqrt(w[:, k]), rcond=None)[0] for k in range(3)], axis=1)
    return np.linalg.norm(moved - design @ c, axis=1)


def test_displacement_outliers_against_a_dense_version(spark):
    rng = np.random.default_rng(7)
    sets = {"a": window(rng), "b": window(rng, 50), "flat": window(rng, 60, True)}
    table = spark.createDataFrame([(k, i, *map(float, p), *map(float, d)) for k, (points, moved) in sets.items() for i, (p, d) in enumerate(zip(points, moved))] + [("a", 999, None, 1.0, 1.0, 1.0, 1.0, 1.0)], POINTS)
    got = {(r["key"], r["id"]): r for r in fields.displacement_outliers(table, 1.0, 6.0, 0.5, 20.0, 8).collect()}
    assert len(got) == 190
    for key, (points, moved) in sets.items():
        scores = cauchy(points, moved, 1.0, 8)
        middle = np.median(scores)
        threshold = min(max(0.5, middle + 6 * 1.4826 * np.median(np.abs(scores - middle))), 20.0)
        own = [got[key, i] for i in range(len(points))]
        assert np.allclose([r["score"] for r in own], scores, atol=1e-6) and own[0]["threshold"] == pytest.approx(threshold)
        assert [r["outlier"] for r in own] == list(scores > threshold) and all(r["outlier"] for r in own[:4])
    assert fields.displacement_outliers(table.limit(0), 1.0, 6.0, 0.5).count() == 0


def test_windows_of_few_and_of_many_points_give_the_same_scores_and_few_are_shuffled_once(spark, capsys):
    rng = np.random.default_rng(17)
    sets = {"a": window(rng), "flat": window(rng, 60, True), "one": ([[1.0, 2.0, 3.0]], [[1.0, 0.0, 2.0]])}
    table = spark.createDataFrame([(k, i, *map(float, p), *map(float, d)) for k, (points, moved) in sets.items() for i, (p, d) in enumerate(zip(points, moved))], POINTS)
    found = [fields.displacement_outliers(table, 1.0, 6.0, 0.5, 20.0, 8, together) for together in (1000, 70, 0)]
    wanted, *others = [sorted(tuple(r) for r in f.select("key", "id", "outlier", "score", "threshold").collect()) for f in found]
    for got in others:
        assert [r[:3] for r in got] == [r[:3] for r in wanted] and np.allclose([r[3:] for r in got], [r[3:] for r in wanted], atol=1e-9)
    capsys.readouterr()
    found[0].explain()
    assert capsys.readouterr().out.count("Exchange") == 1


def test_linear_fields_drop_constant_and_dependent_axes(spark):
    rng = np.random.default_rng(8)
    points, moved = window(rng, 40, True)
    table = spark.createDataFrame([("f", i, *map(float, p), *map(float, d)) for i, (p, d) in enumerate(zip(points, moved))], POINTS)
    found = fields.linear_fields(table, ["dz", "dy", "dx"])
    row = found.first()
    assert row["x1_0"] == row["x3_0"] == 0.0 and row["x2_0"] != 0.0
    design = np.c_[np.ones(40), points[:, 1]]
    want = design @ np.linalg.lstsq(design, moved, rcond=None)[0]
    got = sorted(fields.predicted(table, found, ["dz", "dy", "dx"]).collect(), key=lambda r: r["id"])
    assert np.allclose([[r["dz"], r["dy"], r["dx"]] for r in got], want, atol=1e-8)


def field_rows(seed=3, n=400):
    rng = np.random.default_rng(seed)
    at = rng.uniform(-1, 1, (n, 4))
    rows = []
    for i, (ya, xa, yb, xb) in enumerate(at):
        target = 0.3 * (ya - yb) - 0.2 * (xa * xa - xb * xb) + rng.normal(0, 0.05) + (1.5 if i % 11 == 0 else 0)
        rows.append((i % 20, i % 6 * 2, ya, xa, yb, xb, float(target)))
    return [(p, z, *map(float, r), t) for p, z, *r, t in rows]


def design(rows):
    ya, xa, yb, xb = np.array([r[2:6] for r in rows]).T
    return np.stack([ya - yb, xa - xb, ya * ya - yb * yb, ya * xa - yb * xb, xa * xa - xb * xb], axis=1), np.array([r[6] for r in rows])


def test_fields_are_at_the_minimum(spark):
    rows = field_rows()
    found = fields.fitted_fields(spark.createDataFrame(rows, ROWS), (0.003, 0.3))
    x, t = design(rows)
    for penalty, c in found.items():
        r = x @ c - t
        assert np.abs(x.T @ (r / np.sqrt(1 + (r / 0.1) ** 2)) / len(t) + penalty * c).max() < 1e-9
    assert found[0.003][0] == pytest.approx(0.3, abs=0.03) and found[0.003][4] == pytest.approx(-0.2, abs=0.03)


def test_penalty_is_chosen_on_held_pairs(spark):
    rows = field_rows(4)
    table = spark.createDataFrame(rows, ROWS)
    best, c, errors = fields.chosen_field(table, "pair % 5 = 0")
    train, test = [r for r in rows if r[0] % 5], [r for r in rows if r[0] % 5 == 0]
    plain = fields.fitted_fields(spark.createDataFrame(train, ROWS), (0.003, 0.03, 0.3))
    x, t = design(test)
    for p, own in plain.items():
        off = np.abs(x @ own - t)
        assert errors[p] == pytest.approx(np.mean([off[[r[0] == k for r in test]].mean() for k in {r[0] for r in test}]))
    assert best == min(errors, key=errors.get) and np.allclose(c, fields.fitted_fields(table, (best,))[best])
    with pytest.raises(ValueError):
        fields.fitted_fields(table.limit(0), (0.1,))


def test_held_out_planes_equal_refitting(spark):
    rows = field_rows(5)
    got = {r["z"]: r for r in fields.held_out_planes(spark.createDataFrame(rows, ROWS), 0.01).collect()}
    planes = sorted({r[1] for r in rows})

    def fit(part):
        x, t = design(part)
        return np.linalg.solve(x.T @ x + 0.01 * len(t) * np.eye(5), x.T @ t)

    assert sorted(got) == planes
    for z in planes:
        near = min((p for p in planes if p != z), key=lambda p: (abs(p - z), p))
        x, t = design([r for r in rows if r[1] == z])
        root = lambda v: np.sqrt(np.mean(v**2))
        assert got[z]["single"] == near and got[z]["before"] == pytest.approx(root(t))
        assert got[z]["shared"] == pytest.approx(root(x @ fit([r for r in rows if r[1] != z]) - t))
        assert got[z]["alone"] == pytest.approx(root(x @ fit([r for r in rows if r[1] == near]) - t))
    assert fields.held_out_planes(spark.createDataFrame(rows[:1], ROWS), 0.01).count() == 0
