"""Fits of linear models by sums of products: one grouped aggregate a round, and small solves over its results.

Sums are over whole groups with partial aggregation, so a group may hold any share of the rows. Where there is a
system for each group, it is solved by elimination in column expressions, and a column that adds nothing to those
before it gets the coefficient 0; a single system is solved at the driver, from some tens of numbers.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from chunkloom.functions.scratch import cut
from chunkloom.operators.ranges import numbered, quantiles

#: A column is dependent where elimination leaves less than this share of its sum of squares.
RANK = 1e-9
#: Points of a window that are fitted in one task.
TOGETHER = 100_000


def products(columns: list[str], targets: list[str], weight: str = "1.0D") -> dict[str, str]:
    """Sums a{i}_{j} of products of columns, i up to j, and b{i}_{c} of those with targets, as SQL."""
    out = {f"a{i}_{j}": f"sum({weight} * {columns[i]} * {columns[j]})" for i in range(len(columns)) for j in range(i, len(columns))}
    return out | {f"b{i}_{c}": f"sum({weight} * {columns[i]} * {t})" for i in range(len(columns)) for c, t in enumerate(targets)}


def elimination(k: int, m: int) -> list[dict[str, str]]:
    """Steps, as SQL of names over the step before, from sums as products() names them to x{i}_{c}, the coefficients for target c."""
    full = {f"a{i}_{j}": f"a{min(i, j)}_{max(i, j)}" for i in range(k) for j in range(k)} | {f"b{i}_{c}": f"b{i}_{c}" for i in range(k) for c in range(m)}
    steps = [full | {f"d{i}": f"a{i}_{i}" for i in range(k)}]
    kept = {f"d{i}": f"d{i}" for i in range(k)}
    for p in range(k):
        factor = lambda i, p=p: f"case when a{p}_{p} > {RANK} * d{p} then a{i}_{p} / a{p}_{p} else 0 end"
        step = {f"a{i}_{j}": f"a{i}_{j}" if i == p else f"a{i}_{j} - {factor(i)} * a{p}_{j}" for i in range(k) for j in range(k)}
        step |= {f"b{i}_{c}": f"b{i}_{c}" if i == p else f"b{i}_{c} - {factor(i)} * b{p}_{c}" for i in range(k) for c in range(m)}
        steps.append(step | kept)
    steps.append({f"x{i}_{c}": f"case when a{i}_{i} > {RANK} * d{i} then b{i}_{c} / a{i}_{i} else 0 end" for i in range(k) for c in range(m)})
    return steps


def solved(sums: DataFrame, k: int, m: int, keep: list[str]) -> DataFrame:
    """The columns `keep` of sums, and coefficients x{i}_{c}."""
    for step in elimination(k, m):
        sums = sums.selectExpr(*keep, *[f"{e} as {n}" for n, e in step.items()])
    return sums


AXES = ("z", "y", "x")


def _normalised(points: DataFrame) -> DataFrame:
    """points (key, id, z, y, x and others) with u1 to u3: axes centred and scaled within the key, 0 where they don't vary."""
    sums = points.groupBy("key").agg(*[e for a in AXES for e in (F.avg(a).alias(f"m{a}"), F.stddev_pop(a).alias(f"s{a}"), (F.max(a) - F.min(a)).alias(f"w{a}"), F.max(F.abs(a)).alias(f"t{a}"))])
    scaled = [F.when(F.col(f"w{a}") > 16 * 2.0**-52 * F.greatest(F.col(f"t{a}"), F.lit(1.0)), (F.col(a) - F.col(f"m{a}")) / F.col(f"s{a}")).otherwise(0.0).alias(f"u{k + 1}") for k, a in enumerate(AXES)]
    return points.join(sums, "key").select(*points.columns, *scaled)


_BASIS = ["1.0D", "u1", "u2", "u3"]
_FIT = " + ".join(f"x{i}_0 * {b}" for i, b in enumerate(_BASIS))


def _planes(basis: np.ndarray, moved: np.ndarray, scale: float, rounds: int) -> np.ndarray:
    """(4, 3): coefficients for each component, by the sums and the elimination of products() and solved()."""
    k = basis.shape[1]
    upper = [(i, j) for i in range(k) for j in range(i, k)]
    both = np.stack([basis[:, i] * basis[:, j] for i, j in upper], 1)
    found = np.zeros((k, moved.shape[1]))
    found[0] = np.median(moved, 0)
    for _ in range(rounds):
        w = 1 / (1 + ((moved - basis @ found) / scale) ** 2)
        sums, b = w.T @ both, (w * moved).T @ basis
        a = np.zeros((len(sums), k, k))
        for n, (i, j) in enumerate(upper):
            a[:, i, j] = a[:, j, i] = sums[:, n]
        least = RANK * np.diagonal(a, axis1=1, axis2=2).copy()
        for p in range(k):
            pivot = a[:, p, p]
            factor = np.where((pivot > least[:, p])[:, None], a[:, :, p] / np.where(pivot > least[:, p], pivot, 1.0)[:, None], 0.0)
            factor[:, p] = 0
            a, b = a - factor[:, :, None] * a[:, p, None, :], b - factor * b[:, p, None]
        own = np.diagonal(a, axis1=1, axis2=2)
        found = np.where(own > least, b / np.where(own > least, own, 1.0), 0.0).T
    return found


def _marked(scale: float, spread: float, least: float, most: float | None, rounds: int) -> Callable[[pa.Table], pa.Table]:
    def mark(held: pa.Table) -> pa.Table:
        at, moved = (np.stack([held[c].to_numpy().astype(np.float64) for c in names], 1) for names in (AXES, [f"d{a}" for a in AXES]))
        varies = np.ptp(at, 0) > 16 * 2.0**-52 * np.maximum(np.abs(at).max(0), 1.0)
        unit = np.where(varies, (at - at.mean(0)) / np.where(varies, at.std(0), 1.0), 0.0)
        basis = np.concatenate([np.ones((len(at), 1)), unit], 1)
        score = np.sqrt(((moved - basis @ _planes(basis, moved, scale, rounds)) ** 2).sum(1))
        middle = np.median(score)
        limit = max(least, middle + spread * 1.4826 * np.median(np.abs(score - middle)))
        limit = limit if most is None else min(limit, most)
        for name, values in (("score", score), ("threshold", np.full(len(score), limit)), ("outlier", score > limit)):
            held = held.append_column(name, pa.array(values))
        return held

    return mark


def displacement_outliers(points: DataFrame, scale: float, spread: float, least: float, most: float | None = None, rounds: int = 25, together: int = TOGETHER) -> DataFrame:
    """points (key, id, z, y, x, dz, dy, dx) with `score`, the distance from their window's plane of displacements, its `threshold` and `outlier`.

    Planes are fitted by reweighted rounds with weights 1 / (1 + (r / scale)^2) for each component, from the median
    displacement on. The threshold is the median score plus `spread` deviations (1.4826 times the median absolute
    one), at least `least` and at most `most`. Axes that don't vary or depend on others add nothing to a plane. Ids
    are unique within a key; rows with nulls take no part.

    A window of at most `together` points takes all rounds in one task, so its points are shuffled once. Larger ones
    take a grouped sum a round, and may hold any share of the points.
    """
    usable = cut(points.dropna(subset=["key", "id", *AXES, *[f"d{a}" for a in AXES]]), "points")
    columns = ["key", "id", *[c for c in usable.columns if c not in ("key", "id")]]
    large = cut(usable.groupBy("key").count().where(F.col("count") > together).select("key"))
    some = not large.isEmpty()
    small = usable.join(large, "key", "left_anti") if some else usable
    schema = StructType([*(usable.schema[c] for c in columns), StructField("score", DoubleType()), StructField("threshold", DoubleType()), StructField("outlier", BooleanType())])
    found = small.select(*columns).groupBy("key").applyInArrow(_marked(scale, spread, float(least), None if most is None else float(most), rounds), schema)
    return found.unionByName(_outliers_by_rounds(usable.join(large, "key", "left_semi"), scale, spread, least, most, rounds)) if some else found


def _outliers_by_rounds(usable: DataFrame, scale: float, spread: float, least: float, most: float | None, rounds: int) -> DataFrame:
    named = [f"d{a}" for a in AXES]
    rows = cut(_normalised(usable).selectExpr("key", "id", "u1", "u2", "u3", "explode(array(" + ", ".join(f"struct('{a}' as part, cast({d} as double) as v)" for a, d in zip(AXES, named)) + ")) as c").selectExpr("key", "id", "u1", "u2", "u3", "c.part", "c.v"))
    at = rows.select(F.struct("key", "part").alias("at"), "v")
    middle = quantiles(at, "at", "v", (0.5,)).selectExpr("at.key", "at.part", "q0 as x0_0", *[f"0.0D as x{i}_0" for i in (1, 2, 3)])
    planes = cut(middle)
    for _ in range(rounds):
        weighed = rows.join(planes, ["key", "part"]).withColumn("w", F.expr(f"1 / (1 + pow((v - ({_FIT})) / {scale}, 2))"))
        sums = weighed.groupBy("key", "part").agg(*[F.expr(e).alias(n) for n, e in products(_BASIS, ["v"], "w").items()])
        planes = cut(solved(sums, 4, 1, ["key", "part"]))
    off = rows.join(planes, ["key", "part"]).withColumn("r", F.expr(f"v - ({_FIT})"))
    scores = cut(off.groupBy("key", "id").agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("score")))
    middles = quantiles(scores, "key", "score", (0.5,)).selectExpr("key", "q0 as middle")
    apart = quantiles(scores.join(middles, "key").withColumn("apart", F.abs(F.col("score") - F.col("middle"))), "key", "apart", (0.5,)).selectExpr("key", "q0 as mad")
    limit = F.greatest(F.lit(float(least)), F.col("middle") + spread * 1.4826 * F.col("mad"))
    limits = middles.join(apart, "key").select("key", (limit if most is None else F.least(limit, F.lit(float(most)))).alias("threshold"))
    marked = scores.join(limits, "key").withColumn("outlier", F.col("score") > F.col("threshold"))
    return usable.join(marked, ["key", "id"])


def linear_fields(points: DataFrame, values: list[str]) -> DataFrame:
    """(key, n, mz, sz, my, ... sx, x{i}_{c}): for each key the values as affine functions of z, y, x, each centred by m and divided by s; coefficient i = 0 is the constant.

    Axes that don't vary, or that those before them determine, have the coefficient 0. Rows with nulls take no part.
    """
    usable = points.dropna(subset=["key", *AXES, *values])
    sums = _normalised(usable).groupBy("key").agg(
        F.count("*").alias("n"), *[e for a in AXES for e in (F.avg(a).alias(f"m{a}"), F.stddev_pop(a).alias(f"s{a}"))], *[F.expr(e).alias(n) for n, e in products(_BASIS, [f"cast({v} as double)" for v in values]).items()]
    )
    return solved(sums, 4, len(values), ["key", "n", *[f"{e}{a}" for a in AXES for e in "ms"]])


def predicted(points: DataFrame, fields: DataFrame, values: list[str]) -> DataFrame:
    """points (key, z, y, x and others) with the values that linear_fields() gives at them, under the names `values`; keys without a field: nulls."""
    scaled = ["1.0D", *[f"case when s{a} > 0 then ({a} - m{a}) / s{a} else 0 end" for a in AXES]]
    found = points.join(fields, "key", "left")
    return found.selectExpr(*[c for c in points.columns if c not in values], *[" + ".join(f"x{i}_{c} * ({u})" for i, u in enumerate(scaled)) + f" as {v}" for c, v in enumerate(values)])


def balanced_affine(pairs: DataFrame, delta: float = 2.0, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(matrix, translation) that carries (sx, sy, sz) to (tx, ty, tz) over rows of pairs (pair, sx, ... tz).

    A row weighs 1 / (rows of its pair), and min(1, delta / |residual|) of that in the next of `rounds` rounds. Fewer
    than four rows that span space, or values that aren't finite, are an error. A round is one aggregate over the
    rows; the driver gets 22 numbers.
    """
    if delta <= 0 or rounds < 1:
        raise ValueError("delta and the number of rounds have to be positive")
    names = [f"{e}{a}" for e in "st" for a in "xyz"]
    counts = pairs.groupBy("pair").agg(F.count("*").alias("n"))
    held = cut(pairs.join(counts, "pair").select(*[F.col(c).cast("double").alias(c) for c in names], (1 / F.col("n")).alias("base")))
    middle = held.agg(*[F.avg(f"s{a}") for a in "xyz"], F.count("*"), F.sum(F.greatest(*[F.when(F.col(c).isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 1).otherwise(0) for c in names]))).first()
    if middle[4]:
        raise ValueError("correspondences have to be finite")
    if middle[3] < 4:
        raise ValueError("an affine fit needs four points that span space")
    basis = [*[f"(s{a} - {float(m)!r}D)" for a, m in zip("xyz", middle)], "1.0D"]
    targets = [f"t{a}" for a in "xyz"]
    found = None
    for _ in range(rounds):
        weight = "base"
        if found is not None:
            off = [" + ".join(f"{float(found[i, c])!r}D * {b}" for i, b in enumerate(basis)) + f" - {t}" for c, t in enumerate(targets)]
            weight = f"(base * least(1.0D, {float(delta)!r}D / greatest(sqrt({' + '.join(f'pow({o}, 2)' for o in off)}), 1e-9D)))"
        sums = held.agg(*[F.expr(e).alias(n) for n, e in products(basis, targets, weight).items()]).first()
        left = np.array([[sums[f"a{min(i, j)}_{max(i, j)}"] for j in range(4)] for i in range(4)])
        right = np.array([[sums[f"b{i}_{c}"] for c in range(3)] for i in range(4)])
        size = np.sqrt(np.diag(left))
        if not size.all() or np.linalg.matrix_rank(left / np.outer(size, size), tol=1e-9) < 4:
            raise ValueError("an affine fit needs four points that span space")
        found = np.linalg.solve(left / np.outer(size, size), right / size[:, None]) / size[:, None]
    matrix = found[:3].T
    return matrix, found[3] - matrix @ np.array(middle[:3], float)


#: Terms of a field over a plane; a constant cancels out between two tiles.
TERMS = ("{y}", "{x}", "{y} * {y}", "{y} * {x}", "{x} * {x}")
DESIGN = ["(" + t.format(y="ya", x="xa") + " - " + t.format(y="yb", x="xb") + ")" for t in TERMS]


def fitted_fields(rows: DataFrame, penalties: tuple[float, ...], delta: float = 0.1, rounds: int = 60, tolerance: float = 1e-11) -> dict[float, np.ndarray]:
    """For each penalty the coefficients c of TERMS with the least mean of pseudo-Huber losses of design * c - target over rows (ya, xa, yb, xb, target), plus penalty / 2 times the squares of c.

    Reweighted rounds for all penalties at once: a round is one aggregate over the rows, and the driver gets 20 numbers
    a penalty. The objective is convex, so they end at its one minimum; rounds that don't get there are an error.
    """
    if any(p <= 0 for p in penalties):
        raise ValueError("penalties have to be positive")
    k, n = len(TERMS), rows.count()
    if not n:
        raise ValueError("a field needs rows")
    found = {p: np.zeros(k) for p in penalties}
    for _ in range(rounds):
        sums = []
        for at, p in enumerate(penalties):
            off = " + ".join(f"{float(c)!r}D * {d}" for c, d in zip(found[p], DESIGN)) + " - target"
            weight = f"(1 / sqrt(1 + pow(({off}) / {delta!r}D, 2)))"
            sums += [F.expr(e).alias(f"{name}_{at}") for name, e in products(DESIGN, ["target"], weight).items()]
        got, change = rows.agg(*sums).first(), 0.0
        for at, p in enumerate(penalties):
            left = np.array([[got[f"a{min(i, j)}_{max(i, j)}_{at}"] for j in range(k)] for i in range(k)])
            right = np.array([got[f"b{i}_0_{at}"] for i in range(k)])
            new = np.linalg.solve(left / n + p * np.eye(k), right / n)
            change, found[p] = max(change, np.abs(new - found[p]).max()), new
        if change <= tolerance:
            return found
    raise RuntimeError("the field did not settle")


def field_errors(rows: DataFrame, fields: dict[float, np.ndarray]) -> dict[float, float]:
    """For each penalty's field the mean over pairs of the mean |residual| of rows (pair, ya, ... target)."""
    off = [F.avg(F.abs(F.expr(" + ".join(f"{float(c)!r}D * {d}" for c, d in zip(own, DESIGN)) + " - target"))).alias(f"e{k}") for k, own in enumerate(fields.values())]
    means = rows.groupBy("pair").agg(*off).agg(*[F.avg(f"e{k}") for k in range(len(fields))]).first()
    return dict(zip(fields, means))


def chosen_field(rows: DataFrame, held: str, penalties: tuple[float, ...] = (0.003, 0.03, 0.3)) -> tuple[float, np.ndarray, dict[float, float]]:
    """(penalty, coefficients, errors): the penalty whose field, fitted without the rows where `held` is true, has the least error on them, the larger at ties; then the field of all rows."""
    kept = cut(rows.withColumn("_held", F.expr(held)))
    errors = field_errors(kept.where("_held"), fitted_fields(kept.where("not _held"), penalties))
    best = min(penalties, key=lambda p: (errors[p], -p))
    return best, fitted_fields(kept, (best,))[best], errors


def held_out_planes(rows: DataFrame, penalty: float) -> DataFrame:
    """(z, n, single, before, shared, alone): for each plane z of rows (z, ya, xa, yb, xb, target) the root mean square of targets, and of what is left by the field of all other planes and by that of the nearest other plane, `single`.

    Fields are ridge regressions with penalty * n on the squares. Sums of products are taken once for each plane; the
    sums of all others are the total less the plane's, and residuals follow from sums too, so all planes are held out
    in one pass over the rows. The nearest plane is the lower one at ties. One plane alone has no others: no row.
    """
    k = len(TERMS)
    sums = products(DESIGN, ["target"])
    own = cut(rows.groupBy("z").agg(F.count("*").alias("n"), F.sum(F.expr("target * target")).alias("tt"), *[F.expr(e).alias(s) for s, e in sums.items()]))  # a row a plane
    total = own.agg(F.count("*"), F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).first()
    if total[0] < 2:
        return own.selectExpr("z", "n", "z as single", "0D as before", "0D as shared", "0D as alone").limit(0)
    ridge = lambda s, n: f" + {penalty!r}D * ({n})" if s in {f"a{i}_{i}" for i in range(k)} else ""
    others = own.selectExpr("z", *[f"{float(total[s])!r}D - {s}{ridge(s, f'{total[1]}L - n')} as {s}" for s in sums])
    lone = own.selectExpr("z", *[f"{s}{ridge(s, 'n')} as {s}" for s in sums])
    names = [f"x{i}_0" for i in range(k)]
    shared = solved(others, k, 1, ["z"]).selectExpr("z", *[f"{x} as shared_{x}" for x in names])
    alone = solved(lone, k, 1, ["z"]).selectExpr("z as single", *[f"{x} as alone_{x}" for x in names])
    # Neighbours among the planes, over ranges of them.
    order = numbered(own.select(F.lit(0).alias("one"), "z"), "one", "z")
    beside = order.selectExpr("z as side", "explode(array(number - 1, number + 1)) as number")
    near = order.select("z", "number").join(beside, "number").groupBy("z").agg(F.min(F.struct(F.abs(F.col("side") - F.col("z")).alias("d"), "side")).alias("s")).selectExpr("z", "s.side as single")
    joined = own.join(near, "z").join(shared, "z").join(alone, "single")

    def left(name: str) -> str:
        x = [f"{name}_x{i}_0" for i in range(k)]
        square = " + ".join(f"{1 if i == j else 2} * {x[i]} * {x[j]} * a{i}_{j}" for i in range(k) for j in range(i, k))
        return f"sqrt(greatest(0, tt - 2 * ({' + '.join(f'{x[i]} * b{i}_0' for i in range(k))}) + {square}) / n)"

    return joined.selectExpr("z", "n", "single", "sqrt(tt / n) as before", f"{left('shared')} as shared", f"{left('alone')} as alone")
