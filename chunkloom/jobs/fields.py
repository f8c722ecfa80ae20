"""Linear models fitted by sums of products. Their SQL writes rounds and eliminations out one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.jobs.base import Jobs
from chunkloom.operators import fields as X
from chunkloom.sources import adapters as A

JOBS = Jobs()
ROUNDS, DELTA = 30, 2.0
PENALTIES, FIELD_ROUNDS = (0.003, 0.03, 0.3), 24
RIDGE = 0.01
WINDOW, SCALE, SPREAD, LEAST, MOST, PLANE_ROUNDS = 400, 2.0, 4.0, 3.0, 30.0, 12


def _plain(sql: str) -> str:
    """Spark's literals as DuckDB's."""
    return sql.replace("1.0D", "1.0::double").replace("0.0D", "0.0::double")


def _solve(name: str, source: str, k: int, m: int, keep: str) -> str:
    made = source
    for step in X.elimination(k, m):
        made = f"(select {keep}, {', '.join(f'{e} as {n}' for n, e in step.items())} from {made})"
    return f"{name} as materialized {made}"


def _sums(columns: list[str], targets: list[str], weight: str) -> str:
    return ", ".join(f"{_plain(e)}::double as {n}" for n, e in X.products(columns, targets, weight).items())


# Correspondences: crop centres of two views of a pair of tiles; one line in seven is far off.
_PAIRS = {
    "pair": "l_orderkey {div} 160", "sx": "l_partkey % 97 * 3", "sy": "l_suppkey % 53 * 5", "sz": "l_orderkey % 31 * 4",
    "far": "case when l_linenumber = 7 then 40 else 0 end", "noise": "(l_partkey % 5 - 2)",
}
_TARGETS = {"tx": "1.01 * sx + 0.02 * sy + 3 + 0.1 * noise + far", "ty": "0.98 * sy - 0.01 * sx + 0.03 * sz - 7 + 0.2 * noise - far", "tz": "sz + 0.01 * sy + 12 - 0.1 * noise"}


def correspondences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "lineitem").selectExpr(*[f"{e.format(div='div')} as {n}" for n, e in _PAIRS.items()])
    return rows.selectExpr("pair", *[f"cast({c} as double) as {c}" for c in ("sx", "sy", "sz")], *[f"cast({e} as double) as {n}" for n, e in _TARGETS.items()])


def _affine_sql() -> str:
    inner = ", ".join(f"{e.format(div='//')} as {n}" for n, e in _PAIRS.items())
    parts = [
        f"""with raw as (select {inner} from lineitem), rows as (select pair, sx::double as sx, sy::double as sy, sz::double as sz, {', '.join(f'({e})::double as {n}' for n, e in _TARGETS.items())} from raw),
held as materialized (select *, 1.0::double / count(*) over (partition by pair) as base, sx - avg(sx) over () as ux, sy - avg(sy) over () as uy, sz - avg(sz) over () as uz from rows),
middle as (select avg(sx) as mx, avg(sy) as my, avg(sz) as mz from rows)"""
    ]
    basis = ["ux", "uy", "uz", "1.0::double"]
    for r in range(ROUNDS):
        if r == 0:
            source = "select *, base as w from held"
        else:
            off = [" + ".join(f"x{i}_{c} * {b}" for i, b in enumerate(basis)) + f" - t{a}" for c, a in enumerate("xyz")]
            source = f"select held.*, base * least(1.0, {DELTA} / greatest(sqrt({' + '.join(f'({o}) ** 2' for o in off)}), 1e-9)) as w from held, fit{r - 1}"
        parts.append(f"sums{r} as materialized (select 1 as one, {_sums(basis, ['tx', 'ty', 'tz'], 'w')} from ({source}))")
        parts.append(_solve(f"fit{r}", f"sums{r}", 4, 3, "one"))
    cells = [f"select '{a}' as axis, round(x0_{c}, 6) as x, round(x1_{c}, 6) as y, round(x2_{c}, 6) as z, round(x3_{c} - x0_{c} * mx - x1_{c} * my - x2_{c} * mz, 4) as moved from fit{ROUNDS - 1}, middle" for c, a in enumerate("xyz")]
    return ",\n".join(parts) + "\n" + " union all ".join(cells)


@JOBS.add(_affine_sql())
def balanced_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The affine map between two views that all pairs of tiles agree on, each pair with the same say."""
    matrix, shift = X.balanced_affine(correspondences(spark, sf_dir), DELTA, ROUNDS)
    rows = [(a, *[float(v) for v in own], float(s)) for a, own, s in zip("xyz", matrix, shift)]
    found = spark.createDataFrame(rows, "axis string, x double, y double, z double, moved double")
    return found.select("axis", *[F.round(c, 6).alias(c) for c in "xyz"], F.round("moved", 4).alias("moved"))


# Log ratios of two tiles at the same place of their overlap, at each tile's own coordinates; one line in six is far off.
_ROWS = {
    "pair": "l_orderkey {div} 80", "z": "l_orderkey {div} 1200", "ya": "(l_partkey % 41 - 20) / {twenty}", "xa": "(l_suppkey % 37 - 18) / {twenty}",
    "yb": "(l_orderkey % 41 - 20) / {twenty}", "xb": "(l_partkey % 29 - 14) / {twenty}", "noise": "(l_suppkey % 7 - 3) / {twenty}", "far": "case when l_linenumber = 6 then 1 else 0 end",
}
_TARGET = "0.3 * (ya - yb) - 0.2 * (xa * xa - xb * xb) + 0.1 * (ya * xa - yb * xb) + noise + 1.5 * far"
_HELD = "pair % 5 = 0"


def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "lineitem").selectExpr(*[f"{e.format(div='div', twenty='20D')} as {n}" for n, e in _ROWS.items()])
    return rows.selectExpr("pair", "z", "ya", "xa", "yb", "xb", f"cast({_TARGET} as double) as target")


_OVERLAPS = f"""with raw as (select {", ".join(f"{e.format(div='//', twenty='20.0::double')} as {n}" for n, e in _ROWS.items())} from lineitem),
rows as materialized (select pair, z, ya, xa, yb, xb, ({_TARGET})::double as target from raw)"""


def _field_rounds(name: str, rows: str) -> str:
    """Fields for each penalty p of the rows (p, ...), from zero on."""
    k = len(X.TERMS)
    parts = [f"{name}_in as materialized (select *, count(*) over (partition by p) as n from ({rows}))", f"{name}_fit0 as (select p, {', '.join(f'0.0::double as x{i}_0' for i in range(k))} from {name}_in group by p)"]
    for r in range(FIELD_ROUNDS):
        off = " + ".join(f"x{i}_0 * {d}" for i, d in enumerate(X.DESIGN))
        source = f"select i.*, 1 / sqrt(1 + (({off} - target) / 0.1) ** 2) as w from {name}_in i join {name}_fit{r} using (p)"
        sums = ", ".join(f"{e} / max(n) {'+ p ' if n in {f'a{i}_{i}' for i in range(k)} else ''}as {n}" for n, e in X.products(X.DESIGN, ["target"], "w").items())
        parts.append(f"{name}_sums{r} as materialized (select p, {sums} from ({source}) group by p)")
        parts.append(_solve(f"{name}_fit{r + 1}", f"{name}_sums{r}", k, 1, "p"))
    return ",\n".join(parts)


def _choice_sql() -> str:
    listed = ", ".join(f"({p}::double)" for p in PENALTIES)
    off = " + ".join(f"x{i}_0 * {d}" for i, d in enumerate(X.DESIGN))
    return f"""{_OVERLAPS}, penalties(p) as (values {listed}),
{_field_rounds("train", f"select p, rows.* from rows, penalties where not ({_HELD})")},
errors as (select p, avg(e) as error from (select p, pair, avg(abs({off} - target)) as e from rows, train_fit{FIELD_ROUNDS} where {_HELD} group by 1, 2) group by 1),
best as materialized (select p from errors order by error, p desc limit 1),
{_field_rounds("whole", "select p, rows.* from rows, best")}
select e.p as penalty, round(error, 7) as error, b.p is not null as chosen, {", ".join(f"round(x{i}_0, 6) as c{i}" for i in range(len(X.TERMS)))}
from errors e left join best b using (p) left join whole_fit{FIELD_ROUNDS} using (p)"""


@JOBS.add(_choice_sql())
def chosen_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each penalty's error on held-out pairs, and the chosen one's field of all rows."""
    best, own, errors = X.chosen_field(overlaps(spark, sf_dir), _HELD, PENALTIES)
    rows = [(p, float(e), p == best, *([float(v) for v in own] if p == best else [None] * len(own))) for p, e in errors.items()]
    names = [f"c{i}" for i in range(len(own))]
    found = spark.createDataFrame(rows, "penalty double, error double, chosen boolean, " + ", ".join(f"{n} double" for n in names))
    return found.select("penalty", F.round("error", 7).alias("error"), "chosen", *[F.round(n, 6).alias(n) for n in names])


def _planes_sql() -> str:
    k = len(X.TERMS)
    names = list(X.products(X.DESIGN, ["target"]))
    square = {f"a{i}_{i}" for i in range(k)}
    less = ", ".join(f"(select sum({n}) from own) - {n}{f' + {RIDGE} * ((select sum(n) from own) - n)' if n in square else ''} as {n}" for n in names)
    lone = ", ".join(f"{n}{f' + {RIDGE} * n' if n in square else ''} as {n}" for n in names)
    left = lambda f: f"sqrt(avg(({' + '.join(f'{f}.x{i}_0 * {d}' for i, d in enumerate(X.DESIGN))} - target) ** 2))"
    return f"""{_OVERLAPS}, own as materialized (select z, count(*) as n, {_sums(X.DESIGN, ["target"], "1.0::double")} from rows group by z),
rest as (select z, {less} from own), each_one as (select z, {lone} from own),
{_solve("shared", "rest", k, 1, "z")},
{_solve("lone", "each_one", k, 1, "z")},
near as (select a.z, arg_min(b.z, (abs(a.z - b.z), b.z)) as single from own a join own b on a.z <> b.z group by 1)
select r.z, count(*) as n, single, round(sqrt(avg(target * target)), 7) as before, round({left("shared")}, 7) as shared, round({left("lone")}, 7) as alone
from rows r join near using (z) join shared on shared.z = r.z join lone on lone.z = single group by r.z, single"""


@JOBS.add(_planes_sql())
def held_out_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What fields of other planes leave of each plane's log ratios. The SQL takes the residuals from the rows."""
    found = X.held_out_planes(overlaps(spark, sf_dir), RIDGE)
    return found.select("z", "n", "single", *[F.round(c, 7).alias(c) for c in ("before", "shared", "alone")])


# Displacements of points in windows; one in eleven is far off. Every third window has one z alone.
_POINTS = {
    "key": f"l_orderkey {{div}} {WINDOW}", "id": "l_orderkey * 8 + l_linenumber", "z": f"case when l_orderkey {{div}} {WINDOW} % 3 = 0 then 4 else l_orderkey % 23 end", "y": "l_partkey % 61", "x": "l_suppkey % 47",
    "noise": "(l_partkey % 7 - 3)", "far": "case when l_partkey % 11 = 0 then 1 else 0 end",
}
_MOVES = {"dz": "0.1 * z - 0.02 * y + 2 + 0.1 * noise + 9 * far", "dy": "0.05 * y + 0.03 * x - 1 - 0.2 * noise", "dx": "0.02 * z + 0.04 * x + 0.1 * noise - 14 * far"}


def displaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "lineitem").selectExpr(*[f"{e.format(div='div')} as {n}" for n, e in _POINTS.items()])
    rows = rows.groupBy("key", "id").agg(*[F.max(n).alias(n) for n in list(_POINTS)[2:]])
    return rows.selectExpr("key", "id", *[f"cast({a} as double) as {a}" for a in X.AXES], *[f"cast({e} as double) as {n}" for n, e in _MOVES.items()])


def _outliers_sql() -> str:
    scaled = ", ".join(f"case when max({a}) over w > min({a}) over w then ({a} - avg({a}) over w) / stddev_pop({a}) over w else 0 end as u{i + 1}" for i, a in enumerate(X.AXES))
    basis = ["1.0::double", "u1", "u2", "u3"]
    fit = " + ".join(f"x{i}_0 * {b}" for i, b in enumerate(basis))
    parts = [
        f"""with raw as (select key, id, {', '.join(f'max({n}) as {n}' for n in list(_POINTS)[2:])} from (select {', '.join(f"{e.format(div='//')} as {n}" for n, e in _POINTS.items())} from lineitem) group by 1, 2),
points as materialized (select key, id, z::double as z, y::double as y, x::double as x, {', '.join(f'({e})::double as {n}' for n, e in _MOVES.items())} from raw),
unit as (select *, {scaled} from points window w as (partition by key)),
rows as materialized (select key, id, u1, u2, u3, unnest(['z', 'y', 'x']) as part, unnest([dz, dy, dx]) as v from unit),
fit0 as materialized (select key, part, median(v) as x0_0, 0.0::double as x1_0, 0.0::double as x2_0, 0.0::double as x3_0 from rows group by 1, 2)"""
    ]
    for r in range(PLANE_ROUNDS):
        parts.append(f"sums{r} as materialized (select key, part, {_sums(basis, ['v'], 'w')} from (select rows.*, 1 / (1 + ((v - ({fit})) / {SCALE}) ** 2) as w from rows join fit{r} using (key, part)) group by 1, 2)")
        parts.append(_solve(f"fit{r + 1}", f"sums{r}", 4, 1, "key, part"))
    return (
        ",\n".join(parts)
        + f""",
scores as materialized (select key, id, sqrt(sum((v - ({fit})) ** 2)) as score from rows join fit{PLANE_ROUNDS} using (key, part) group by 1, 2),
middles as materialized (select key, median(score) as middle from scores group by 1),
limits as materialized (select key, least(greatest({LEAST}::double, middle + {SPREAD} * 1.4826 * mad), {MOST}) as threshold from middles join (select key, median(abs(score - middle)) as mad from scores join middles using (key) group by 1) using (key)),
marked as materialized (select *, score > threshold as outlier from scores join limits using (key))"""
    )


@JOBS.add(_outliers_sql() + "\nselect key, count(*) as n, count(*) filter (outlier) as outliers, round(max(threshold), 6) as threshold, round(max(score), 6) as worst from marked group by 1")
def displacement_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows' points that depart from the plane of their displacements."""
    found = X.displacement_outliers(displaced(spark, sf_dir), SCALE, SPREAD, LEAST, MOST, PLANE_ROUNDS)
    return found.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("outlier").cast("long")).alias("outliers"), F.round(F.max("threshold"), 6).alias("threshold"), F.round(F.max("score"), 6).alias("worst"))


def _repaired_sql() -> str:
    basis = ["1.0::double", "u1", "u2", "u3"]
    scaled = ", ".join(f"case when max({a}) over w > min({a}) over w then ({a} - avg({a}) over w) / stddev_pop({a}) over w else 0 end as u{i + 1}" for i, a in enumerate(X.AXES))
    at = ["1.0::double", *[f"case when s{a} > 0 then (p.{a} - m{a}) / s{a} else 0 end" for a in X.AXES]]
    values = ", ".join(f"round({' + '.join(f'x{i}_{c} * ({u})' for i, u in enumerate(at))}, 6) as d{a}" for c, a in enumerate(X.AXES))
    return (
        _outliers_sql()
        + f""",
inner_unit as (select *, {scaled} from (select points.* from points join marked using (key, id) where not outlier) window w as (partition by key)),
field_sums as materialized (select key, {", ".join(f"avg({a}) as m{a}, stddev_pop({a}) as s{a}" for a in X.AXES)}, {_sums(basis, ["dz", "dy", "dx"], "1.0::double")} from inner_unit group by key),
{_solve("field", "field_sums", 4, 3, ", ".join(["key", *[f"m{a}, s{a}" for a in X.AXES]]))}
select p.key, p.id, {values} from points p join marked using (key, id) join field using (key) where outlier"""
    )


@JOBS.add(_repaired_sql())
def predicted_displacements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the linear field of a window's other points says for the points that depart from it."""
    names = [f"d{a}" for a in X.AXES]
    marked = cut(X.displacement_outliers(displaced(spark, sf_dir), SCALE, SPREAD, LEAST, MOST, PLANE_ROUNDS).drop("score", "threshold"), "marked")
    fields = X.linear_fields(marked.where("not outlier"), names)
    return X.predicted(marked.where("outlier").select("key", "id", *X.AXES), fields, names).select("key", "id", *[F.round(n, 6).alias(n) for n in names])
