"""Points and the nearest triangles of a mesh. Their SQL compares every point with every triangle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.jobs.base import Jobs
from chunkloom.operators import mesh as X
from chunkloom.operators import volumes as V
from chunkloom.sources import adapters as A

JOBS = Jobs()
CELL, MOST = 12.0, 25.0
#: Places of a vertex: pieces of the mesh lie side by side, 16 in a row.
_PLACE = {"x": "({v} // 64) % 16 * 48 + {v} * 37 % 41", "y": "({v} // 64) // 16 * 48 + {v} * 53 % 43", "z": "{v} * 29 % 31"}


CORNERS = ("v0", "v1", "v2")


def triangles(faces: DataFrame) -> DataFrame:
    """(face, v0, v1, v2, ax, ay, ... cz): triangles at whole-number places."""
    rows = faces.selectExpr("(v0 * 64 + v1 % 64) * 64 + v2 % 64 as face", *CORNERS)
    return rows.selectExpr("*", *[f"cast({_PLACE[k].format(v=f'v{i}').replace('//', 'div')} as double) as {c}{k}" for i, c in enumerate(X.CORNERS) for k in X.AXES])


def nearest(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The nearest triangles; of equal ones, one is found."""
    return X.closest_triangles(points(spark, sf_dir), triangles(A.faces(spark, sf_dir)), CELL, keep)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, px, py, pz): points within the mesh, beside it and far from it."""
    return A.boxes(spark, sf_dir).selectExpr("id", "cast(id * 131 % 1000 - 100 as double) as px", "cast(id * 2 as double) as py", "cast(y_lo % 90 - 30 as double) as pz")


_PLACED = ", ".join(f"({_PLACE[k].format(v=f'v{i}')})::double as {c}{k}" for i, c in enumerate("fgh") for k in X.AXES)


def _dot(p: str, q: str) -> str:
    return " + ".join(f"{p}{k} * {q}{k}" for k in X.AXES)


def _minus(p: str, q: str, name: str) -> str:
    return ", ".join(f"{p}{k} - {q}{k} as {name}{k}" for k in X.AXES)


def _edge(name: str, weights: tuple[str, str, str]) -> str:
    return f"case when {name}t > 0 and {name}t < {name}l then {{'d2': ({name}o * {name}l - {name}t * {name}t) / {name}l, 'feature': 'edge', 'b0': {weights[0]}, 'b1': {weights[1]}, 'b2': {weights[2]}}} end"


_VERTICES = [f"{{'d2': {o}, 'feature': 'vertex', 'b0': {float(k == 0)}::double, 'b1': {float(k == 1)}::double, 'b2': {float(k == 2)}::double}}" for k, o in enumerate(("abo", "bco", "cao"))]
_NEAR = f"""also pts as (select id, (id * 131 % 1000 - 100)::double as px, (id * 2)::double as py, (y_lo % 90 - 30)::double as pz from boxes),
mesh as (select (v0 * 64 + v1 % 64) * 64 + v2 % 64 as face, v0, v1, v2, {_PLACED} from (select distinct * from faces)),
bound as (select id, min((fx - px) * (fx - px) + (fy - py) * (fy - py) + (fz - pz) * (fz - pz)) as best from pts, mesh group by id),
met as (select * from pts join bound using (id) join mesh on greatest(least(fx, gx, hx) - px, px - greatest(fx, gx, hx), 0) ** 2 + greatest(least(fy, gy, hy) - py, py - greatest(fy, gy, hy), 0) ** 2 + greatest(least(fz, gz, hz) - pz, pz - greatest(fz, gz, hz), 0) ** 2 <= best),
offs as (select id, face, {_minus("g", "f", "u")}, {_minus("h", "f", "v")}, {_minus("h", "g", "s")}, {_minus("p", "f", "w")}, {_minus("p", "g", "q")}, {_minus("p", "h", "r")} from met),
sums as (select id, face, {_dot("u", "u")} as uu, {_dot("u", "v")} as uv, {_dot("v", "v")} as vv, {_dot("w", "u")} as wu, {_dot("w", "v")} as wv,
  (uy * vz - uz * vy) * wx + (uz * vx - ux * vz) * wy + (ux * vy - uy * vx) * wz as height,
  {_dot("w", "w")} as abo, {_dot("u", "u")} as abl, {_dot("u", "w")} as abt, {_dot("q", "q")} as bco, {_dot("s", "s")} as bcl, {_dot("s", "q")} as bct,
  {_dot("r", "r")} as cao, {_dot("v", "v")} as cal, -({_dot("v", "r")}) as cat from offs),
parts as (select *, uu * vv - uv * uv as area, vv * wu - uv * wv as s, uu * wv - uv * wu as t from sums),
places as (select id, face, list_min(list_filter([
  case when s > 0 and t > 0 and area - s - t > 0 then {{'d2': height * height / area, 'feature': 'face', 'b0': (area - s - t) / area, 'b1': s / area, 'b2': t / area}} end,
  {_edge("ab", ("(abl - abt) / abl", "abt / abl", "0.0::double"))}, {_edge("bc", ("0.0::double", "(bcl - bct) / bcl", "bct / bcl"))}, {_edge("ca", ("cat / cal", "0.0::double", "(cal - cat) / cal"))},
  {", ".join(_VERTICES)}], lambda x: x is not null)) as p from parts),
near as (select id, unnest(min({{'d2': p.d2, 'face': face, 'feature': p.feature, 'b0': p.b0, 'b1': p.b1, 'b2': p.b2}})) from places group by id)
"""


@JOBS.add(_NEAR + "select id, face, feature, round(sqrt(d2), 9) as distance, round(b0, 9) as b0, round(b1, 9) as b1, round(b2, 9) as b2 from near", "boxes", "faces")
def closest_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest triangle of each point, with its feature and barycentric place."""
    return nearest(spark, sf_dir).select("id", "face", "feature", F.round(F.sqrt("d2"), 9).alias("distance"), *[F.round(f"b{k}", 9).alias(f"b{k}") for k in range(3)])


@JOBS.add(_NEAR + "select id as cell, round(b0 * (v0 * 37 % 101) + b1 * (v1 * 37 % 101) + b2 * (v2 * 37 % 101), 6) as value from near join mesh using (face)", "boxes", "faces")
def nearest_surface_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a surface at the places nearest to points."""
    vertices = A.faces(spark, sf_dir).select(F.explode(F.array(*CORNERS)).alias("vertex")).distinct().withColumn("value", (F.col("vertex") * 37 % 101).cast("double"))
    cells = nearest(spark, sf_dir, *CORNERS).withColumnRenamed("id", "cell")
    return V.on_faces(cells, None, vertices).withColumn("value", F.round("value", 6))


@JOBS.add(
    _NEAR
    + """, edges as (select least(a, b) as a, greatest(a, b) as b from (select v0 as a, v1 as b from mesh union all select v1, v2 from mesh union all select v2, v0 from mesh)), rims as (select a, b from edges group by 1, 2 having count(*) = 1),
on_mesh as (select *, list_filter([case when b0 > 0 then v0 end, case when b1 > 0 then v1 end, case when b2 > 0 then v2 end], lambda x: x is not null) as ends,
  ((gy - fy) * (hz - fz) - (gz - fz) * (hy - fy)) * (px - fx) + ((gz - fz) * (hx - fx) - (gx - fx) * (hz - fz)) * (py - fy) + ((gx - fx) * (hy - fy) - (gy - fy) * (hx - fx)) * (pz - fz) as height from near join mesh using (face) join pts using (id)),
rimmed as (select *, case feature when 'edge' then exists (select 1 from rims where a = list_min(ends) and b = list_max(ends)) when 'vertex' then list_min(ends) in (select a from rims union select b from rims) else false end as rim from on_mesh)
select id, round(sqrt(d2), 9) as depth, rim, height <= 0 and not rim and sqrt(d2) <= """
    + f"{MOST} as inside from rimmed",
    "boxes",
    "faces",
)
def surface_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which points lie under the surface, near it and off its rim."""
    found = nearest(spark, sf_dir, "px", "py", "pz", *CORNERS, *X.PLACED)
    return X.sides(found, A.faces(spark, sf_dir), MOST).withColumn("depth", F.round("depth", 9))
