"""Jobs over neighbourhoods of a label volume. Their SQL joins each voxel with its neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkloom.functions.scratch import cut
from chunkloom.jobs.base import Jobs
from chunkloom.operators import stencils as X
from chunkloom.sources import adapters as A

JOBS = Jobs()
FILL, MARGIN, LEAST = 9, 1, 4
_GRID = """also near(dz, dy, dx) as (select a.d, b.d, c.d from (values (-1), (0), (1)) a(d), (values (-1), (0), (1)) b(d), (values (-1), (0), (1)) c(d)),
grid as materialized (select z::int as z, y::int as y, x::int as x, coalesce(label, 0) as label from (select * from range((select max(z) + 1 from voxels)) a(z), range((select max(y) + 1 from voxels)) b(y), range((select max(x) + 1 from voxels)) c(x)) left join voxels using (z, y, x))"""


def _summary(voxels: DataFrame) -> DataFrame:
    """By plane and label: voxels, and the sum of their places."""
    return voxels.groupBy("z", "label").agg(F.count("*").alias("n"), F.sum(F.col("y") * 1000 + F.col("x")).cast("long").alias("places"))


@JOBS.add(
    f"""{_GRID},
counts as (select v.z, v.y, v.x, v.label, count(*) filter (n.label = v.label) as same, count(*) filter (n.label = 0) as empty, count(*) filter (n.label > 0 and n.label <> v.label) as others,
    min(case when n.label > 0 and n.label <> v.label then n.label end) as low, max(case when n.label > 0 and n.label <> v.label then n.label end) as high
  from grid v join (select z - dz as z, y - dy as y, x - dx as x, label from grid, near where dz <> 0 or dy <> 0 or dx <> 0) n using (z, y, x) group by 1, 2, 3, 4),
done as (select z, y, x, case when label > 0 and same < 26 and others = 0 and empty > same then 0 when label > 0 and low = high and same + others >= {LEAST} and others > same + {MARGIN} then high
    when label = 0 and low = high and others >= {FILL} then high else label end as label from counts)
select z, label, count(*) as n, sum(y * 1000 + x)::bigint as places from done where label > 0 group by 1, 2""",
    "voxels",
)
def smoothed_label_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of smoothing of labels by their neighbours."""
    voxels = A.voxels(spark, sf_dir)
    return _summary(X.smoothed_labels(voxels, X.volume_shape(voxels), 1, FILL, MARGIN, LEAST))


@JOBS.add(
    f"""also near(dz, dy, dx) as (select a.d, b.d, c.d from (values (-1), (0), (1)) a(d), (values (-1), (0), (1)) b(d), (values (-1), (0), (1)) c(d)),
dense as materialized (select z, y, x, 1 + z // 5 * 9 + y // 12 * 3 + x // 12 as label from (select z::int as z, y::int as y, x::int as x from range((select max(z) + 1 from voxels)) a(z), range((select max(y) + 1 from voxels)) b(y), range((select max(x) + 1 from voxels)) c(x))
  anti join (select z, y, x from voxels where v % 16 = 0) using (z, y, x)),
core as materialized (select z, y, x, label from dense join (select z - dz as z, y - dy as y, x - dx as x, label from dense, near) n using (z, y, x, label) group by 1, 2, 3, 4 having count(*) = 27),
kept as (select distinct z + dz as z, y + dy as y, x + dx as x, label from core, near)
select z, label, count(*) as n, sum(y * 1000 + x)::bigint as places from dense anti join kept using (z, y, x, label) group by 1, 2""",
    "voxels",
)
def thin_label_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an opening by one step takes away of solid labels with holes."""
    voxels = A.voxels(spark, sf_dir)
    shape = X.volume_shape(voxels)
    places = spark.range(shape[0] * shape[1] * shape[2]).selectExpr(f"cast(id div {shape[1] * shape[2]} as int) as z", f"cast(id div {shape[2]} % {shape[1]} as int) as y", f"cast(id % {shape[2]} as int) as x")
    label = 1 + F.floor(F.col("z") / 5) * 9 + F.floor(F.col("y") / 12) * 3 + F.floor(F.col("x") / 12)
    dense = places.join(voxels.where("v % 16 = 0").select("z", "y", "x"), ["z", "y", "x"], "left_anti").withColumn("label", label)
    return _summary(X.thin_parts(dense, shape, 1))


@JOBS.add(
    """also held as materialized (select z, y, x, label, z::bigint * 1000000 + y * 1000 + x as place from voxels where label > 0),
links as materialized (select a.place as a, b.place as b from held a join held b on a.label = b.label and ((a.z + 1 = b.z and a.y = b.y and a.x = b.x) or (a.z = b.z and a.y + 1 = b.y and a.x = b.x) or (a.z = b.z and a.y = b.y and a.x + 1 = b.x))),
reach(node, root) as (select place, place from held union select b, root from reach join (select a, b from links union all select b, a from links) on a = node where root < b),
roots as (select node, min(root) as root from reach group by 1), pieces as materialized (select label, root, count(*) as n from held join roots on place = node group by 1, 2),
ranked as (select *, root <> min(root) over (partition by label) as extra from pieces)
select label, n, case when extra then (select max(label) from voxels) + row_number() over (partition by extra order by label, root) else label end as piece from ranked""",
    "voxels",
)
def relabelled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that fell into pieces get a label for each piece."""
    voxels = cut(A.voxels(spark, sf_dir).select("z", "y", "x", "label"), "voxels")
    return X.piece_sizes(voxels, X.volume_shape(voxels))


JOBS.sql["relabelled_pieces"] = JOBS.sql["relabelled_pieces"].replace("with voxels", "with recursive voxels", 1)
