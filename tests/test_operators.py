"""Operators on small inputs with known results."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chunkloom.operators import geometry, graphs, inliers, labels, order, profiles, ranges, records, sampling, volumes
from chunkloom.operators import statistics as stats


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_moments_of_parts_merge_to_moments_of_the_whole(spark):
    box = [(z, y, x, 7, 1) for z in range(1, 4) for y in range(1, 5) for x in range(2, 5)] + [(z, y, x, 9, 2) for z in (0, 1) for y in (4, 5) for x in (0, 1)]
    voxels = spark.createDataFrame(box, "z int, y int, x int, label long, v long")
    parts = labels.partial_moments(voxels.withColumn("block", voxels.z % 2), "block")
    assert rows(labels.finish(labels.merge_moments(parts)), "label", "area", "centroid_z") == [(7, 36, 2.0), (9, 8, 0.5)]
    assert rows(labels.representative_plane(voxels), "label", "plane_z", "plane_area") == [(7, 2, 12), (9, 0, 4)]


def test_plane_tie_takes_the_lower(spark):
    voxels = spark.createDataFrame([(1, 0, 0, 4, 1), (3, 0, 0, 4, 1)], "z int, y int, x int, label long, v long")
    assert rows(labels.representative_plane(voxels), "plane_z") == [(1,)]


def test_reciprocal_best_leaves_ties_out(spark):
    counts = spark.createDataFrame([(0, 1, 1, 5, 10, 10), (0, 1, 2, 5, 10, 10), (1, 3, 3, 9, 10, 10)], "band int, a long, b long, both long, area_a long, area_b long")
    assert rows(labels.reciprocal_best(counts), "band", "a", "b") == [(1, 3, 3)]


def test_unknown_label_is_an_error(spark):
    volumes = spark.createDataFrame([(1, 5)], "label long, area long")
    with pytest.raises(Exception, match="without a final id"):
        labels.mapped_volumes(volumes, spark.createDataFrame([(2, 1)], "label long, final long")).collect()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, None)], "a long, b long")
    found = dict(rows(graphs.components(edges), "node", "root"))
    assert {found[i] for i in range(41)} == {0} and found[101] == 100


def test_components_of_nothing(spark):
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_box_pairs_count_once_across_cells(spark):
    boxes = spark.createDataFrame([(1, 0, 500, 0, 500, 0), (2, 100, 400, 100, 400, 1), (3, 500, 600, 0, 10, 1)], "id long, lo long, hi long, y_lo long, y_hi long, source long")
    assert rows(geometry.box_pairs(boxes, 64, 64), "a", "b", "overlap_x") == [(1, 2, 300)]


def test_empty_range_is_an_error(spark):
    with pytest.raises(Exception, match="no range"):
        stats.scaling(spark.createDataFrame([("a", 3), ("a", 3)], "channel string, v long"), 0.1, 0.9, 10).collect()


def test_budget_is_spent(spark):
    groups = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "group string, n long")
    assert rows(order.largest_remainder(groups, 5), "group", "seats") == [("a", 2), ("b", 2), ("c", 1)]


VOXEL = "z int, y int, x int, label long, v double"


def test_one_nan_makes_a_label_nan(spark):
    voxels = spark.createDataFrame([(0, 0, 0, 1, 1.0), (0, 0, 1, 1, 2.0), (1, 0, 0, 1, 3.0), (1, 0, 1, 1, math.nan), (0, 1, 0, 2, 5.0)], VOXEL)
    found = {r["label"]: r for r in labels.float_moments(voxels).collect()}
    assert all(math.isnan(found[1][c]) for c in ("mean", "least", "most")) and found[1]["area"] == 4
    assert (found[2]["mean"], found[2]["least"], found[2]["most"]) == (5.0, 5.0, 5.0)


@pytest.mark.parametrize("moments, planes", [([(1, 3)], []), ([(1, 3)], [(1, 0, 3), (2, 0, 1)])])
def test_labels_and_planes_have_to_agree(spark, moments, planes):
    joined = labels.with_planes(spark.createDataFrame(moments, "label long, area long"), spark.createDataFrame(planes, "label long, plane_z int, plane_area long"))
    with pytest.raises(Exception, match="labels of moments and planes differ"):
        joined.collect()


def test_fractions_that_are_nearly_equal_are_told_apart(spark):
    n = 1 << 29
    counts = [(0, 1, 1, n, 2 * n, n + 1), (0, 1, 2, n - 1, 2 * n - 1, n), (1, 1, 1, 2, 3, 3), (1, 1, 2, 4, 6, 6)]
    # n / (2n + 1) against (n - 1) / (2n): equal as double quotients to 9 digits; 2/4 against 4/8: equal.
    assert rows(labels.reciprocal_best(spark.createDataFrame(counts, "band int, a long, b long, both long, area_a long, area_b long")), "band", "a", "b") == [(0, 1, 1)]


def test_quantiles_of_one_key_match_numpy(spark):
    rng = np.random.default_rng(0)
    values = [int(v) for v in np.concatenate([rng.integers(0, 50, 300), rng.integers(0, 10**9, 300)])]
    table = spark.createDataFrame([("a", v) for v in values] + [("b", 7), ("c", None)], "k string, v long")
    found = {r["k"]: r for r in ranges.quantiles(table, "k", "v", (0.0, 0.3, 0.5, 1.0)).collect()}
    assert [found["a"][f"q{i}"] for i in range(4)] == pytest.approx(list(np.quantile(values, [0, 0.3, 0.5, 1])))
    assert set(found) == {"a", "b"} and found["b"]["q1"] == 7.0 and found["a"]["n"] == 600


def test_numbers_and_running_sums_over_ranges(spark):
    table = spark.createDataFrame([("a", v * v, 1) for v in range(50)], "k string, v long, n long")
    assert rows(ranges.numbered(table.select("k", "v"), "k", "v"), "v", "number") == [(v * v, v + 1) for v in range(50)]
    assert rows(ranges.running(table, "k", "v", "n", parts=7), "v", "through", "total") == [(v * v, v + 1, 50) for v in range(50)]


def brute_stabbing(boxes):
    planes = []
    for lo, hi in sorted(boxes, key=lambda b: (b[1], b[0])):
        if hi > lo and (not planes or planes[-1] < lo):
            planes.append(hi - 1)
    return planes


def test_windows_and_planes_match_brute_force(spark):
    rnd = random.Random(3)
    for n in (1, 5, 60):
        boxes = [(lo, lo + rnd.randrange(0, 9)) for lo in (rnd.randrange(200) for _ in range(n))]
        table = spark.createDataFrame([(i, 0, lo, hi) for i, (lo, hi) in enumerate(boxes)], "id long, source long, lo long, hi long")
        assert sorted(p for _, p in rows(order.greedy_stabbing(table), "source", "plane")) == brute_stabbing(boxes)
        merged = []
        for lo, hi in sorted(boxes):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]), merged[-1][2] + 1)
            else:
                merged.append((lo, hi, 1))
        assert rows(geometry.merged_windows(table), "start", "stop", "members") == merged


def test_components_of_a_star_and_a_loop(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 3000)] + [(5000, 5001), (7, 7)], "a long, b long")
    found = dict(rows(graphs.components(edges), "node", "root"))
    assert len(found) == 3002 and {found[i] for i in range(3000)} == {0} and found[5001] == 5000


def test_far_tiles_are_an_error_not_lost(spark):
    edges = spark.createDataFrame([(i, i + 1, True) for i in range(6)], "fixed long, moving long, accepted boolean")
    assert rows(graphs.depths(edges, 0, 8), "node", "depth") == [(i, i) for i in range(7)]
    with pytest.raises(RuntimeError, match="edges or more"):
        graphs.depths(edges, 0, 5)


def test_publish_lists_whole_versions(spark, tmp_path):
    root, kind = str(tmp_path), "a long"
    with pytest.raises(FileNotFoundError):
        records.latest(spark, root, kind)
    for n in (3, 5):
        assert records.publish(spark.range(n).select(spark.range(1).columns[0]).withColumnRenamed("id", "a"), root) == n
        assert records.latest(spark, root, kind).count() == n


def test_repeated_keys_and_unknown_names_are_errors(spark):
    once = spark.createDataFrame([(1, "a"), (2, "b")], "k long, name string")
    assert records.require_unique(once, "k").count() == 2
    with pytest.raises(Exception, match="a key occurs twice: 1"):
        records.require_unique(once.union(once), "k").collect()
    tiles = spark.createDataFrame([("a", 0)], "name string, index long")
    with pytest.raises(Exception, match="no tile has the name b"):
        records.with_index(spark.createDataFrame([("a", "b")], "fixed string, moving string"), tiles).collect()


@pytest.mark.parametrize("text", ["Count = 2\nBEGIN Position1\nX = 1\nY = 2\nZ = 3\nEND\n", "Count = 1\nBEGIN Position2\nX = 1\nY = 2\nZ = 3\nEND\n", "Count = 1\nBEGIN Position1\nX = 1\nX = 1\nY = 2\nZ = 3\nEND\n"])
def test_stage_positions_are_strict(spark, tmp_path, text):
    (tmp_path / "a.pos").write_text(text)
    with pytest.raises(Exception, match="as declared|has to occur once"):
        records.stage_positions(spark, str(tmp_path)).collect()


def test_half_width_interpolates_and_needs_both_sides(spark):
    table = spark.createDataFrame([("a", b, v) for b, v in enumerate([0.0, 0.25, 1.0, 0.25, 0.0])] + [("b", b, v) for b, v in enumerate([1.0, 0.25, 0.0])] + [("c", 0, 0.0)], "key string, bin long, v double")
    found = dict(rows(profiles.half_widths(table), "key", "width"))
    assert found["a"] == pytest.approx(2 * (1 - 1 / 3)) and found["b"] is None and found["c"] is None


def test_crossings_stop_at_missing_support(spark):
    table = spark.createDataFrame([("a", b, v, 5) for b, v in ((0, 0.0), (1, 4.0), (2, 10.0), (4, 1.0))], "key string, bin long, v double, n long")
    found = {s: (d, k) for s, d, k in rows(profiles.crossings(table, 0.5), "side", "depth", "support")}
    assert found["falling"] == (None, 0) and found["rising"] == (pytest.approx(1 + 1 / 6), 5)


def brute_agreeing(shifts, bounds):
    best = []
    for mask in range(1, 1 << len(shifts)):
        own = [i for i in range(len(shifts)) if mask >> i & 1]
        if all(abs(shifts[i][a] - shifts[j][a]) <= bounds[a] for i in own for j in own for a in range(3)) and (len(own) > len(best) or (len(own) == len(best) and own < best)):
            best = own
    return best


def test_largest_agreeing_set_matches_all_subsets():
    rnd = random.Random(4)
    for _ in range(60):
        shifts = [[rnd.randrange(6) for _ in range(3)] for _ in range(rnd.randrange(1, 8))]
        assert list(inliers.largest_agreeing(np.array(shifts, float), np.array([1.0, 2.0, 2.0]))) == brute_agreeing(shifts, (1, 2, 2))


def test_both_treatments_of_missing_support(spark):
    at = "z int, y int, x int, v long"
    target = spark.createDataFrame([(0, 0, 0, 10), (0, 0, 1, 10), (0, 0, 2, 10), (0, 0, 3, 0)], at)
    other = spark.createDataFrame([(0, 0, 0, 4), (0, 0, 1, 0), (0, 0, 3, 9)], at)
    assert [v for _, v in rows(volumes.subtracted(target, other, 1.5, 0.5, False), "x", "v")] == [4, 0, 0, 0]
    assert [v for _, v in rows(volumes.subtracted(target, other, 1.5, 0.5, True), "x", "v")] == [4, 10, 10, 0]


def test_samples_do_not_depend_on_partitions(spark):
    stacks = spark.range(30).select(spark.range(1).columns[0]).withColumnRenamed("id", "stack").selectExpr("stack", "stack % 7 as planes")
    one, two = (rows(sampling.uniform_planes(stacks.repartition(n), 12, "s"), "stack", "z") for n in (1, 6))
    assert one == two and len(set(one)) == 12


def test_sizes_round_halves_to_even(spark):
    from chunkloom.functions.scalars import human_bytes

    sizes = [0, 1023, 1024, 112_896, 112_640 + 768, 484_704_256, 1_073_741_824 * 5 // 4, 1 << 50]
    got = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", human_bytes(F.col("n")).alias("s")).collect()
    units = [(1 << 10 * k, u) for k, u in ((4, "TiB"), (3, "GiB"), (2, "MiB"), (1, "KiB"))]
    want = {n: next((f"{n / d:.1f} {u}" for d, u in units if n >= d), f"{n} B") for n in sizes}
    assert {r["n"]: r["s"] for r in got} == want and want[112_896] == "110.2 KiB"


def test_clipped_areas_against_closed_forms(spark):
    from chunkloom.functions.scalars import clipped_area

    square, triangle = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(0.0, 0.0), (6.0, 0.0), (0.0, 6.0)]
    cases = [
        (square, (1, 3, 1, 3), 4.0), (square, (-9, 9, -9, 9), 16.0), (square, (5, 9, 0, 4), 0.0), (square, (4, 9, 0, 4), 0.0), (square, (2, 9, -3, 1), 2.0), (square[::-1], (2, 9, -3, 1), 2.0),
        (triangle, (0, 6, 0, 6), 18.0), (triangle, (3, 9, 0, 9), 4.5), (triangle, (0, 2, 0, 2), 4.0), (triangle, (2, 6, 2, 6), 2.0), ([], (0, 1, 0, 1), 0.0), ([(1.0, 1.0), (2.0, 2.0)], (0, 3, 0, 3), 0.0),
    ]
    rows = [(i, p, *map(float, box)) for i, (p, box, _) in enumerate(cases)]
    table = spark.createDataFrame(rows, "i int, p array<struct<x:double,y:double>>, a double, b double, c double, d double")
    got = {r["i"]: r["area"] for r in table.select("i", clipped_area(F.col("p"), *[F.col(c) for c in "abcd"]).alias("area")).collect()}
    assert got == {i: pytest.approx(want) for i, (*_, want) in enumerate(cases)}


def test_publishers_at_once_get_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = f"file://{tmp_path}/store"
    assert records.versions(spark, root).count() == 0 and not (tmp_path / "store").exists()
    with ThreadPoolExecutor(4) as pool:
        written = list(pool.map(lambda k: records.publish(spark.range(k + 1), root), range(4)))
    held = records.versions(spark, root).collect()
    assert written == [1, 2, 3, 4] and sorted(r["version"] for r in held) == [1, 2, 3, 4] and sorted(r["n"] for r in held) == written
    last = max(held, key=lambda r: r["version"])
    before = sorted(p.name for p in (tmp_path / "store" / "versions").iterdir())
    assert records.latest(spark, root, "id long").count() == last["n"]
    assert sorted(p.name for p in (tmp_path / "store" / "versions").iterdir()) == before  # readers write nothing
