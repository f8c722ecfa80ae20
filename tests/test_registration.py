"""Registrations with tiles apart, and manifests that no longer match."""

import tempfile

import pytest
from pyspark.errors import PySparkException

from chunkloom.operators import records as R
from chunkloom.operators import registration as G

SCHEMA = "tile long, z double, y double, x double, affine array<array<double>>"


def grid(spark, apart):
    """A plane of 5 x 5 tiles of which `apart` have no accepted constraint."""
    at = [(i, j) for i in range(5) for j in range(5)]
    near = [(5 * i + j, 5 * (i + a) + j + b) for i, j in at for a, b in ((0, 1), (1, 0)) if i + a < 5 and j + b < 5]
    tiles = spark.createDataFrame([(5 * i + j, 0.0, float(i), float(j)) for i, j in at], "tile long, z double, y double, x double")
    pairs = spark.createDataFrame([(f, m, f not in apart and m not in apart) for f, m in near * 2], "fixed long, moving long, accepted boolean")
    return tiles, pairs


def published(spark, apart, policy, anchor=0):
    root = tempfile.mkdtemp(prefix="spark-")
    tiles, pairs = grid(spark, apart)
    done = G.publish_registration(tiles, pairs, pairs, anchor, root, policy)
    return done, R.latest(spark, root, SCHEMA).collect()


def test_connected_tiles_are_all_published(spark):
    done, rows = published(spark, (), "edges")
    assert done == G.Registration(25, 25, 25, False)
    assert {(r["tile"], r["y"], r["x"]) for r in rows} == {(t, float(t // 5), float(t % 5)) for t in range(25)}
    assert all(r["affine"] == [[float(i == j) for j in range(4)] for i in range(3)] for r in rows)


def test_tiles_of_the_edge_may_be_apart(spark):
    done, rows = published(spark, (4, 22), "edges")
    assert done == G.Registration(25, 25, 23, True) and len(rows) == 25


def test_an_inner_tile_apart_is_refused_and_nothing_published(spark):
    root = tempfile.mkdtemp(prefix="spark-")
    tiles, pairs = grid(spark, (4, 12))
    with pytest.raises(ValueError, match="23 of 25 tiles are connected, and 1 of"):
        G.publish_registration(tiles, pairs, pairs, 0, root)
    assert R.versions(spark, root).count() == 0


def test_tiles_apart_are_allowed_or_left_out_when_asked(spark):
    done, rows = published(spark, (12,), "allow")
    assert done == G.Registration(25, 25, 24, False) and len(rows) == 25
    done, rows = published(spark, (12, 4), "exclude")
    assert done == G.Registration(23, 25, 23, False) and {r["tile"] for r in rows} == set(range(25)) - {4, 12}
    done, rows = published(spark, (12,), "exclude", anchor=12)
    assert done.rows == 1 and rows[0]["tile"] == 12


def test_faults_of_the_given_tables(spark):
    tiles, pairs = grid(spark, ())
    place = lambda: tempfile.mkdtemp(prefix="spark-")
    with pytest.raises(ValueError, match="policy"):
        G.publish_registration(tiles, pairs, pairs, 0, place(), "some")
    with pytest.raises(ValueError, match="twice"):
        G.publish_registration(tiles.union(tiles.limit(1)), pairs, pairs, 0, place())
    with pytest.raises(ValueError, match="no position"):
        G.publish_registration(tiles.where("tile <> 3"), pairs, pairs, 0, place())
    with pytest.raises(ValueError, match="no position"):
        G.publish_registration(tiles, pairs, pairs, 99, place())
    root = place()
    G.publish_registration(tiles, pairs, pairs, 0, root)
    with pytest.raises(FileExistsError):
        G.publish_registration(tiles, pairs, pairs, 0, root)


FILES = "side string, tile long, axes string, shape array<long>, spacing array<double>, channels array<string>, bytes long"


def files(spark, **changed):
    row = {"side": "l", "axes": "CZYX", "shape": [2, 8, 64, 64], "spacing": [1.0, 0.5, 0.5], "channels": ["561", "488"], "bytes": 10}
    rows = [row | {"tile": i} for i in range(4)] + [row | {"side": "r", "tile": i} for i in range(3)]
    rows[1] |= changed
    return spark.createDataFrame([tuple(r[c] for c in "side tile axes shape spacing channels bytes".split()) for r in rows], FILES)


def test_a_manifest_of_files_that_agree(spark):
    got = {r["side"]: r for r in G.manifest(files(spark, bytes=13), "561").collect()}
    assert {s: (r["tiles"], r["bytes"], r["channels"]) for s, r in got.items()} == {"l": (4, 43, ["561", "488"]), "r": (3, 30, ["561", "488"])}
    assert G.manifest(files(spark).limit(0), "561").count() == 0


@pytest.mark.parametrize("changed", [{"spacing": [1.0, 0.5, 0.25]}, {"shape": [2, 8, 64, 63]}, {"axes": "ZCYX"}, {"channels": ["561", "640"]}, {"shape": None}])
def test_files_that_differ_are_an_error(spark, changed):
    with pytest.raises(PySparkException, match="side l: files differ in layout"):
        G.manifest(files(spark, **changed), "561").collect()


def test_faults_of_channels(spark):
    one = lambda **c: files(spark, side="m", **c).where("side = 'm'")
    for fault, own in (("twice", one(channels=["561", "561"])), ("no channel 561", one(channels=["488", "640"])), ("disagree", one(shape=[3, 8, 64, 64])), ("disagree", one(axes="ZYX", shape=[8, 64, 64]))):
        with pytest.raises(PySparkException, match=fault):
            G.manifest(own, "561").collect()
    assert G.manifest(one(axes="ZYX", shape=[8, 64, 64], channels=["561"]), "561").count() == 1


def test_differences_count_repeated_rows_and_nulls(spark):
    held = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k long, v string")
    found = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (3, "d")], "k long, v string")
    assert {tuple(r) for r in G.differences(held, found).collect()} == {(1, "a", "gone", 1), (3, "c", "gone", 1), (3, "d", "new", 2)}
    G.require_same(held, held.orderBy("k"))
    with pytest.raises(ValueError, match="2 rows are gone and 2 are new"):
        G.require_same(held, found)
