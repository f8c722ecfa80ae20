"""Streams of several files: merged batches, a restart in the middle, late rows."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chunkloom.streaming import slabs


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def read(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_a_stopped_stream_goes_on_and_counts_each_file_once(spark, tmp_path):
    schema, data, state = "slab long, v long", tmp_path / "data", str(tmp_path / "state")
    expected = {}
    for part in range(2):
        for k in range(3):
            rows = [(s, 10 * part + k + s) for s in range(4)]
            for s, v in rows:
                expected.setdefault(s, []).append(v)
            write(spark, data, rows, schema)
        found = slabs.partial_sums(read(spark, data, schema), state).collect()
        assert {r["slab"]: (r["n"], r["total"], r["least"], r["most"]) for r in found} == {s: (len(v), sum(v), min(v), max(v)) for s, v in expected.items()}
    assert len(list((tmp_path / "state" / "parts").glob("batch=*"))) == 6  # a file a batch
    again = slabs.partial_sums(read(spark, data, schema), state).agg(F.sum("n")).first()[0]
    assert again == 24


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    start, schema, data = datetime(2024, 1, 1), "kind string, ts timestamp", tmp_path / "data"
    for batch in ([0, 1], [30], [31], [2], [29]):  # hours; the fourth comes 28 hours late
        write(spark, data, [("a", start + timedelta(hours=h)) for h in batch], schema)
    files = sorted(data.glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    found = slabs.hourly_counts(read(spark, data, schema), str(tmp_path / "state"), "2 hours").collect()
    assert len(files) == 5 and {(r["start"] - start).total_seconds() / 3600: r["n"] for r in found} == {0: 1, 1: 1, 30: 1, 29: 1, 31: 1}
    patient = slabs.hourly_counts(read(spark, data, schema), str(tmp_path / "patient"), "30 hours").collect()
    assert {(r["start"] - start).total_seconds() / 3600 for r in patient} == {0, 1, 2, 29, 30, 31}


def test_halos_reach_the_neighbours_only(spark):
    rows = spark.range(12).select(F.col("id").alias("z"))
    found = sorted((r["slab"], r["z"], r["core"]) for r in slabs.with_halos(rows, 5, 1).where("slab < 2").collect())
    assert [z for s, z, core in found if s == 0] == [0, 1, 2, 3, 4, 5] and [z for s, z, core in found if s == 1 and not core] == [4, 10]


def test_sessions_close_by_the_watermark_and_over_a_restart(spark, tmp_path):
    start, schema, data, state = datetime(2024, 1, 1), "kind string, ts timestamp", tmp_path / "data", str(tmp_path / "state")
    minutes = lambda found: sorted((r["kind"], (r["start"] - start).total_seconds() / 60, (r["stop"] - start).total_seconds() / 60, r["n"]) for r in found.collect())

    def run(*batches):
        for batch in batches:
            write(spark, data, [(k, start + timedelta(minutes=m)) for k, m in batch], schema)
        return minutes(slabs.closed_sessions(read(spark, data, schema), state, "10 minutes", "30 minutes"))

    # The second file joins the first one's sessions; nothing is closed before minute 40 + 30 has been seen.
    assert run([("a", 0), ("b", 3)], [("a", 5), ("a", 14), ("a", 30)]) == []
    # Minute 100 closes what ended by 70; rows are late by the watermark of two files before, so that of minute 6 goes.
    assert run([("a", 100)], [("a", 105)], [("a", 6)]) == [("a", 0, 24, 3), ("a", 30, 40, 1), ("b", 3, 13, 1)]
    assert run([("b", 200)]) == [("a", 0, 24, 3), ("a", 30, 40, 1), ("a", 100, 115, 2), ("b", 3, 13, 1)]
