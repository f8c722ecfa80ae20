"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: list[list[str]] = []


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder in local mode, else one in the warehouse.

    A warehouse without a file system of its own is a path on one machine: on a cluster, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master.startswith("local") and not master.startswith("local-cluster"):
            base = tempfile.mkdtemp(prefix="spark-")
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir")
            if "://" not in warehouse or warehouse.startswith("file:"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = warehouse.rstrip("/") + "/_scratch"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def cut(df: DataFrame, name: str = "cut", **options: str) -> DataFrame:
    """df through a Parquet table in that folder: cuts lineage and survives lost executors. options are the writer's."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for paths in _written:
        paths.append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scope() -> Iterator[list[str]]:
    """The folders that cut() writes meanwhile; what is no longer read can be removed afterwards."""
    paths: list[str] = []
    _written.append(paths)
    try:
        yield paths
    finally:
        _written[:] = [p for p in _written if p is not paths]


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that cut() wrote. No table that is still to be read may depend on them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)
