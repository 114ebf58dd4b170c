"""Intermediate tables that several jobs of one run read."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only in local mode."""
    # a folder set by an explicit call wins over the session's setting
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="hexstats-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_open_areas: list[list[str]] = []


def stage(df: DataFrame) -> DataFrame:
    """Write once, read often.

    Cuts the lineage like a checkpoint, but columnar: later passes read only the columns they
    use, and the planner knows the table's size when it chooses a join. Losing executors costs
    nothing, the files are in shared storage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _open_areas:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_area(spark: SparkSession):
    """Staged tables made inside are deleted at the end, so what is to last must be written before."""
    paths: list[str] = []
    _open_areas.append(paths)
    try:
        yield
    finally:
        _open_areas.remove(paths)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
