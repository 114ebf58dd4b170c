"""Reports on the state of the indicator base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_state(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy("state").agg(F.count(F.lit(1)).alias("indicators"))


def _open(unfinished: DataFrame) -> Column:
    """Number of rows, or their sum if the work comes counted."""
    return F.sum("open") if "open" in unfinished.columns else F.count(F.lit(1))


def unfinished_by_kind(unfinished: DataFrame) -> DataFrame:
    return unfinished.groupBy("kind").agg(_open(unfinished).alias("open")).orderBy(F.desc("open"), "kind")


def unfinished_by_indicator(unfinished: DataFrame) -> DataFrame:
    return unfinished.groupBy(F.col("x_num").alias("indicator_uuid")).agg(_open(unfinished).alias("open"))


def latest_upload(metadata: DataFrame) -> DataFrame:
    return metadata.agg(F.max("date").alias("latest_indicator_upload"))
