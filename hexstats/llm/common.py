"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now.

    It does so when the driver's garbage collector finds that nothing refers to them, which may
    come long after a job that moved whole texts.
    """
    spark.sparkContext._jvm.System.gc()


def map_texts(
    docs: DataFrame, score: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str, *columns: str
) -> DataFrame:
    """Apply ``score`` to the Arrow batches of the given columns; rows stay where they are.

    Large results come in several batches, so that a task never holds those of a whole batch.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from score(batch)

    return docs.select(*columns).mapInArrow(over, schema)


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int, longest: int, allowed: Column | None = None) -> DataFrame:
    """(text, quality, doc_id) of a bounded sample of labelled documents.

    At most ``per_class`` documents of each quality, those with the smallest hash of doc_id, and
    none over ``longest`` bytes, so what is brought to the driver has a fixed limit. A document
    with conflicting labels, no label or no id is left out. ``allowed`` limits the doc_ids used.
    """
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(allowed if allowed is not None else F.lit(True))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_high"))
        .filter(F.col("quality") == F.col("_high"))
        .select("doc_id", "quality")
    )
    fitting = docs.filter(F.octet_length("text") <= longest).select("doc_id", "text")
    chosen = [
        known.filter(F.col("quality") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for kind in (0, 1)
    ]
    # at most 2 * per_class rows of two numbers: a proven bound
    return fitting.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").select("doc_id", "text", "quality")
