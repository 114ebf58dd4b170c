"""Picking up uploads as they arrive.

A file stream hands every file to some batch, but a batch that was cut off is handed over again, and the files of
one upload may come in several batches. Two things make up for that: a ledger of the batches that were handled,
and a landing place where the parts of an upload wait for each other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from hexstats import schemas
from hexstats.sources.stored import delete_folders, exists, folder_of

_LAYOUT = StructType([*schemas.FACTS.fields, StructField("upload_id", StringType())])
_LANDED = StructType([*_LAYOUT.fields, StructField("landed_at", TimestampType()), StructField("batch", LongType())])


def _started(
    spark: SparkSession, path: str, checkpoint: str, batch: Callable[[DataFrame, int], None], every: str | None, files: int | None
) -> StreamingQuery:
    reader = spark.readStream.schema(_LAYOUT)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return reader.parquet(path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def watch_uploads(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    handle: Callable[[DataFrame, DataFrame], None],
    every: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Hand newly arrived uploads to ``handle(staged, uploads)``.

    Uploads lie in ``<path>/upload_id=<id>/`` and must be complete when their folder appears; see ``Landing``
    for those that are not. ``every`` is the polling interval; without it everything present is handled
    once and the query ends. ``staged`` holds the rows and ``uploads`` the upload ids, as ``ingest`` wants them.

    A batch may be handed over again after a failure. With a ``ledger``, a folder of its own, batches that were
    handled to the end are left out; one that was cut off inside ``handle`` comes again, so that must
    bear repetition, as the stored ingest does.
    """

    def batch(rows: DataFrame, number: int) -> None:
        entry = folder_of(ledger, "batch", number) if ledger else None
        if entry and exists(spark, entry):
            return
        handle(rows, rows.select("upload_id").distinct())
        if entry:
            spark.range(1).select(F.current_timestamp().alias("handled_at")).write.mode("overwrite").parquet(entry)

    return _started(spark, path, checkpoint, batch, every, None)


@dataclass(frozen=True)
class Landing:
    """A place where uploads collect that arrive in several batches. Each batch has its folder there, so one
    that is handed over again replaces itself."""

    spark: SparkSession
    path: str

    def take(self, rows: DataFrame, batch: int) -> None:
        landed = rows.select(*_LAYOUT.names).withColumn("landed_at", F.current_timestamp())
        landed.write.mode("overwrite").parquet(folder_of(self.path, "batch", batch))

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], _LANDED)
        return self.spark.read.schema(_LANDED).parquet(self.path)

    def complete(self, before: datetime | None = None) -> tuple[DataFrame, DataFrame]:
        """(rows, upload ids) of the uploads whose last file landed ``before`` that time, by default of
        all, which is right once a query over everything present has ended."""
        landed = self.rows()
        last = landed.groupBy("upload_id").agg(F.max("landed_at").alias("landed_at"))
        if before is not None:
            last = last.filter(F.col("landed_at") < F.lit(before).cast("timestamp"))
        uploads = last.select("upload_id")
        return landed.select(*_LAYOUT.names).join(uploads, "upload_id", "left_semi").select(*_LAYOUT.names), uploads

    def clear(self, waiting: DataFrame) -> int:
        """Delete the batches in which no upload is ``waiting`` (upload_id) any more. Returns how many."""
        kept = self.rows().join(waiting.select("upload_id"), "upload_id", "left_semi").select("batch").distinct()
        gone = self.rows().select("batch").distinct().join(kept, "batch", "left_anti")
        folders = [folder_of(self.path, "batch", r["batch"]) for r in gone.toLocalIterator()]
        delete_folders(self.spark, folders)
        return len(folders)


def land_uploads(
    spark: SparkSession, path: str, checkpoint: str, landing: Landing, every: str | None = None, files: int | None = None
) -> StreamingQuery:
    """Move newly arrived files of uploads to the landing place; at most ``files`` in a batch."""
    return _started(spark, path, checkpoint, landing.take, every, files)
