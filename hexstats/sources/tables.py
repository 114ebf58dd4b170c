"""Reading and writing the fact table, and the keyed updates of the result tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hexstats import schemas
from hexstats.sources.stored import counted, delete_folders, exists, folder_of, measured


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    """Facts written by ``write_facts``; a filter on indicator_uuid prunes whole folders."""
    return (
        spark.read.schema(schemas.FACTS).parquet(path).select("h3", "indicator_uuid", "indicator_value")
    )


def write_facts(facts: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> int:
    """One folder per indicator, files sorted by cell. Returns the number of rows written.

    The range split covers (indicator, cell), so an indicator with a large share of all rows
    is written by many tasks, and the sort gives every file a narrow cell range to skip by.
    """
    keys = ["indicator_uuid", "h3"]
    spread = facts.repartitionByRange(partitions, *keys) if partitions else facts.repartitionByRange(*keys)
    # counted after the shuffle: the rows before it are also read for its sample
    rows, seen = counted(spread.sortWithinPartitions(*keys), rows=F.count(F.lit(1)))
    writer = rows.write.partitionBy("indicator_uuid")
    if mode == "replace":
        # other indicators stay; repeating an interrupted write replaces what it left
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)
    return measured(seen, "rows")


def drop_facts(spark: SparkSession, path: str, ids: DataFrame) -> int:
    """Remove indicators from facts in a folder, by their folders. Returns how many there were."""
    dropped = 0
    for rows in _batches(ids.select("internal_id").distinct().toLocalIterator(), 500):
        folders = [folder_of(path, "indicator_uuid", row["internal_id"]) for row in rows]
        folders = [f for f in folders if exists(spark, f)]
        delete_folders(spark, folders)
        dropped += len(folders)
    return dropped


def read_uploads(spark: SparkSession, path: str) -> DataFrame:
    """Staged uploads, laid out as ``<path>/upload_id=<id>/*.parquet``."""
    layout = StructType([*schemas.FACTS.fields, StructField("upload_id", StringType())])
    return spark.read.schema(layout).parquet(path)


def upload_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Names of the tables in a database, as one column ``table_name``."""
    where = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{where}").select(F.col("tableName").alias("table_name"))


def drop_indicators(spark: SparkSession, table: str, ids: DataFrame) -> None:
    """Remove indicators from a catalogued fact table by dropping their partitions.

    Costs as much as the number of removed indicators, whatever the size of the table; a few hundred
    partitions go with each statement.
    """
    for rows in _batches(ids.select("internal_id").distinct().toLocalIterator(), 500):
        partitions = ", ".join(f"PARTITION (indicator_uuid = '{row['internal_id']}')" for row in rows)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {partitions}")


def _batches(rows: Iterator, size: int) -> Iterator[list]:
    while batch := list(islice(rows, size)):
        yield batch


def nested_as_json(table: DataFrame) -> DataFrame:
    """Write nested columns as JSON text, for sinks without nested types."""
    nested = ("array", "struct", "map")
    return table.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in nested else F.col(f.name)
            for f in table.schema.fields
        ]
    )


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``changes`` replace rows of ``table`` with the same keys, or are added."""
    kept = table.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.select(*table.columns))


def insert_absent(table: DataFrame, rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Add the rows whose keys are new. Returns (new table, added rows)."""
    added = rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti")
    return table.unionByName(added, allowMissingColumns=True), added


def update_columns(table: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set ``columns`` from the matching row of ``changes``; unmatched rows stay."""
    marked = changes.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_matched")
    )
    joined = table.join(marked, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in table.columns
        ]
    )


def is_active() -> F.Column:
    """Indicators that take part in calculations."""
    return ~F.col("state").isin(*schemas.DORMANT_STATES)


def active(metadata: DataFrame) -> DataFrame:
    return metadata.filter(is_active())


def inactive_ids(ids: DataFrame, metadata: DataFrame, column: str) -> DataFrame:
    """Ids that may no longer be worked on: unknown, outdated or still being copied.

    Wider than ``active``: a temporary indicator is not inactive here, and neither is NULL.
    """
    usable = metadata.filter(~F.col("state").isin(schemas.OUTDATED, schemas.COPY_IN_PROGRESS)).select(
        F.col("internal_id").alias(column)
    )
    return ids.filter(F.col(column).isNotNull()).join(usable, column, "left_anti")


def system_ids(metadata: DataFrame, owner: str) -> schemas.SystemIds:
    """Look up the ids of one, area_km2 and the newest published population of an owner."""
    rows = (
        metadata.filter(
            (F.col("owner") == owner)
            & (
                F.col("param_id").isin("one", "area_km2")
                | ((F.col("param_id") == "population") & (F.col("state") == schemas.READY))
            )
        )
        .groupBy("param_id")
        .agg(
            # NULL dates sort first in a descending order, so they win
            F.max(
                F.struct(F.col("date").isNull().alias("undated"), F.col("date"), F.col("internal_id"))
            )["internal_id"].alias("id")
        )
        .collect()  # at most three rows
    )
    found = {row["param_id"]: row["id"] for row in rows}
    return schemas.SystemIds(
        one=found.get("one", schemas.ONE_ID),
        area=found.get("area_km2", schemas.AREA_ID),
        population=found.get("population"),
    )
