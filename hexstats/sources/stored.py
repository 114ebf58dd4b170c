"""Result tables that are kept in Parquet and changed in place, part by part.

A table with unique keys is cut into parts by a hash of its keys, one folder each. A change reads the parts
its keys fall into, works out the new rows, stages them, and replaces the parts in which
something really differs by a dynamic partition overwrite. The rest of the table is neither read nor written.

Changes say what holds afterwards, so repeating one that was cut off, or was already made, is safe: the
second time nothing differs and nothing is written. Plain Parquet has no snapshots; a reader during the
overwrite may see some parts before and some after it.

What a change did is counted while its rows are written (an observation of that job), not by a second one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from hexstats.sources.staging import stage

PART = "part"


@dataclass(frozen=True)
class Change:
    """Rows that were added, altered and removed, and the parts that were written for it."""

    added: int = 0
    altered: int = 0
    removed: int = 0
    parts: tuple[int, ...] = ()


def counted(rows: DataFrame, /, **measures: Column) -> tuple[DataFrame, Observation]:
    """``rows`` with measures that are known once a job has written them."""
    seen = Observation()
    return rows.observe(seen, *[F.coalesce(m, F.lit(0)).alias(name) for name, m in measures.items()]), seen


def measured(seen: Observation, name: str) -> int:
    """A measure after its job; a job that the planner found to be empty has none."""
    return int(seen.get.get(name) or 0)


def delete_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def folder_of(path: str, column: str, value: object) -> str:
    return f"{path.rstrip('/')}/{column}={value}"


@dataclass(frozen=True)
class KeyedTable:
    """A stored table with unique, non-NULL keys. ``parts`` belongs to the layout and never changes."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    parts: int = 64

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int").alias(PART)

    def _stored(self, parts: list[int] | None = None) -> DataFrame:
        layout = StructType([*self.schema.fields, StructField(PART, IntegerType())])
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], layout)
        rows = self.spark.read.schema(layout).parquet(self.path)
        # a list of part numbers prunes folders
        return rows if parts is None else rows.filter(F.col(PART).isin(parts))

    def read(self) -> DataFrame:
        return self._stored().drop(PART)

    def _replace(self, rows: DataFrame) -> None:
        """``rows`` are all rows of the parts they belong to, and come from elsewhere."""
        spread = rows.repartition(PART).sortWithinPartitions(PART, *self.keys)
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)

    def _numbers(self, rows: DataFrame) -> list[int]:
        """At most as many numbers as the table has parts."""
        return sorted(r[PART] for r in rows.select(PART).distinct().collect())

    def merge(self, changes: DataFrame, columns: list[str] | None = None, add: bool = True, alter: bool = True) -> Change:
        """Put ``changes`` (unique by key) into the table.

        Rows with a known key get ``columns`` (by default all that ``changes`` has) from their change,
        unless ``alter`` is off; rows with a new key are added unless ``add`` is off, with NULL in the
        columns that ``changes`` lacks.
        """
        keys = list(self.keys)
        given = [c for c in (columns or changes.columns) if c not in keys]
        names = self.schema.names
        fresh = changes.select(*keys, *[F.col(c) for c in changes.columns if c in names and c not in keys])
        fresh = stage(fresh.withColumn(PART, self._part()))
        touched = self._numbers(fresh)
        if not touched:
            return Change()
        new = fresh.select(*keys, PART, F.struct(F.lit(True).alias("here"), *[c for c in fresh.columns if c not in (*keys, PART)]).alias("_new"))
        old = self._stored(touched)
        old = old.select(*keys, PART, F.struct(F.lit(True).alias("here"), *[c for c in names if c not in keys]).alias("_old"))
        is_old, is_new = F.col("_old.here").isNotNull(), F.col("_new.here").isNotNull()
        both = is_old & is_new

        def value(name: str) -> Column:
            kind = self.schema[name].dataType
            before, after = F.col(f"_old.{name}"), F.col(f"_new.{name}").cast(kind) if name in fresh.columns else F.lit(None).cast(kind)
            known = F.when(both, after).otherwise(before) if alter and name in given and name in fresh.columns else before
            return F.when(is_old, known).otherwise(after).alias(name)

        differs = [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}").cast(self.schema[c].dataType)) for c in given if c in fresh.columns]
        differs = reduce(lambda a, b: a | b, differs, F.lit(False)) if alter else F.lit(False)
        state = F.when(is_new & ~is_old, F.lit("added")).when(both & differs, F.lit("altered"))
        merged = old.join(new, [*keys, PART], "full").withColumn("_state", state)
        if not add:
            merged = merged.filter(is_old)
        rows = merged.select(*[F.col(k) if k in keys else value(k) for k in names], PART, "_state")
        rows, seen = counted(
            rows, added=F.count_if(F.col("_state") == "added"), altered=F.count_if(F.col("_state") == "altered")
        )
        rows = stage(rows)
        changed = self._numbers(rows.filter(F.col("_state").isNotNull()))
        if changed:
            self._replace(rows.filter(F.col(PART).isin(changed)).drop("_state"))
        return Change(measured(seen, "added"), measured(seen, "altered"), 0, tuple(changed))

    def delete(self, found: DataFrame) -> tuple[Change, DataFrame]:
        """Remove the rows whose keys are in ``found``. Returns the removed rows as well."""
        keys = list(self.keys)
        gone = stage(found.select(*keys).distinct().withColumn(PART, self._part()))
        touched = self._numbers(gone)
        marked = self._stored(touched).join(gone.withColumn("_gone", F.lit(True)), [*keys, PART], "left")
        marked = marked.select(*self.schema.names, PART, F.coalesce("_gone", F.lit(False)).alias("_gone"))
        marked, seen = counted(marked, removed=F.count_if("_gone"))
        marked = stage(marked)
        per_part = marked.groupBy(PART).agg(F.count_if("_gone").alias("gone"), F.count(F.lit(1)).alias("n"))
        sizes = {r[PART]: (r["gone"], r["n"]) for r in per_part.collect()}  # a row per part
        changed = sorted(p for p, (out, _) in sizes.items() if out)
        left = [p for p in changed if sizes[p][0] < sizes[p][1]]
        if left:
            self._replace(marked.filter(~F.col("_gone") & F.col(PART).isin(left)).drop("_gone"))
        # an overwrite does not touch parts that have no rows left
        delete_folders(self.spark, [folder_of(self.path, PART, p) for p in changed if p not in left])
        removed = marked.filter("_gone").select(*self.schema.names)
        return Change(removed=measured(seen, "removed"), parts=tuple(changed)), removed
