"""A round over tables that are kept in a folder: every step writes only what it changes.

An upload writes the folders of its own indicators, the system fill appends its rows, results go into the parts of
the axis and correlation tables they belong to, outdated indicators go with their folders. Each step can be
repeated after a failure: it finds what is done and does the rest. What later steps rely on is
written first, the state that marks it as done last.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hexstats import schemas
from hexstats.operators import coverage, lifecycle, overrides, system
from hexstats.operators.axis_values import AXIS_KEYS
from hexstats.plans import refresh
from hexstats.sources import tables
from hexstats.sources.staging import stage, staging_area
from hexstats.sources.stored import Change, KeyedTable, counted, exists, measured


@dataclass(frozen=True)
class Store:
    """The tables of an indicator base below ``root``.

    ``parts`` is the number of parts of the correlation table, the largest of the keyed ones; a part should hold
    about 128 MB. It belongs to the layout and never changes.
    """

    spark: SparkSession
    root: str
    cell_boundary: DataFrame = field(compare=False)
    parts: int = 256

    def _keyed(self, name: str, schema: StructType, keys: tuple[str, ...], parts: int) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root.rstrip('/')}/{name}", schema, keys, parts)

    @property
    def facts_path(self) -> str:
        return f"{self.root.rstrip('/')}/facts"

    @property
    def geometry_path(self) -> str:
        return f"{self.root.rstrip('/')}/cell_geometry"

    @property
    def metadata(self) -> KeyedTable:
        return self._keyed("metadata", schemas.METADATA, ("internal_id",), 4)

    @property
    def axis(self) -> KeyedTable:
        return self._keyed("axis", schemas.AXIS, tuple(AXIS_KEYS), max(self.parts // 4, 1))

    @property
    def correlation(self) -> KeyedTable:
        return self._keyed("correlation", schemas.CORRELATION, schemas.PAIR_KEYS, self.parts)

    @property
    def overrides(self) -> KeyedTable:
        return self._keyed("overrides", schemas.OVERRIDES, ("numerator_id", "denominator_id"), 4)

    @property
    def completed(self) -> KeyedTable:
        return self._keyed("completed", schemas.COMPLETED, tuple(lifecycle.COMPLETED_KEYS), max(self.parts // 4, 1))

    def _read(self, path: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def facts(self) -> DataFrame:
        return self._read(self.facts_path, schemas.FACTS).select(*schemas.FACTS.names)

    def cell_geometry(self) -> DataFrame:
        return self._read(self.geometry_path, schemas.CELL_GEOMETRY)

    def base(self) -> refresh.Base:
        """The tables as they are now. Take it anew after every write."""
        return refresh.Base(
            facts=self.facts(), metadata=self.metadata.read(), axis=self.axis.read(), correlation=self.correlation.read(),
            overrides=self.overrides.read(), cell_boundary=self.cell_boundary, cell_geometry=self.cell_geometry(),
            completed=self.completed.read(),
        )

    def load(self, base: refresh.Base) -> None:
        """Put the tables of ``base`` into an empty folder."""
        tables.write_facts(base.facts, self.facts_path, "replace")
        base.cell_geometry.select(*schemas.CELL_GEOMETRY.names).write.mode("overwrite").parquet(self.geometry_path)
        for name in ("metadata", "axis", "correlation", "overrides", "completed"):
            getattr(self, name).merge(getattr(base, name))


def ingest(store: Store, staged: DataFrame, uploads: DataFrame) -> dict[str, int]:
    """Move uploads into the facts: writes the folders of their indicators, then their states."""
    rows, metadata = lifecycle.ingest(staged, uploads, store.metadata.read())
    metadata = stage(metadata)
    written = tables.write_facts(rows, store.facts_path, "replace")
    return {"ingested rows": written, "ingested versions": store.metadata.merge(metadata, ["state"], add=False).altered}


def fill_system(store: Store, owner: str) -> dict[str, int]:
    """Register the system indicators and append their rows for cells that lack them."""
    base = store.base()
    ids = tables.system_ids(base.metadata, owner)
    numerators = base.metadata.filter(F.col("state") == schemas.NEW).select(F.col("internal_id").alias("indicator_uuid"))
    missing = system.missing_cells(base.facts, ids, numerators)
    # staged, as the facts they are worked out from are appended to
    rows = stage(system.system_rows(missing, base.cell_boundary, ids))
    written = tables.write_facts(rows, store.facts_path)
    metadata, _ = system.add_system_metadata(base.metadata, owner, ids)
    return {"system rows": written, "system indicators": store.metadata.merge(metadata, alter=False).added}


def measure_axes(store: Store, owner: str) -> dict[str, int]:
    """Write the axes that were measured, and the overrides that differ from what is stored."""
    base = store.base()
    found = refresh.measures(base, owner)
    done = store.axis.merge(found.axis)
    given = overrides.overridden_axes(store.axis.read(), base.overrides, base.metadata)
    changed = store.axis.merge(given, list(schemas.OVERRIDE_FIELDS), add=False)
    store.metadata.merge(found.metadata, ["max_res", "coverage_polygon", "downscale"], add=False)
    store.completed.merge(found.completed)
    return {"axes added": done.added, "axes altered": done.altered, "axes overridden": changed.altered}


def correlate(store: Store, owner: str) -> Change:
    """Write the correlations that were missing into the parts they belong to."""
    rows = refresh.missing_correlations(store.base(), owner)
    return Change() if rows is None else store.correlation.merge(rows)


def publish(store: Store, owner: str) -> int:
    return store.metadata.merge(refresh.publish(store.base(), owner).metadata, ["state"], add=False).altered


def draw_cells(store: Store, now: datetime) -> int:
    """Append the geometry of the cells of recent indicators."""
    base = store.base()
    added = coverage.cell_geometry(base.facts, base.metadata, base.cell_geometry, base.cell_boundary, now)
    rows, seen = counted(added.select(*schemas.CELL_GEOMETRY.names), rows=F.count(F.lit(1)))
    rows = stage(rows)
    drawn = measured(seen, "rows")
    if drawn:
        rows.write.mode("append").parquet(store.geometry_path)
    return drawn


def purge(store: Store, now: datetime, running: DataFrame | None = None) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Remove outdated versions with everything attached to them, and failed uploads.

    Returns the numbers of removed rows per table, of folders of facts, and the removed rows of the keyed tables.
    The versions themselves go last, so that an interrupted removal is continued.
    """
    base = store.base()
    gone = stage(lifecycle.outdated(base.metadata))
    changes, removed = {}, {}
    for name, columns in (("correlation", schemas.PAIR_KEYS), ("axis", AXIS_KEYS), ("completed", AXIS_KEYS)):
        rows = getattr(base, name)
        named = F.array(*[F.col(c) for c in columns])
        hits = rows.withColumn("internal_id", F.explode(named)).join(gone, "internal_id", "left_semi").select(*rows.columns)
        changes[name], removed[name] = getattr(store, name).delete(hits)
    orphans = overrides.orphaned(base.overrides, lifecycle.purge_metadata(base.metadata))
    changes["overrides"], removed["overrides"] = store.overrides.delete(orphans)
    folders = tables.drop_facts(store.spark, store.facts_path, gone)
    failed = lifecycle.failed_uploads(base.metadata, now, running).select("internal_id")
    changes["metadata"], removed["metadata"] = store.metadata.delete(gone.unionByName(failed))
    return {**{name: c.removed for name, c in changes.items()}, "facts": folders}, removed


def run(
    store: Store, staged: DataFrame, uploads: DataFrame, owner: str, now: datetime, running: DataFrame | None = None
) -> dict[str, int]:
    """Everything, in the order in which the steps need each other. Returns what was written."""
    with staging_area(store.spark):
        counts = ingest(store, staged, uploads)
        counts |= fill_system(store, owner)
        counts |= measure_axes(store, owner)
        done = correlate(store, owner)
        counts |= {"correlations added": done.added, "correlations altered": done.altered}
        counts |= {"states changed": publish(store, owner), "cells drawn": draw_cells(store, now)}
        counts |= {f"purged {name}": n for name, n in purge(store, now, running)[0].items()}
    return counts
