"""One whole round of the indicator life cycle, tables in and tables out."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators import (
    analytics, candidates, coverage, lifecycle, overrides, pairs, quality, system, transform,
)
from hexstats.operators.axis_values import AXIS_KEYS, pack, staged
from hexstats.schemas import SystemIds
from hexstats.sources import tables
from hexstats.sources.staging import stage


@dataclass(frozen=True)
class Base:
    """The tables of an indicator base."""

    facts: DataFrame
    metadata: DataFrame
    axis: DataFrame
    correlation: DataFrame
    overrides: DataFrame
    cell_boundary: DataFrame
    cell_geometry: DataFrame
    #: (kind, axis) of work that has run, also where it found nothing, and the axis' minimum then
    completed: DataFrame


def no_completed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.COMPLETED)


def ingest(base: Base, staged: DataFrame, uploads: DataFrame) -> Base:
    """Move uploads into the facts. ``uploads`` lists the upload ids whose data was found."""
    rows, metadata = lifecycle.ingest(staged, uploads, base.metadata)
    return replace(base, facts=base.facts.unionByName(stage(rows)), metadata=stage(metadata))


def fill_system(base: Base, owner: str, ids: SystemIds) -> Base:
    """Register the system indicators and fill them for the cells of NEW indicators that lack them."""
    metadata, _ = system.add_system_metadata(base.metadata, owner, ids)
    numerators = metadata.filter(F.col("state") == schemas.NEW).select(F.col("internal_id").alias("indicator_uuid"))
    rows = system.system_rows(
        system.missing_cells(base.facts, ids, numerators), base.cell_boundary, ids
    )
    return replace(base, facts=base.facts.unionByName(stage(rows)), metadata=stage(metadata))


def axes_to_measure(base: Base, ids: SystemIds) -> tuple[DataFrame, DataFrame]:
    """(axes, those of them that are new): missing axes, axes with open work, and axes whose stored
    minimum no longer fits their values."""
    keys = ["numerator", "denominator", *AXIS_KEYS]
    added = stage(candidates.new_axes(base.metadata, base.axis).select(*keys))
    none_open = base.correlation.select(*schemas.PAIR_KEYS).limit(0)
    open_work = lifecycle.unfinished_work(base.metadata, base.axis, none_open, ids, base.completed)
    kinds = ("quality", "analytics", "transformations")
    again = open_work.filter(F.col("kind").isin(*kinds)).select(F.col("x_num").alias(AXIS_KEYS[0]), F.col("x_den").alias(AXIS_KEYS[1]))
    changed = base.axis.filter(F.col("transformations").isNull() & F.col("mean_all_res").isNotNull())
    # what cannot be transformed is looked at again only if its minimum has changed since
    tried = base.completed.filter(F.col("kind") == "transformations").select(*AXIS_KEYS, F.col("minimum").alias("min"))
    changed = stage(changed.alias("a").join(
        tried.alias("t"),
        F.expr("a.numerator_uuid = t.numerator_uuid and a.denominator_uuid = t.denominator_uuid and a.min <=> t.min"), "left_anti",
    ))
    stale = transform.repair(transform.histogram(base.facts, changed, ids))
    todo = base.axis.select(*keys).join(again.unionByName(stale).distinct(), AXIS_KEYS, "left_semi")
    return stage(added.unionByName(todo)), added


@dataclass(frozen=True)
class Measures:
    """What measuring the axes of a round changes."""

    #: rows of the axes that were measured
    axis: DataFrame
    #: the whole metadata, with resolution, coverage and downscale class
    metadata: DataFrame
    #: records of the work that has run
    completed: DataFrame


def measures(base: Base, owner: str) -> Measures:
    """Quality, analytics, overrides and transformations of new, unfinished and stale axes, and
    resolution and coverage of their new indicators and of those that still lack a resolution."""
    ids = tables.system_ids(base.metadata, owner)
    todo, added = axes_to_measure(base, ids)
    fresh = base.axis.limit(0).unionByName(todo, allowMissingColumns=True)
    fresh = tables.update_columns(fresh, quality.axis_quality(base.facts, todo, ids), AXIS_KEYS, ["quality"])
    # one copy of the cells for statistics and histograms
    cells = staged(pack(base.facts, todo, ids, population=ids.population))
    stats = analytics.statistics(cells, todo, base.metadata, base.overrides, ids)
    fresh = analytics.apply_analytics(fresh, analytics.analytics(stats))
    fresh = stage(overrides.apply_overrides(fresh, base.overrides, base.metadata))

    points = stage(transform.histogram(cells, fresh, ids))
    fresh = transform.apply_transforms(fresh, transform.transform_result(transform.transform_stats(points)))
    fresh = stage(fresh.select(*base.axis.columns))
    completed = lifecycle.completion("quality", fresh).unionByName(lifecycle.completion("analytics", fresh))
    completed = completed.unionByName(lifecycle.completion("transformations", fresh, F.col("min")))

    axis = base.axis.join(fresh.select(*AXIS_KEYS), AXIS_KEYS, "left_anti").select(*base.axis.columns).unionByName(fresh)
    open_ones = lifecycle.without_resolution(base.metadata, axis, ids).toDF("indicator_uuid")
    new = candidates.new_indicators(base.metadata, added).unionByName(open_ones).distinct()
    new_facts = base.facts.join(new, "indicator_uuid", "left_semi").select(*base.facts.columns)
    resolutions = stage(coverage.max_resolution(new_facts, ids))
    outlines = coverage.coverage_outline(
        coverage.outline_edges(new_facts, resolutions, base.cell_boundary)
    )
    metadata = coverage.apply_coverage(base.metadata, resolutions, outlines)
    return Measures(fresh, stage(quality.downscale(metadata, axis, ids)), stage(completed))


def measure_axes(base: Base, owner: str) -> Base:
    """The tables after ``measures``, with the overrides applied to all axes."""
    found = measures(base, owner)
    kept = base.axis.join(found.axis.select(*AXIS_KEYS), AXIS_KEYS, "left_anti").select(*base.axis.columns)
    kept = overrides.apply_overrides(kept, base.overrides, base.metadata)
    completed = base.completed.join(found.completed, lifecycle.COMPLETED_KEYS, "left_anti").unionByName(found.completed)
    return replace(
        base, axis=stage(kept.unionByName(found.axis)), metadata=found.metadata, completed=stage(completed)
    )


def missing_correlations(base: Base, owner: str) -> DataFrame | None:
    """Rows of the correlations that are missing between well-rated axes, or None if there are none."""
    dictionary = stage(pairs.rated_axes(base.metadata, base.axis))
    missing = stage(pairs.missing_pairs(dictionary, base.correlation))
    if missing.isEmpty():
        return None
    return pairs.correlation_rows(base.facts, dictionary, missing, tables.system_ids(base.metadata, owner))


def correlate(base: Base, owner: str) -> Base:
    """Compute the correlations that are missing between well-rated axes."""
    rows = missing_correlations(base, owner)
    if rows is None:
        return base
    return replace(base, correlation=stage(tables.upsert(base.correlation, stage(rows), list(schemas.PAIR_KEYS))))


def publish(base: Base, owner: str) -> Base:
    ids = tables.system_ids(base.metadata, owner)
    # correlations do not hold back publication
    none_open = base.correlation.select(*schemas.PAIR_KEYS).limit(0)
    unfinished = lifecycle.unfinished_work(base.metadata, base.axis, none_open, ids, base.completed)
    return replace(base, metadata=stage(lifecycle.publish(base.metadata, base.axis, unfinished)))


def draw_cells(base: Base, now: datetime) -> Base:
    """Project the cells of recent indicators."""
    added = coverage.cell_geometry(base.facts, base.metadata, base.cell_geometry, base.cell_boundary, now)
    return replace(base, cell_geometry=base.cell_geometry.unionByName(stage(added)))


def purge(base: Base, now: datetime, running: DataFrame | None = None) -> Base:
    """Drop outdated versions with everything attached to them, and failed uploads."""
    facts, metadata, axis, correlations, kept = lifecycle.purge(
        base.facts, base.metadata, base.axis, base.correlation, base.overrides
    )
    completed = lifecycle.purge_axes(base.completed, base.metadata)
    metadata = lifecycle.remove_failed_uploads(metadata, now, running)
    return replace(
        base, facts=facts, metadata=stage(metadata), axis=stage(axis),
        correlation=stage(correlations), overrides=stage(kept), completed=stage(completed),
    )


def run(base: Base, staged: DataFrame, uploads: DataFrame, owner: str, now: datetime) -> Base:
    """Everything, in the order in which the steps need each other."""
    base = ingest(base, staged, uploads)
    base = fill_system(base, owner, tables.system_ids(base.metadata, owner))
    base = measure_axes(base, owner)
    base = correlate(base, owner)
    base = publish(base, owner)
    base = draw_cells(base, now)
    return purge(base, now)
