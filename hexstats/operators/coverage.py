"""Resolution and geographic coverage of indicators, and the geometry of cells."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.functions import grid
from hexstats.schemas import SystemIds
from hexstats.sources.tables import update_columns

# Fixed value: a coverage outline is drawn from at most this many cells.
OUTLINE_CELLS = 1000


def resolution_counts(facts: DataFrame, ids: SystemIds) -> DataFrame:
    return (
        facts.filter(~F.col("indicator_uuid").isin(*ids.constants))
        .groupBy("indicator_uuid", grid.resolution(F.col("h3")).alias("res"))
        .agg(F.count(F.lit(1)).alias("cells"))
    )


def max_resolution(facts: DataFrame, ids: SystemIds) -> DataFrame:
    """Finest resolution of each indicator, and the finest one coarse enough for an outline."""
    return (
        resolution_counts(facts, ids)
        .groupBy("indicator_uuid")
        .agg(
            F.max("res").alias("max_res"),
            F.max(F.when(F.col("cells") <= OUTLINE_CELLS, F.col("res"))).alias("coverage_res"),
        )
    )


def outline_edges(facts: DataFrame, resolutions: DataFrame, cell_boundary: DataFrame) -> DataFrame:
    """Directed edges that bound the covered area of each indicator at its coverage resolution.

    An edge shared by two cells occurs in both directions; edges that occur once are the outline.
    """
    covered = resolutions.filter(F.col("coverage_res").isNotNull()).select("indicator_uuid", "coverage_res")
    # one number; it turns into a range of ids that reaches the scan, and coarse cells are few
    finest = covered.agg(F.max("coverage_res")).first()[0]
    cells = (
        facts.filter(grid.resolution_between(F.col("h3"), 0, -1 if finest is None else finest))
        .join(covered, "indicator_uuid")
        .filter(grid.resolution(F.col("h3")) == F.col("coverage_res"))
        .select("indicator_uuid", "h3")
    )
    a = F.struct(F.col("edge.ax").alias("x"), F.col("edge.ay").alias("y"))
    b = F.struct(F.col("edge.bx").alias("x"), F.col("edge.by").alias("y"))
    return (
        cells.join(cell_boundary.select("h3", "boundary"), "h3")
        .select("indicator_uuid", F.explode(grid.edges(F.col("boundary"))).alias("edge"))
        .groupBy("indicator_uuid", F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
        .agg(F.count(F.lit(1)).alias("times"), F.first("edge").alias("edge"))
        .filter("times = 1")
        .select("indicator_uuid", "edge.*")
    )


def _ring_builder():
    def rings(pdf):
        following: dict = {}
        for edge in pdf.sort_values(["ax", "ay", "bx", "by"]).itertuples(index=False):
            following.setdefault((edge.ax, edge.ay), []).append((edge.bx, edge.by))
        found = []
        for start in sorted(following):
            while following[start]:
                ring, at = [], start
                while following.get(at):
                    ring.append(at)
                    at = following[at].pop()
                found.append([{"lon": x, "lat": y} for x, y in ring])
        return pd.DataFrame({"indicator_uuid": [pdf["indicator_uuid"].iloc[0]], "rings": [found]})

    return rings


def coverage_outline(edges: DataFrame) -> DataFrame:
    """Join the outline edges of each indicator into rings (outer ones counter-clockwise, holes
    clockwise). An indicator has at most 1000 cells here, so its edges fit any task."""
    return edges.groupBy("indicator_uuid").applyInPandas(
        _ring_builder(), "indicator_uuid string, rings array<array<struct<lon: double, lat: double>>>"
    )


def signed_area(ring: Column) -> Column:
    """Area a ring encloses: positive if it runs counter-clockwise, as shells do."""
    shifted = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    turns = F.zip_with(ring, shifted, lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"])
    return F.aggregate(turns, F.lit(0.0), lambda acc, v: acc + v) / 2


def _within(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies in a ring: a line to its east crosses an odd number of sides."""
    shifted = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crossed(a: Column, b: Column) -> Column:
        spans = (a["lat"] <= lat) != (b["lat"] <= lat)
        share = (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0))
        return F.when(spans & (lon < a["lon"] + share * (b["lon"] - a["lon"])), 1).otherwise(0)

    return F.aggregate(F.zip_with(ring, shifted, crossed), F.lit(0), lambda acc, v: acc + v) % 2 == 1


def polygons(rings: Column) -> Column:
    """Rings as polygons: each a shell, the largest first, followed by its holes.

    A hole belongs to the smallest shell around it, so an island in a hole is a polygon of its own. The
    middle of one of its sides tells: no outline side belongs to two rings.
    """
    measured = F.transform(rings, lambda r: F.struct(signed_area(r).alias("area"), r.alias("ring")))
    shells = F.filter(measured, lambda r: r["area"] > 0)

    def middle(ring: Column, axis: str) -> Column:
        return (F.element_at(ring, 1)[axis] + F.element_at(ring, 2)[axis]) / 2

    def around(hole: Column) -> Column:
        ring = hole["ring"]
        return F.array_min(F.filter(shells, lambda s: _within(middle(ring, "lon"), middle(ring, "lat"), s["ring"])))

    holes = F.transform(
        F.filter(measured, lambda r: r["area"] < 0), lambda h: F.struct(h["ring"].alias("ring"), around(h).alias("shell"))
    )
    placed = F.transform(F.reverse(F.array_sort(shells)), lambda s: F.concat(
        F.array(s["ring"]), F.transform(F.filter(holes, lambda h: h["shell"] == s), lambda h: h["ring"])
    ))
    return F.when(rings.isNotNull(), placed)


def apply_coverage(metadata: DataFrame, resolutions: DataFrame, outlines: DataFrame) -> DataFrame:
    """Write max_res and coverage_polygon; without a coverage resolution the polygon is NULL."""
    found = resolutions.join(outlines, "indicator_uuid", "left").select(
        F.col("indicator_uuid").alias("internal_id"), "max_res", polygons(F.col("rings")).alias("coverage_polygon")
    )
    return update_columns(metadata, found, ["internal_id"], ["max_res", "coverage_polygon"])


def cell_geometry(
    facts: DataFrame,
    metadata: DataFrame,
    existing: DataFrame,
    cell_boundary: DataFrame,
    now: datetime,
    days: int = 2,
) -> DataFrame:
    """Web Mercator boundaries of cells of recent indicators that have none yet."""
    recent = metadata.filter(
        F.col("date") > F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(days))
    ).select(F.col("internal_id").alias("indicator_uuid"))
    return (
        facts.filter(grid.resolution_between(F.col("h3"), 0, schemas.SYSTEM_MAX_RES))
        .join(recent, "indicator_uuid", "left_semi")
        .select("h3")
        .distinct()
        .join(existing.select("h3"), "h3", "left_anti")
        .join(cell_boundary.select("h3", "boundary"), "h3")
        .select(
            "h3", grid.resolution(F.col("h3")).alias("resolution"), grid.mercator(F.col("boundary")).alias("boundary")
        )
    )
