"""System indicators: presence (one) and area of every cell that carries data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.functions import grid
from hexstats.operators.axis_values import listed
from hexstats.schemas import SystemIds
from hexstats.sources.staging import stage
from hexstats.sources.tables import insert_absent


def missing_cells(facts: DataFrame, ids: SystemIds, numerators: DataFrame | None = None) -> DataFrame:
    """Cells up to resolution 8 with data but without a row of ``one``: (h3, has_area).

    ``numerators`` (indicator_uuid) limits the indicators looked at; the system indicators never count as
    data. Without it one aggregation by cell answers all three questions about it.
    """
    indicator = F.col("indicator_uuid")
    rows = facts.filter(grid.resolution_between(F.col("h3"), 0, schemas.SYSTEM_MAX_RES))
    is_data = ~indicator.isin(*ids.constants)
    has_one, has_area = (F.bool_or(indicator == i) for i in ids.constants)
    if numerators is None:
        return (
            rows.groupBy("h3")
            .agg(F.bool_or(is_data).alias("has_data"), has_one.alias("has_one"), has_area.alias("has_area"))
            .filter("has_data and not has_one")
            .select("h3", "has_area")
        )
    data = numerators.filter(is_data)
    new = stage(rows.join(listed(data, "indicator_uuid"), "indicator_uuid", "left_semi").select("h3").distinct())
    known = rows_of_cells(rows.filter(indicator.isin(*ids.constants)), new)
    known = known.groupBy("h3").agg(has_one.alias("has_one"), has_area.alias("has_area"))
    return (
        new.join(known, "h3", "left")
        .filter(~F.coalesce("has_one", F.lit(False)))
        .select("h3", F.coalesce("has_area", F.lit(False)).alias("has_area"))
    )


def rows_of_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows of some cells, found while the rows are scanned.

    Files are sorted by cell, so the least and greatest id skip row groups. The ids themselves are
    broadcast up to the session's threshold; beyond it, the comparison, which holds for every id, marks them
    as selective, so that Spark pushes a Bloom filter of them into the scan. Either way rows of
    other cells are dropped before anything is shuffled.
    """
    low, high = cells.agg(F.min("h3"), F.max("h3")).first()
    near = rows.filter(F.col("h3").between(low, high)) if low is not None else rows.limit(0)
    return near.join(cells.filter(F.col("h3") > 0), "h3", "left_semi").select(*rows.columns)


def _areas(cell_boundary: DataFrame) -> DataFrame:
    measured = F.coalesce(F.col("area_km2"), grid.area_km2(F.col("boundary")))
    return cell_boundary.select("h3", measured.alias("area")).filter(F.col("area").isNotNull())


def system_rows(missing: DataFrame, cell_boundary: DataFrame, ids: SystemIds) -> DataFrame:
    """The fact rows of one and area_km2 for missing cells; present area rows are kept as they are.

    The area comes from the boundary table, measured from the boundary where it is not given. A cell whose
    area is unknown stays missing, see ``cells_without_area``, and is filled once its boundary is there.
    """
    rows = F.array(
        F.struct(F.lit(ids.one).alias("indicator_uuid"), F.lit(1.0).alias("indicator_value")),
        F.struct(F.lit(ids.area).alias("indicator_uuid"), F.col("area").alias("indicator_value")),
    )
    return (
        missing.join(_areas(cell_boundary), "h3")
        .withColumn("row", F.explode(rows))
        .filter(~(F.col("has_area") & (F.col("row.indicator_uuid") == ids.area)))
        .select("h3", "row.indicator_uuid", "row.indicator_value")
    )


def cells_without_area(missing: DataFrame, cell_boundary: DataFrame) -> DataFrame:
    """Missing cells that cannot be filled yet, as their boundary is unknown: (h3)."""
    return missing.select("h3").join(_areas(cell_boundary), "h3", "left_anti")


def add_system_metadata(metadata: DataFrame, owner: str, ids: SystemIds) -> tuple[DataFrame, DataFrame]:
    """Register the two system indicators unless they are. Returns (new table, added rows)."""
    neutral = [["neutral"], ["neutral"]]
    spark = metadata.sparkSession

    def row(param_id: str, internal_id: str, label: str, unit: str) -> dict:
        return {
            "param_id": param_id, "internal_id": internal_id, "external_id": internal_id,
            "param_label": label, "owner": owner, "state": schemas.NEW, "is_base": True,
            "copyrights": [], "direction": neutral, "description": "", "coverage": "World",
            "update_frequency": "static", "unit_id": unit, "is_public": True, "max_res": 15,
        }

    rows = spark.createDataFrame(
        [row("one", ids.one, "1", "n"), row("area_km2", ids.area, "Area", "km2")], schemas.METADATA
    )
    known = [f for f in schemas.METADATA.names if f in metadata.columns]
    return insert_absent(metadata, rows.select(*known), ["internal_id"])
