"""The value of an axis in a cell: numerator divided by denominator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats.functions import grid
from hexstats.functions.measures import ratio
from hexstats.functions.pairing import attach
from hexstats.schemas import SystemIds
from hexstats.sources.staging import stage

AXIS_KEYS = ["numerator_uuid", "denominator_uuid"]
_ID_LANES = 64


def number_axes(axes: DataFrame) -> DataFrame:
    """Give every distinct axis a compact integer ``axis_id``.

    The hot paths carry this instead of two 36-character ids. Numbering runs in 64 independent
    lanes, so the axis table never passes through one task.
    """
    lane = F.pmod(F.xxhash64(*AXIS_KEYS), F.lit(_ID_LANES))
    position = F.row_number().over(W.partitionBy("lane").orderBy(*AXIS_KEYS))
    return (
        axes.select(*AXIS_KEYS)
        .distinct()
        .withColumn("lane", lane)
        .withColumn("axis_id", (position.cast("long") - 1) * _ID_LANES + F.col("lane"))
        .select("axis_id", *AXIS_KEYS)
    )


def number_rows(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with distinct keys and a compact number each, in lanes, as for axes."""
    position = F.row_number().over(W.partitionBy("lane").orderBy(key))
    return (
        rows.withColumn("lane", F.pmod(F.xxhash64(key), F.lit(_ID_LANES)))
        .withColumn(name, (position.cast("long") - 1) * _ID_LANES + F.col("lane"))
        .drop("lane")
    )


def without_system_numerators(axes: DataFrame, ids: SystemIds) -> DataFrame:
    return axes.filter(~F.col("numerator_uuid").isin(*ids.constants))


def listed(axes: DataFrame, column: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The distinct indicators of a column, as a join partner of the facts.

    The comparison holds for every id. It marks the list as selective, which is what makes the
    planner prune the folders of all other indicators when it broadcasts the list. Ids to leave
    out are joined away: a plain filter would be copied to the facts and end the pruning.
    """
    found = axes.select(F.col(column).alias("indicator_uuid")).filter(F.col("indicator_uuid") > "").distinct()
    if without:
        rows = ", ".join(f"('{i}')" for i in without)
        excluded = axes.sparkSession.sql(f"select * from values {rows} as t(indicator_uuid)")
        found = found.join(excluded, "indicator_uuid", "left_anti")
    return found


@dataclass(frozen=True)
class Packed:
    """The values that some axes need, cell by cell, before they are multiplied into axes.

    ``cells`` has (h3, numerators, denominators, has_population); the two lists hold (number, value), and
    ``numbers`` says which indicator (indicator_uuid) has which number. A fact takes part once, whatever the
    number of axes over it, so a staged copy grows with the facts alone.
    """

    cells: DataFrame
    numbers: DataFrame


#: numbers of the system indicators one and area_km2, as stored and taken as constants
_ONE_NO, _AREA_NO = -1, -2
_LITERAL_ONE_NO, _AVERAGE_AREA_NO = -3, -4


def number_indicators(axes: DataFrame, ids: SystemIds) -> DataFrame:
    """(indicator_uuid, number) of all indicators of the axes; in lanes, as for axes."""
    indicator = F.col("indicator_uuid")
    every = axes.select(F.explode(F.array(*AXIS_KEYS)).alias("indicator_uuid")).distinct()
    position = F.row_number().over(W.partitionBy("lane").orderBy("indicator_uuid"))
    number = (position - 1) * _ID_LANES + F.col("lane")
    system = F.when(indicator == ids.one, F.lit(_ONE_NO)).when(indicator == ids.area, F.lit(_AREA_NO))
    return every.withColumn("lane", F.pmod(F.xxhash64(indicator), F.lit(_ID_LANES))).select(
        "indicator_uuid", F.coalesce(system, number.cast("int")).alias("number")
    )


def pack(
    facts: DataFrame, axes: DataFrame, ids: SystemIds, *, population: str | None = None, without: tuple[str, ...] = ()
) -> Packed:
    """The values of all numerators and denominators of the axes, but those in ``without``, per cell.

    Facts are shuffled once, by cell. Stage the cells to multiply them several times.
    """
    numbers = number_indicators(axes, ids)

    def side(column: str, name: str) -> DataFrame:
        wanted = listed(axes, column, without=without).join(numbers, "indicator_uuid")
        value = F.struct("number", F.col("indicator_value").alias("value"))
        return facts.join(wanted, "indicator_uuid").select("h3", value.alias(name))

    rows = side("numerator_uuid", "numerator").unionByName(side("denominator_uuid", "denominator"), allowMissingColumns=True)
    populated = F.lit(False)
    if population is not None:
        present = facts.filter((F.col("indicator_uuid") == population) & F.col("indicator_value").isNotNull())
        rows = rows.withColumn("populated", F.lit(False)).unionByName(
            present.select("h3", F.lit(True).alias("populated")), allowMissingColumns=True
        )
        populated = F.bool_or("populated")
    # exchanged as they are: lists built before would hold single values, as files hold one indicator each
    cells = rows.repartition("h3").groupBy("h3").agg(
        F.collect_list("numerator").alias("numerators"), F.collect_list("denominator").alias("denominators"),
        populated.alias("has_population"),
    )
    return Packed(cells, numbers)


def staged(packed: Packed) -> Packed:
    """Written once, multiplied whenever it is read; in the order of cells, so that sums repeat as they are."""
    return Packed(stage(packed.cells.sortWithinPartitions("h3")), stage(packed.numbers))


def axis_values(
    facts: DataFrame | Packed,
    axes: DataFrame,
    ids: SystemIds,
    *,
    literal_one: bool,
    average_area: bool,
    population: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Values ``m`` of all numbered, staged axes: (axis_id, h3, m, has_population) and the columns ``carry`` of the axes.

    The system indicators are either read from the facts like any other indicator, or taken as a
    constant (1, or the average cell area of the resolution) that needs no matching row. A constant
    over a constant has no cells of its own, hence no values.

    A cell's values become values of axes row by row: the axes of a numerator are looked up
    once per fact, and nothing is joined or shuffled once they are multiplied. Instead of facts, values
    packed before for at least these axes will do.
    """
    constants = [i for i, use in ((ids.one, literal_one), (ids.area, average_area)) if use]
    if not isinstance(facts, Packed):
        facts = pack(facts, axes, ids, population=population, without=tuple(constants))
    cells, numbers = facts.cells, facts.numbers
    fixed, literal = [], {}
    if literal_one:
        literal[_ONE_NO] = _LITERAL_ONE_NO
        fixed.append(F.struct(F.lit(_LITERAL_ONE_NO).alias("number"), F.lit(1.0).alias("value")))
    if average_area:
        literal[_AREA_NO] = _AVERAGE_AREA_NO
        fixed.append(
            F.struct(
                F.lit(_AVERAGE_AREA_NO).alias("number"), grid.average_area(grid.resolution(F.col("h3"))).alias("value")
            )
        )
    # the axes of a constant are found by another number than its stored rows have, so these match none
    for stored, constant in literal.items():
        numbers = numbers.withColumn("number", F.when(F.col("number") == stored, constant).otherwise(F.col("number")))

    # once per cell, before the numerators multiply it
    wide = cells.withColumn("denominators", F.concat("denominators", F.array(*fixed))) if fixed else cells
    wide = wide.filter(F.size("denominators") > 0)
    rows = wide.select("h3", "has_population", "denominators", F.explode("numerators").alias("n"))
    over = axes.filter(F.col("numerator_uuid").isin(*constants)) if constants else None
    if over is not None and not over.isEmpty():
        # constant numerators over the stored denominators of each cell
        rows = rows.unionByName(
            cells.filter(F.size("denominators") > 0).select(
                "h3", F.lit(False).alias("has_population"), "denominators", F.explode(F.array(*fixed)).alias("n")
            )
        )
    rows = rows.select("h3", "has_population", "denominators", "n.number", "n.value")
    divided = (
        # staged, so that its size is known before the cells are read: else they would be shuffled by numerator
        attach(rows, stage(_axes_by_numerator(axes, numbers, carry)), ["number"])
        .select("h3", "has_population", "value", "axes", F.explode("denominators").alias("d"))
        .select("h3", "has_population", F.try_element_at("axes", F.col("d.number")).alias("axis"), ratio(F.col("value"), F.col("d.value")).alias("m"))
        .filter(F.col("m").isNotNull() & F.col("axis").isNotNull())
    )
    return divided.select("axis.axis_id", "h3", "m", "has_population", *[F.col(f"axis.{c}").alias(c) for c in carry])


def _axes_by_numerator(axes: DataFrame, numbers: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Per numerator its axes by the number of their denominator: (number, axes)."""
    numerators = numbers.toDF("numerator_uuid", "number")
    denominators = numbers.toDF("denominator_uuid", "_denominator")
    entry = F.struct("_denominator", F.struct("axis_id", *carry).alias("axis"))
    return (
        axes.join(numerators, "numerator_uuid")
        .join(denominators, "denominator_uuid")
        .groupBy("number")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("axes"))
    )
