"""Zoom consistency of axes, and how an indicator may be downscaled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.functions import grid
from hexstats.functions.measures import ratio, relative_error
from hexstats.operators.axis_values import AXIS_KEYS, listed, without_system_numerators
from hexstats.schemas import SystemIds
from hexstats.sources.staging import stage

# Children of resolution 1 to 5 are compared with their parents.
FIRST_CHILD_RES, LAST_CHILD_RES = 1, 5


def _cell_profiles(facts: DataFrame) -> DataFrame:
    """Per indicator and coarse cell: its own value, and sum and average over its children.

    Every row reports once for its own cell and once for the parent, so own value and children
    meet in one aggregation instead of a join of the facts with themselves.
    """
    cell = F.col("h3")
    reports = F.array(
        F.struct(cell.alias("cell"), F.lit(True).alias("own")),
        F.struct(grid.parent(cell).alias("cell"), F.lit(False).alias("own")),
    )
    own = F.col("report.own")
    value = F.col("indicator_value")
    return (
        facts.filter(grid.resolution_between(cell, 0, LAST_CHILD_RES))
        .withColumn("report", F.explode(reports))
        .filter(F.col("report.cell").isNotNull())
        .groupBy("indicator_uuid", F.col("report.cell").alias("cell"))
        .agg(
            F.bool_or(own).alias("has_row"),
            F.bool_or(~own).alias("has_children"),
            F.max(F.when(own, value)).alias("value"),
            F.sum(F.when(~own, value)).alias("children_sum"),
            F.avg(F.when(~own, value)).alias("children_avg"),
        )
    )


def _similarity(a, b):
    return F.lit(1.0) - F.avg(relative_error(a, b))


def axis_quality(facts: DataFrame, axes: DataFrame, ids: SystemIds) -> DataFrame:
    """Quality of every axis, 0 (worst) to 1: do a cell and its children tell the same story?

    Stored values of a parent are compared with those derived from its children, once treating
    the numerator as additive and once as an average; the reading that fits the numerator on
    its own is the one that counts. A user denominator also has to cover the numerator's cells.
    """
    axes = without_system_numerators(axes, ids).select(*AXIS_KEYS).distinct()
    named = listed(axes, "numerator_uuid").unionByName(listed(axes, "denominator_uuid")).distinct()
    # a fraction of the facts: coarse cells only, and one row for seven children
    profiles = stage(_cell_profiles(facts.join(named, "indicator_uuid", "left_semi")))
    numerators = (
        profiles.filter("has_row and has_children")
        .join(listed(axes, "numerator_uuid"), "indicator_uuid", "left_semi")
        .withColumnRenamed("indicator_uuid", "numerator_uuid")
        .withColumn("res", grid.resolution(F.col("cell")))
    )
    # user denominators leave out parents of resolution 0
    user_only = F.col("res") >= FIRST_CHILD_RES

    def reading(children: str, condition=None):
        error = relative_error(F.col("value"), F.col(children))
        return F.lit(1.0) - F.avg(error if condition is None else F.when(condition, error))

    numerator_fit = numerators.groupBy("numerator_uuid").agg(
        reading("children_avg").alias("system_avg"),
        reading("children_sum").alias("system_sum"),
        reading("children_avg", user_only).alias("user_avg"),
        reading("children_sum", user_only).alias("user_sum"),
        F.count_if(user_only).alias("user_cells"),
    )

    users = listed(axes, "denominator_uuid", without=ids.constants)
    cell_denominators = (
        profiles.join(users, "indicator_uuid", "left_semi")
        .groupBy("cell")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("indicator_uuid").alias("denominator_uuid"),
                    F.col("value").alias("here"),
                    (F.col("children_sum") / schemas.CHILDREN).alias("below"),
                    F.lit(True).alias("user"),
                )
            ).alias("stored")
        )
    )
    one = F.lit(1.0)
    constants = F.array(
        F.struct(
            F.lit(ids.one).alias("denominator_uuid"), one.alias("here"), one.alias("below"), F.lit(False).alias("user")
        ),
        F.struct(
            F.lit(ids.area).alias("denominator_uuid"),
            grid.average_area(F.col("res")).alias("here"),
            grid.average_area(F.col("res") + 1).alias("below"),
            F.lit(False).alias("user"),
        ),
    )
    compared = (
        numerators.join(cell_denominators, "cell", "left")
        .withColumn("d", F.explode(F.concat(constants, F.coalesce(F.col("stored"), F.array()))))
        .filter(~F.col("d.user") | user_only)
        .select(
            "numerator_uuid",
            F.col("d.denominator_uuid").alias("denominator_uuid"),
            F.col("d.here").alias("here"),
            ratio(F.col("value"), F.col("d.here")).alias("actual"),
            ratio(F.col("children_sum") / schemas.CHILDREN, F.col("d.below")).alias("via_sum"),
            ratio(F.col("children_avg"), F.col("d.below")).alias("via_avg"),
        )
        .join(axes, AXIS_KEYS, "left_semi")
        .groupBy(*AXIS_KEYS)
        .agg(
            _similarity(F.col("actual"), F.col("via_avg")).alias("zoom_avg"),
            _similarity(F.col("actual"), F.col("via_sum")).alias("zoom_sum"),
            F.count("here").alias("covered"),
        )
    )
    system = F.col("denominator_uuid").isin(*ids.constants)
    averaged = F.when(system, F.col("system_avg") > F.col("system_sum")).otherwise(
        F.col("user_avg") > F.col("user_sum")
    )
    fill = F.when(system, F.lit(1.0)).otherwise(
        F.col("covered").cast("double") / F.nullif(F.col("user_cells"), F.lit(0)).cast("double")
    )
    score = F.when(averaged, F.col("zoom_avg")).otherwise(F.col("zoom_sum")) * fill
    return (
        axes.join(compared, AXIS_KEYS, "left")
        .join(numerator_fit, "numerator_uuid", "left")
        .select(*AXIS_KEYS, F.coalesce(score, F.lit(0.0)).alias("quality"))
    )


def downscale(metadata: DataFrame, axis: DataFrame, ids: SystemIds) -> DataFrame:
    """Fill ``downscale`` of indicators whose axes over area and over one are both rated."""

    def over(denominator: str):
        return F.max(F.when(F.col("denominator_uuid") == denominator, F.col("quality")))

    rated = (
        axis.filter(F.col("denominator_uuid").isin(*ids.constants))
        .groupBy(F.col("numerator_uuid").alias("internal_id"))
        .agg(over(ids.area).alias("by_area"), over(ids.one).alias("by_one"))
        .filter(F.col("by_area").isNotNull() & F.col("by_one").isNotNull())
        .select(
            "internal_id",
            F.when(F.col("by_area") > F.col("by_one"), F.lit("proportional"))
            .otherwise(F.lit("equal"))
            .alias("found"),
        )
    )
    return (
        metadata.join(rated, "internal_id", "left")
        .withColumn("downscale", F.coalesce(F.col("downscale"), F.col("found")))
        .select(*metadata.columns)
    )
