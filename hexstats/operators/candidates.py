"""Which axes and which pairs of axes should exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.functions.pairing import apart, hashed, is_known, match_numbered
from hexstats.operators.axis_values import AXIS_KEYS, number_axes, number_rows
from hexstats.sources.staging import stage
from hexstats.sources.tables import active

# Fixed value: axes must be rated better than this to be correlated.
CORRELATION_QUALITY = 0.5


def _axis_sides(live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Versions as numerators, and the base ones as denominators."""
    numerators = live.select(
        F.col("param_id").alias("numerator"),
        F.col("internal_id").alias("numerator_uuid"),
        F.col("external_id").alias("numerator_external"),
    )
    bases = live.filter("is_base").select(
        F.col("param_id").alias("denominator"),
        F.col("internal_id").alias("denominator_uuid"),
        F.col("external_id").alias("denominator_external"),
    )
    return numerators, bases


def _other_logical() -> Column:
    return F.col("numerator_external") != F.col("denominator_external")


def new_axes(metadata: DataFrame, axis: DataFrame) -> DataFrame:
    """Axes still missing: every active indicator over every active base indicator of another
    logical indicator."""
    # versions are made distinct here, never their combinations
    numerators, bases = _axis_sides(active(metadata).dropDuplicates(["internal_id"]))
    x = stage(number_rows(numerators, "numerator_uuid", "x"))
    y = stage(number_rows(bases, "denominator_uuid", "y"))
    known = (
        axis.select(*AXIS_KEYS)
        .join(x.select("x", "numerator_uuid"), "numerator_uuid")
        .join(y.select("y", "denominator_uuid"), "denominator_uuid")
        .select("x", "y", F.lit(0).alias("way"))
    )
    return match_numbered(x, y, known, _other_logical() & ~is_known()).select(*AXIS_KEYS, "numerator", "denominator")


def lacking_axes(metadata: DataFrame, axis: DataFrame) -> DataFrame:
    """Numerators of ``new_axes``, (numerator_uuid, missing): how many axes of theirs are missing.

    Counted from the bases and the axes there are, so no axis is formed.
    """
    live = active(metadata).select("param_id", "internal_id", "external_id", "is_base")
    numerators, bases = _axis_sides(stage(live.dropDuplicates(["internal_id"])))
    bases = bases.filter(F.col("denominator_external").isNotNull())
    same = bases.groupBy(F.col("denominator_external").alias("numerator_external")).agg(F.count(F.lit(1)).alias("own"))
    known = (
        axis.select(*AXIS_KEYS)
        .distinct()
        .join(numerators.select("numerator_uuid", "numerator_external"), "numerator_uuid")
        .join(bases.select("denominator_uuid", "denominator_external"), "denominator_uuid")
        .filter(_other_logical())
        .groupBy("numerator_uuid")
        .agg(F.count(F.lit(1)).alias("known"))
    )
    return (
        numerators.filter(F.col("numerator_external").isNotNull())
        .join(same, "numerator_external", "left")
        .join(known, "numerator_uuid", "left")
        .crossJoin(F.broadcast(bases.agg(F.count(F.lit(1)).alias("bases"))))
        .select("numerator_uuid", (F.col("bases") - _or_none("own") - _or_none("known")).alias("missing"))
        .filter("missing > 0")
    )


def _or_none(count: str) -> Column:
    return F.coalesce(F.col(count), F.lit(0))


def new_indicators(metadata: DataFrame, added_axes: DataFrame) -> DataFrame:
    """NEW indicators that are numerators of the added axes."""
    numerators = added_axes.select(F.col("numerator_uuid").alias("internal_id")).distinct()
    return (
        metadata.filter(F.col("state") == schemas.NEW)
        .join(numerators, "internal_id", "left_semi")
        .select(F.col("internal_id").alias("indicator_uuid"))
        .distinct()
    )


def _good_axes(metadata: DataFrame, axis: DataFrame) -> DataFrame:
    """Distinct well-rated axes of active indicators, with external id and ``is_base`` of the numerator."""
    live = active(metadata).select("internal_id", "external_id", "is_base").dropDuplicates(["internal_id"])
    return (
        axis.filter(F.col("quality") > CORRELATION_QUALITY)
        .select(*AXIS_KEYS)
        .distinct()
        .join(live.select(F.col("internal_id").alias("denominator_uuid")), "denominator_uuid", "left_semi")
        .join(live.withColumnRenamed("internal_id", "numerator_uuid"), "numerator_uuid")
    )


def _pair_side(df: DataFrame, name: str) -> DataFrame:
    return df.select(
        F.col("numerator_uuid").alias(f"{name}_numerator_id"),
        F.col("denominator_uuid").alias(f"{name}_denominator_id"),
        F.col("external_id").alias(f"{name}_external"),
        F.col("is_base").alias(f"{name}_is_base"),
        *([F.col("axis_id").alias(name)] if "axis_id" in df.columns else []),
    )


def _known_pairs(correlation: DataFrame, good: DataFrame) -> DataFrame:
    """Known correlations between well-rated axes; they may repeat."""
    known = correlation.select(*schemas.PAIR_KEYS)
    for s in "xy":
        known = known.join(_pair_side(good, s), [f"{s}_numerator_id", f"{s}_denominator_id"])
    return known


def new_correlations(
    metadata: DataFrame, axis: DataFrame, correlation: DataFrame, *, pruned: bool = False
) -> DataFrame:
    """Ordered pairs of well-rated axes whose correlation is not known yet.

    The first axis has a non-base numerator; versions of one logical indicator are not compared. If
    ``pruned``, of two mirrored pairs only the one with the larger x numerator comes, as from
    ``correlation.prune``: whether the mirror image is a pair too is told from the pair itself.
    """
    good = _good_axes(metadata, axis)
    good = stage(number_axes(good).join(good, AXIS_KEYS))
    known = _known_pairs(correlation, good)
    ways = known.select("x", "y", F.lit(0).alias("way"))
    # a version has one external id, so axes of different ones have different numerators
    wanted = apart("x_external", "y_external") & ~is_known()
    if pruned:
        ways = ways.unionByName(known.select(F.col("y").alias("x"), F.col("x").alias("y"), F.lit(1).alias("way")))
        mirrored = ~F.coalesce(F.col("y_is_base"), F.lit(True)) & ~is_known(1)
        wanted = wanted & ~((F.col("x_numerator_id") < F.col("y_numerator_id")) & mirrored)
    compared = good.filter(F.col("external_id").isNotNull())

    def side(df: DataFrame, name: str, *more: str) -> DataFrame:
        keys = [c for c in schemas.PAIR_KEYS if c.startswith(name)]
        return _pair_side(df, name).select(name, *keys, *hashed(F.col(f"{name}_external"), f"{name}_external"), *more)

    x, y = side(compared.filter("not is_base"), "x"), side(compared, "y", "y_is_base")
    return match_numbered(x, y, ways, wanted, ways=2 if pruned else 1).select(*schemas.PAIR_KEYS)


def count_new_correlations(metadata: DataFrame, axis: DataFrame, correlation: DataFrame) -> DataFrame:
    """In how many pairs of ``new_correlations`` an axis stands first and second: (axis keys, as_x, as_y).

    Counted from the axes of each logical indicator and the known pairs, so no pair is formed.
    """
    good = stage(_good_axes(metadata, axis))
    compared = good.filter(F.col("external_id").isNotNull())
    firsts = F.count_if(~F.col("is_base"))
    of_one = compared.groupBy("external_id").agg(F.count(F.lit(1)).alias("own"), firsts.alias("own_firsts"))
    total = compared.agg(F.count(F.lit(1)).alias("all"), firsts.alias("all_firsts"))
    known = _known_pairs(correlation.select(*schemas.PAIR_KEYS).distinct(), good).filter("not x_is_base and x_external != y_external")
    known_as = {
        s: known.groupBy(f"{s}_numerator_id", f"{s}_denominator_id")
        .agg(F.count(F.lit(1)).alias(f"known_as_{s}"))
        .toDF(*AXIS_KEYS, f"known_as_{s}")
        for s in "xy"
    }
    as_x = F.col("all") - F.col("own") - _or_none("known_as_x")
    as_y = F.col("all_firsts") - F.col("own_firsts") - _or_none("known_as_y")
    return (
        compared.join(of_one, "external_id")
        .join(known_as["x"], AXIS_KEYS, "left")
        .join(known_as["y"], AXIS_KEYS, "left")
        .crossJoin(F.broadcast(total))
        .select(*AXIS_KEYS, F.when(~F.col("is_base"), as_x).otherwise(F.lit(0)).alias("as_x"), as_y.alias("as_y"))
    )
