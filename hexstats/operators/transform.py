"""Choice of the transformation that makes the distribution of an axis least skewed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats.functions.measures import within
from hexstats.operators import quantiles
from hexstats.operators.axis_values import (
    AXIS_KEYS, Packed, axis_values, number_axes, pack, staged, without_system_numerators,
)
from hexstats.schemas import SystemIds
from hexstats.sources.staging import stage
from hexstats.sources.tables import update_columns

# The histogram points, the guard against zero, the quality an axis needs.
POINTS = tuple(i / 100 for i in range(101))
EPSILON = 2.220446049250313e-16
MIN_QUALITY = 0.5
# Names of the transformations; ties go to the first.
NAMES = ("no", "square_root", "cube_root", "log", "log_epsilon")


def candidates(axis: DataFrame, ids: SystemIds) -> DataFrame:
    """Axes worth transforming: not rated, or rated well enough."""
    return without_system_numerators(axis, ids).filter(
        F.coalesce(F.col("quality"), F.lit(1.0)) >= MIN_QUALITY
    )


def histogram(facts: DataFrame | Packed, axis: DataFrame, ids: SystemIds) -> DataFrame:
    """Per axis: 101 discrete percentiles over all resolutions, and mean and deviation of the
    values within three deviations of the stored mean."""
    wanted = candidates(axis, ids)
    layer = stage(
        number_axes(wanted).join(
            wanted.select(
                *AXIS_KEYS,
                F.col("min").alias("layer_min"),
                F.col("mean_all_res").alias("layer_mean"),
                F.col("stddev_all_res").alias("layer_stddev"),
            ),
            AXIS_KEYS,
        )
    )
    if not isinstance(facts, Packed):
        facts = staged(pack(facts, layer, ids))
    values = axis_values(
        facts, layer, ids, literal_one=False, average_area=False, carry=("layer_mean", "layer_stddev")
    )
    points = quantiles.order_statistics(
        values.select("axis_id", "m"), ["axis_id"], "m", quantiles.discrete_ranks(POINTS)
    ).select(
        "axis_id", quantiles.discrete(F.col("n"), F.col("by_rank"), POINTS).alias("points")
    )
    centre = (
        values.filter(within(F.col("m"), F.col("layer_mean"), F.col("layer_stddev")))
        .groupBy("axis_id")
        .agg(F.stddev_samp("m").alias("new_stddev"), F.avg("m").alias("new_mean"))
    )
    return (
        layer.join(points, "axis_id")
        .join(centre, "axis_id", "left")
        .select(*AXIS_KEYS, "layer_min", "layer_mean", "layer_stddev", "new_mean", "new_stddev", "points")
    )


def log_domain(hist: DataFrame) -> DataFrame:
    """Mark axes whose points cannot all be logged: a stored minimum above the smallest value
    is stale and needs new analytics; a point exactly on the pole fails for good."""
    lowest = F.array_min("points") - F.col("layer_min") + EPSILON
    on_pole = F.exists(
        "points",
        lambda x: (x - F.col("layer_min") + 1 == 0) | (x - F.col("layer_min") + EPSILON == 0),
    )
    return hist.select(
        "*",
        F.coalesce(lowest < 0, F.lit(False)).alias("needs_analytics"),
        F.coalesce(on_pole, F.lit(False)).alias("log_of_zero"),
    )


def repair(hist: DataFrame) -> DataFrame:
    """Axes that must go through analytics again before they can be transformed."""
    return log_domain(hist).filter("needs_analytics").select(*AXIS_KEYS)


def _positive_log(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def transformed(hist: DataFrame) -> DataFrame:
    """Every point under every transformation: (axis, transformation, i, x, t, filters)."""
    x = F.col("x")
    shifted = x - F.col("layer_min")
    results = {
        "no": x,
        "square_root": F.signum(x) * F.sqrt(F.abs(x)),
        "cube_root": F.cbrt(x),
        "log": _positive_log(shifted + 1),
        "log_epsilon": _positive_log(shifted + EPSILON),
    }
    return (
        log_domain(hist)
        .filter("not needs_analytics and not log_of_zero")
        .select(
            *AXIS_KEYS, "layer_min", "layer_mean", "layer_stddev", "new_mean", "new_stddev",
            F.posexplode("points").alias("i", "x"),
        )
        .withColumn(
            "form",
            F.explode(
                F.array(
                    *[F.struct(F.lit(n).alias("transformation"), t.alias("t")) for n, t in results.items()]
                )
            ),
        )
        .select(
            *AXIS_KEYS,
            "form.transformation",
            "i",
            "x",
            "form.t",
            # both tests look at the value before the transformation
            within(x, F.col("new_mean"), F.col("new_stddev")).alias("near_centre"),
            within(x, F.col("layer_mean"), F.col("layer_stddev")).alias("near_layer"),
        )
    )


def transform_stats(hist: DataFrame) -> DataFrame:
    """Points, moments, bounds and adjusted skewness per axis and transformation."""
    t = F.col("t")
    central = F.when(F.col("near_centre"), t)
    bounded = F.when(F.col("near_layer"), t)
    grouped = (
        transformed(hist)
        .groupBy(*AXIS_KEYS, "transformation")
        .agg(
            F.array_sort(F.collect_list(F.struct("i", "t"))).alias("ordered"),
            F.count_if("near_centre").cast("double").alias("n"),
            F.min(bounded).alias("low"),
            F.max(bounded).alias("high"),
            F.stddev_samp(central).alias("stddev"),
            F.avg(central).alias("mean"),
        )
        .withColumn("points", F.transform("ordered", lambda p: p["t"]))
    )
    n, mean, stddev = F.col("n"), F.col("mean"), F.col("stddev")

    def cubed(p: Column) -> Column:
        z = (p - mean) / (stddev + EPSILON)
        return z * z * z

    inside = F.filter("points", lambda p: p.between(F.col("low"), F.col("high")))
    total = F.aggregate(inside, F.lit(0.0), lambda acc, p: acc + cubed(p))
    weight = n / F.nullif(n - 1, F.lit(0.0)) / F.nullif(n - 2, F.lit(0.0))
    return grouped.select(
        *AXIS_KEYS,
        "transformation",
        "points",
        "stddev",
        "mean",
        F.col("high").alias("debug_max"),
        F.greatest("low", mean - stddev * 3).alias("lower_bound"),
        F.least("high", mean + stddev * 3).alias("upper_bound"),
        F.when(F.size(inside) > 0, weight * total).alias("skew"),
    )


def best_transform(stats: DataFrame) -> DataFrame:
    """The least skewed transformation of each axis; a tie goes to leaving the values alone."""
    order = W.partitionBy(*AXIS_KEYS).orderBy(
        F.abs("skew").asc_nulls_last(), (F.col("transformation") != "no").asc(), F.col("transformation")
    )
    return (
        stats.withColumn("place", F.row_number().over(order)).filter("place = 1").drop("place", "points")
    )


_FIELDS = ("transformation", "points", "stddev", "mean", "debug_max", "lower_bound", "upper_bound", "skew")


def transform_result(stats: DataFrame) -> DataFrame:
    """Per axis: all transformations nested, and the best one without its points."""
    listed = stats.groupBy(*AXIS_KEYS).agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    F.array_position(F.array(*[F.lit(n) for n in NAMES]), F.col("transformation")).alias("place"),
                    F.struct(*_FIELDS).alias("entry"),
                )
            ),
            lambda a, b: (a["place"] - b["place"]).cast("int"),
        ).alias("placed")
    ).select(*AXIS_KEYS, F.transform("placed", lambda p: p["entry"]).alias("transformations"))
    chosen = best_transform(stats).select(
        *AXIS_KEYS, F.struct(*[f for f in _FIELDS if f != "points"]).alias("default_transform")
    )
    return listed.join(chosen, AXIS_KEYS)


def apply_transforms(axis: DataFrame, results: DataFrame) -> DataFrame:
    return update_columns(axis, results, AXIS_KEYS, ["transformations", "default_transform"])
