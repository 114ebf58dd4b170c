"""Per-resolution statistics, class breaks and cross-resolution spread of axes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.functions import grid
from hexstats.functions.measures import spread
from hexstats.operators import quantiles
from hexstats.operators.axis_values import (
    AXIS_KEYS, Packed, axis_values, number_axes, pack, staged, without_system_numerators,
)
from hexstats.operators.overrides import with_external_ids
from hexstats.schemas import SystemIds
from hexstats.sources.staging import stage
from hexstats.sources.tables import update_columns

# The class breaks of an axis.
PERCENTILES = (0.33, 0.5, 0.66)
#: stands for "all resolutions" inside the jobs; results carry NULL instead
_ALL = -1
_STAT_KEYS = ("sum", "min", "max", "mean", "stddev", "p33", "p50", "p66")


def fully_overridden(axes: DataFrame, overrides: DataFrame, metadata: DataFrame) -> DataFrame:
    """Axes whose min, p25, p75 and max are all set by hand."""
    complete = overrides.filter("min is not null and p25 is not null and p75 is not null and max is not null")
    return (
        with_external_ids(axes.select(*AXIS_KEYS), metadata)
        .join(complete, ["numerator_id", "denominator_id"], "left_semi")
        .select(*AXIS_KEYS)
        .distinct()
    )


def _moments(values: DataFrame) -> DataFrame:
    """Sums and squared deviations per (axis, resolution) and, merged from them, per axis."""
    per_res = values.groupBy("axis_id", "res").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("m").alias("sum"),
        F.min("m").alias("min"),
        F.max("m").alias("max"),
        F.avg("m").alias("mean"),
        (F.var_pop("m") * F.count(F.lit(1))).alias("m2"),
    )
    # at most 16 rows per axis
    whole = F.sum("sum").over(W.partitionBy("axis_id")) / F.sum("n").over(W.partitionBy("axis_id"))
    total = (
        per_res.withColumn("centre", whole)
        .withColumn("shift", F.col("n") * (F.col("mean") - F.col("centre")) * (F.col("mean") - F.col("centre")))
        .groupBy("axis_id")
        .agg(
            F.lit(_ALL).alias("res"),
            F.sum("n").alias("n"),
            F.sum("sum").alias("sum"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.first("centre").alias("mean"),
            (F.sum("m2") + F.sum("shift")).alias("m2"),
        )
    )
    return per_res.unionByName(total)


def _breaks(values: DataFrame) -> DataFrame:
    """p33, p50, p66 per (axis, resolution) and per axis, over the rows that count for stops."""
    eligible = values.filter("counts_for_stops").select("axis_id", "res", "m")
    per_res = quantiles.histogram(eligible, ["axis_id", "res"], "m")
    total = per_res.groupBy("axis_id", "slot").agg(
        F.lit(_ALL).alias("res"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    found = quantiles.order_statistics(
        eligible,
        ["axis_id", "res"],
        "m",
        quantiles.continuous_ranks(PERCENTILES),
        counts=per_res.unionByName(total),
        total_of=("res", _ALL),
    )
    return found.select(
        "axis_id",
        "res",
        *[
            quantiles.continuous(F.col("n"), F.col("by_rank"), p).alias(name)
            for p, name in zip(PERCENTILES, ("p33", "p50", "p66"))
        ],
    )


def statistics(
    facts: DataFrame | Packed, axes: DataFrame, metadata: DataFrame, overrides: DataFrame, ids: SystemIds
) -> DataFrame:
    """One row per axis and resolution, plus one per axis over all resolutions (r NULL).

    The class breaks look only at cells with population, unless the axis is fully overridden
    (then only the median is wanted, unfiltered), its numerator is the population itself, or no
    population is published. Axes over system numerators are left out.

    The cells are staged as they are in the facts, and multiplied into axes in every pass over them.
    """
    numbered = stage(
        number_axes(without_system_numerators(axes, ids))
        .join(
            fully_overridden(axes, overrides, metadata).withColumn("overridden", F.lit(True)), AXIS_KEYS, "left"
        )
        .withColumn("overridden", F.coalesce(F.col("overridden"), F.lit(False)))
    )
    unfiltered = F.col("overridden")
    if ids.population is None:
        unfiltered = F.lit(True)
    else:
        unfiltered = unfiltered | (F.col("numerator_uuid") == ids.population)
    rules = stage(numbered.select("axis_id", *AXIS_KEYS, unfiltered.alias("unfiltered")))
    if not isinstance(facts, Packed):
        facts = staged(pack(facts, rules, ids, population=ids.population, without=(ids.one,)))
    values = axis_values(facts, rules, ids, literal_one=True, average_area=False, carry=("unfiltered",)).select(
        "axis_id",
        grid.resolution(F.col("h3")).alias("res"),
        "m",
        (F.col("unfiltered") | F.col("has_population")).alias("counts_for_stops"),
    )
    stops_wanted = ~F.col("overridden")
    return (
        _moments(values)
        .join(_breaks(values), ["axis_id", "res"], "left")
        .join(numbered, "axis_id")
        .select(
            *AXIS_KEYS,
            F.nullif(F.col("res"), F.lit(_ALL)).alias("r"),
            "overridden",
            F.nullif(F.col("sum"), F.lit(0.0)).alias("sum"),
            "min",
            "max",
            F.nullif(F.col("mean"), F.lit(0.0)).alias("mean"),
            F.nullif(F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0))), F.lit(0.0)).alias("stddev"),
            F.when(stops_wanted, F.col("p33")).alias("p33"),
            "p50",
            F.when(stops_wanted, F.col("p66")).alias("p66"),
        )
    )


def stat_quality(stats: DataFrame) -> DataFrame:
    """Long form: per axis and statistic, its resolution-8 value and its spread over resolutions.

    The spread runs over all rows, the one for all resolutions included.
    """
    long = stats.unpivot([*AXIS_KEYS, "r"], list(_STAT_KEYS), "key", "stat")
    at_value_res = F.max(F.when(F.col("r") == schemas.VALUE_RES, F.col("stat")))
    return (
        long.groupBy(*AXIS_KEYS, "key")
        .agg(at_value_res.alias("value"), F.min("stat").alias("low"), F.max("stat").alias("high"))
        .select(
            *AXIS_KEYS,
            "key",
            "value",
            F.when(F.col("value").isNotNull(), spread("low", "high")).alias("quality"),
        )
    )


def analytics(stats: DataFrame) -> DataFrame:
    """One wide row per axis from its statistics rows.

    ``overridden`` tells the caller to leave min, p25, p75 and max of the axis alone.
    """
    at_value_res = F.col("r") == schemas.VALUE_RES
    overall = F.col("r").isNull()
    aggregates, columns = [], []
    for name in schemas.STATISTICS:
        key = "p50" if name == "median" else name
        aggregates += [
            F.max(F.when(at_value_res, F.col(key))).alias(f"{name}_value"),
            F.min(key).alias(f"{name}_low"),
            F.max(key).alias(f"{name}_high"),
        ]
        value = F.col(f"{name}_value")
        columns += [
            value,
            F.when(value.isNotNull(), spread(f"{name}_low", f"{name}_high")).alias(f"{name}_quality"),
        ]
    for source, target in (
        ("mean", "mean_all_res"), ("stddev", "stddev_all_res"),
        ("min", "min"), ("p33", "p25"), ("p66", "p75"), ("max", "max"),
    ):
        aggregates.append(F.max(F.when(overall, F.col(source))).alias(f"all_{target}"))
        columns.append(F.col(f"all_{target}").alias(target))
    return (
        stats.groupBy(*AXIS_KEYS, "overridden").agg(*aggregates).select(*AXIS_KEYS, "overridden", *columns)
    )


def apply_analytics(axis: DataFrame, results: DataFrame) -> DataFrame:
    """Write the results into the axis table; stops of overridden axes stay untouched."""
    measured = [f"{s}_{part}" for s in schemas.STATISTICS for part in ("value", "quality")]
    measured += ["mean_all_res", "stddev_all_res"]
    stops = ["min", "p25", "p75", "max"]
    kept = results.join(
        axis.select(*AXIS_KEYS, *[F.col(c).alias(f"_old_{c}") for c in stops]), AXIS_KEYS
    ).select(
        *AXIS_KEYS,
        *measured,
        *[F.when(F.col("overridden"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in stops],
    )
    return update_columns(axis, kept, AXIS_KEYS, measured + stops)
