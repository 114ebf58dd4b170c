"""Values of axes that are set by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats.operators.axis_values import AXIS_KEYS
from hexstats.schemas import OVERRIDE_FIELDS


def with_external_ids(axes: DataFrame, metadata: DataFrame) -> DataFrame:
    """Axes of known indicators with the logical indicators they belong to."""
    external = metadata.select("internal_id", "external_id")
    return axes.join(external.toDF("numerator_uuid", "numerator_id"), "numerator_uuid").join(
        external.toDF("denominator_uuid", "denominator_id"), "denominator_uuid"
    )


def _given(axes: DataFrame, overrides: DataFrame, metadata: DataFrame) -> DataFrame:
    """Per axis the values set for it, as ``_set_<field>``.

    Of several overrides of one axis the largest counts, field by field in their fixed order, with
    NULL as the smallest.
    """
    logical = ["numerator_id", "denominator_id"]
    one = overrides.groupBy(*logical).agg(F.max(F.struct(*OVERRIDE_FIELDS)).alias("given"))
    return (
        with_external_ids(axes.select(*AXIS_KEYS), metadata)
        .join(one, logical)
        .select(*AXIS_KEYS, *[F.col(f"given.{f}").alias(f"_set_{f}") for f in OVERRIDE_FIELDS])
    )


def _applied(joined: DataFrame, columns: list[str]) -> DataFrame:
    return joined.select(
        *[F.coalesce(F.col(f"_set_{c}"), F.col(c)).alias(c) if c in OVERRIDE_FIELDS else F.col(c) for c in columns]
    )


def apply_overrides(axis: DataFrame, overrides: DataFrame, metadata: DataFrame) -> DataFrame:
    """Replace the fields an override sets, keep the others.

    Overrides name logical indicators, so all versions of one receive them.
    """
    return _applied(axis.join(_given(axis, overrides, metadata), AXIS_KEYS, "left"), axis.columns)


def overridden_axes(axis: DataFrame, overrides: DataFrame, metadata: DataFrame) -> DataFrame:
    """Only the axes that have an override, with it applied: keys and the fields that can be set."""
    return _applied(axis.join(_given(axis, overrides, metadata), AXIS_KEYS), [*AXIS_KEYS, *OVERRIDE_FIELDS])


def _known(metadata: DataFrame, name: str) -> DataFrame:
    return metadata.select(F.col("external_id").alias(name)).distinct()


def without_orphans(overrides: DataFrame, metadata: DataFrame) -> DataFrame:
    for name in ("numerator_id", "denominator_id"):
        overrides = overrides.join(_known(metadata, name), name, "left_semi").select(*overrides.columns)
    return overrides


def orphaned(overrides: DataFrame, metadata: DataFrame) -> DataFrame:
    """Overrides one of whose logical indicators no longer exists."""
    no_numerator = overrides.join(_known(metadata, "numerator_id"), "numerator_id", "left_anti")
    no_denominator = overrides.join(_known(metadata, "numerator_id"), "numerator_id", "left_semi").join(
        _known(metadata, "denominator_id"), "denominator_id", "left_anti"
    )
    return no_numerator.select(*overrides.columns).unionByName(no_denominator.select(*overrides.columns))
