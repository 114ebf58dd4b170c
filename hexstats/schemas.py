"""Table layouts, states and system indicators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

AREA_ID = "00000000-0000-0000-0000-000000000000"
ONE_ID = "11111111-1111-1111-1111-111111111111"

NEW = "NEW"
READY = "READY"
OUTDATED = "OUTDATED"
TMP_CREATED = "TMP CREATED"
COPY_IN_PROGRESS = "COPY IN PROGRESS"
#: states an indicator must not have to take part in any calculation
DORMANT_STATES = (OUTDATED, TMP_CREATED, COPY_IN_PROGRESS)

#: finest resolution for which the system indicators are filled
SYSTEM_MAX_RES = 8
#: resolution at which a statistic is reported as "the" value of an axis
VALUE_RES = 8
#: children per parent cell
CHILDREN = 7


@dataclass(frozen=True)
class SystemIds:
    """Ids of the indicators every run refers to."""

    one: str = ONE_ID
    area: str = AREA_ID
    population: str | None = None

    @property
    def constants(self) -> tuple[str, str]:
        return self.one, self.area


FACTS = T.StructType(
    [
        T.StructField("h3", T.LongType()),
        T.StructField("indicator_uuid", T.StringType()),
        T.StructField("indicator_value", T.DoubleType()),
    ]
)

POINT = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])

METADATA = T.StructType(
    [
        T.StructField("param_id", T.StringType()),
        T.StructField("internal_id", T.StringType()),
        T.StructField("external_id", T.StringType()),
        T.StructField("param_label", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("is_base", T.BooleanType()),
        T.StructField("copyrights", T.ArrayType(T.StringType())),
        T.StructField("direction", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("description", T.StringType()),
        T.StructField("coverage", T.StringType()),
        T.StructField("update_frequency", T.StringType()),
        T.StructField("unit_id", T.StringType()),
        T.StructField("is_public", T.BooleanType()),
        T.StructField("max_res", T.IntegerType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("upload_id", T.StringType()),
        T.StructField("downscale", T.StringType()),
        # polygons of rings: a shell and its holes
        T.StructField("coverage_polygon", T.ArrayType(T.ArrayType(T.ArrayType(POINT)))),
    ]
)

STATISTICS = ("sum", "min", "max", "stddev", "median", "mean")
OVERRIDE_FIELDS = (
    "min", "max", "p25", "p75", "label", "min_label", "max_label", "p25_label", "p75_label",
)

_TRANSFORM_HEAD = [T.StructField("transformation", T.StringType())]
_TRANSFORM_TAIL = [
    T.StructField(name, T.DoubleType())
    for name in ("stddev", "mean", "debug_max", "lower_bound", "upper_bound", "skew")
]
TRANSFORM = T.StructType(
    _TRANSFORM_HEAD + [T.StructField("points", T.ArrayType(T.DoubleType()))] + _TRANSFORM_TAIL
)
DEFAULT_TRANSFORM = T.StructType(_TRANSFORM_HEAD + _TRANSFORM_TAIL)

AXIS = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("numerator", "denominator", "numerator_uuid", "denominator_uuid")
    ]
    + [
        T.StructField(f"{stat}_{part}", T.DoubleType())
        for stat in STATISTICS
        for part in ("value", "quality")
    ]
    + [
        T.StructField(name, T.DoubleType())
        for name in ("mean_all_res", "stddev_all_res", "min", "p25", "p75", "max", "quality")
    ]
    + [
        T.StructField(name, T.StringType())
        for name in ("label", "min_label", "max_label", "p25_label", "p75_label")
    ]
    + [
        T.StructField("transformations", T.ArrayType(TRANSFORM)),
        T.StructField("default_transform", DEFAULT_TRANSFORM),
    ]
)

OVERRIDES = T.StructType(
    [T.StructField("numerator_id", T.StringType()), T.StructField("denominator_id", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in ("min", "p25", "p75", "max")]
    + [
        T.StructField(name, T.StringType())
        for name in ("label", "min_label", "max_label", "p25_label", "p75_label")
    ]
)

PAIR_KEYS = ("x_numerator_id", "x_denominator_id", "y_numerator_id", "y_denominator_id")
CORRELATION = T.StructType(
    [T.StructField("correlation", T.DoubleType()), T.StructField("quality", T.DoubleType())]
    + [T.StructField(name, T.StringType()) for name in PAIR_KEYS]
)

UNFINISHED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("kind", "x_num", "x_den", "y_num", "y_den")]
)

#: finished work per axis; ``minimum`` is the axis' minimum when it ran
COMPLETED = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("kind", "numerator_uuid", "denominator_uuid")]
    + [T.StructField("minimum", T.DoubleType())]
)

MERCATOR_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
CELL_GEOMETRY = T.StructType(
    [
        T.StructField("h3", T.LongType()),
        T.StructField("resolution", T.IntegerType()),
        T.StructField("boundary", T.ArrayType(MERCATOR_POINT)),
    ]
)
CELL_BOUNDARY = T.StructType(
    [
        T.StructField("h3", T.LongType()),
        T.StructField("boundary", T.ArrayType(POINT)),
        T.StructField("area_km2", T.DoubleType()),
    ]
)
