import math

import pytest
from pyspark.sql import functions as F

from hexstats.functions import grid

CELL = 0x8928308280FFFFF
PARENT = 0x8828308281FFFFF


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_resolution_and_parent(spark):
    row = one(spark, grid.resolution(F.lit(CELL)), grid.parent(F.lit(CELL)))
    assert row[0] == 9
    assert row[1] == PARENT


def test_parent_of_coarsest_cell_is_null(spark):
    base_cell = (1 << 59) | (20 << 45) | ((1 << 45) - 1)
    assert one(spark, grid.parent(F.lit(base_cell)))[0] is None


def test_resolution_range_equals_resolution_bits(spark):
    cells = [(1 << 59) | (r << 52) | (b << 45) | 123 for r in range(16) for b in (0, 57, 121)]
    df = spark.createDataFrame([(c,) for c in cells], "h3 long")
    for low, high in ((0, 0), (1, 5), (0, 8), (9, 15)):
        by_range = df.filter(grid.resolution_between(F.col("h3"), low, high)).count()
        by_bits = df.filter(grid.resolution(F.col("h3")).between(low, high)).count()
        assert by_range == by_bits == 3 * (high - low + 1)


def test_resolution_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "cells")
    spark.range(10).select(F.col("id").alias("h3")).write.parquet(path)
    plan = (
        spark.read.parquet(path)
        .filter(grid.resolution_between(F.col("h3"), 1, 5))
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "GreaterThanOrEqual(h3," in plan and "LessThanOrEqual(h3," in plan


def test_average_areas_shrink_by_about_seven():
    for coarse, fine in zip(grid.AVG_AREA_KM2, grid.AVG_AREA_KM2[1:]):
        assert 6.9 < coarse / fine < 7.2


def _ring(points):
    return F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in points])


def test_area_of_an_octant(spark):
    octant = one(spark, grid.area_km2(_ring([(0.0, 0.0), (90.0, 0.0), (0.0, 90.0)])))[0]
    assert octant == pytest.approx(4 * math.pi * grid.AUTHALIC_RADIUS_KM**2 / 8, rel=1e-9)


def test_area_across_antimeridian_and_around_pole(spark):
    plain = _ring([(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0)])
    across = _ring([(179.0, 0.0), (-179.0, 0.0), (-179.0, 2.0), (179.0, 2.0)])
    cap = _ring([(float(x), 80.0) for x in range(-180, 180, 10)])
    row = one(spark, grid.area_km2(plain), grid.area_km2(across), grid.area_km2(cap))
    assert row[0] == pytest.approx(row[1], rel=1e-9)
    whole_cap = 2 * math.pi * grid.AUTHALIC_RADIUS_KM**2 * (1 - math.sin(math.radians(80)))
    assert row[2] == pytest.approx(whole_cap, rel=0.02)


def test_mercator(spark):
    out = one(spark, grid.mercator(_ring([(0.0, 0.0), (180.0, 45.0)])))[0]
    assert out[0].x == pytest.approx(0, abs=1e-6) and out[0].y == pytest.approx(0, abs=1e-6)
    assert out[1].x == pytest.approx(20037508.342789, rel=1e-9)
    assert out[1].y == pytest.approx(5621521.486192, rel=1e-9)
