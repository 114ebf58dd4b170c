import pytest

from hexstats import schemas
from hexstats.functions.grid import AVG_AREA_KM2
from hexstats.operators import quality
from tests.cells import A, B, IDS, axes, axis_table, cell, facts, metadata

ONE, AREA = schemas.ONE_ID, schemas.AREA_ID


def _children(res, value, *prefix, indicator=A):
    return [(cell(res, *prefix, i), indicator, value) for i in range(7)]


def _quality(spark, rows, *pairs):
    found = quality.axis_quality(facts(spark, rows), axes(spark, *pairs), IDS).collect()
    return {(r.numerator_uuid, r.denominator_uuid): r.quality for r in found}


def test_no_parent_rates_zero(spark):
    assert _quality(spark, [(cell(8, 1), A, 5)], (A, ONE))[(A, ONE)] == 0.0


def test_additive_indicator_over_area(spark):
    rows = [(cell(2, 3, 3), A, 70), *_children(3, 10, 3, 3)]
    found = _quality(spark, rows, (A, ONE), (A, AREA))
    # the sum fits the numerator, so the mean child (a seventh of the sum) is compared
    error = abs(70 - 10) / 80
    assert found[(A, ONE)] == pytest.approx(1 - error)
    here, below = 70 / AVG_AREA_KM2[2], 10 / AVG_AREA_KM2[3]
    assert found[(A, AREA)] == pytest.approx(1 - abs(here - below) / (here + below))


def test_average_indicator_over_one(spark):
    rows = [(cell(2, 3, 3), A, 10), *_children(3, 10, 3, 3)]
    assert _quality(spark, rows, (A, ONE))[(A, ONE)] == 1.0


def test_scaling_the_numerator_changes_nothing(spark):
    rows = [(cell(2, 3, 3), A, 60), *_children(3, 11, 3, 3), (cell(1, 3), A, 75)]
    scaled = [(h, i, v * 1000) for h, i, v in rows]
    for den in (ONE, AREA):
        assert _quality(spark, rows, (A, den))[(A, den)] == pytest.approx(_quality(spark, scaled, (A, den))[(A, den)])


def test_user_denominator_skips_coarsest_parents_and_counts_gaps(spark):
    rows = [(cell(1, 3), A, 70), *_children(2, 10, 3)]
    rows += [(cell(1, 4), A, 70), *_children(2, 10, 4)]
    rows += [(cell(1, 3), B, 7), *_children(2, 1, 3, indicator=B)]
    # parents of resolution 0 take no part
    rows += [(cell(0), A, 500), (cell(0), B, 3)]
    assert _quality(spark, rows, (A, B))[(A, B)] == pytest.approx(0.5)


def test_children_beyond_resolution_5_are_ignored(spark):
    rows = [(cell(5, 1), A, 70), *_children(6, 10, 1, 0, 0, 0, 0)]
    assert _quality(spark, rows, (A, ONE))[(A, ONE)] == 0.0


def test_downscale_waits_for_both_sides_and_keeps_what_is_set(spark):
    meta = metadata(spark, {"internal_id": A}, {"internal_id": B}, {"internal_id": "c", "downscale": "equal"})
    axis = axis_table(
        spark,
        {"numerator_uuid": A, "denominator_uuid": AREA, "quality": 0.9},
        {"numerator_uuid": A, "denominator_uuid": ONE, "quality": 0.3},
        {"numerator_uuid": B, "denominator_uuid": AREA, "quality": 0.9},
        {"numerator_uuid": B, "denominator_uuid": ONE},
        {"numerator_uuid": "c", "denominator_uuid": AREA, "quality": 0.9},
        {"numerator_uuid": "c", "denominator_uuid": ONE, "quality": 0.3},
    )
    found = {r.internal_id: r.downscale for r in quality.downscale(meta, axis, IDS).collect()}
    assert found == {A: "proportional", B: None, "c": "equal"}
