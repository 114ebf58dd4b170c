import math

import pytest

from hexstats import schemas
from hexstats.functions.measures import spread
from hexstats.operators import analytics
from tests.cells import A, B, C, IDS, P, axes, axis_table, cell, empty, facts, metadata


def _stats(spark, rows, pairs, overrides=None, meta=None, ids=IDS):
    meta = meta if meta is not None else metadata(spark)
    overrides = overrides if overrides is not None else empty(spark, schemas.OVERRIDES)
    return analytics.statistics(facts(spark, rows), axes(spark, *pairs), meta, overrides, ids)


@pytest.mark.parametrize(
    "low, high, expected",
    [(1.0, 100.0, 2.0), (-1.0, 9.0, 1.0), (0.0, 9.0, None), (-9.0, 0.0, None), (-100.0, -1.0, -2.0), (None, 1.0, None)],
)
def test_spread(spark, low, high, expected):
    df = spark.createDataFrame([(low, high)], "low double, high double")
    found = df.select(spread("low", "high")).first()[0]
    assert found is None if expected is None else found == pytest.approx(expected)


def test_rows_per_resolution_and_total(spark):
    rows = [(cell(1, 0), A, 6), (cell(1, 1), A, 8), (cell(2, 0, 0), A, 10), (cell(1, 0), B, 2), (cell(1, 1), B, 0),
            (cell(2, 0, 0), B, 5)]
    found = {r.r: r for r in _stats(spark, rows, [(A, B)]).collect()}
    # a zero denominator gives no value
    assert set(found) == {1, 2, None}
    assert (found[1].sum, found[1].mean, found[1].stddev) == (3.0, 3.0, None)
    assert (found[None].sum, found[None].min, found[None].max, found[None].mean) == (5.0, 2.0, 3.0, 2.5)
    assert found[None].stddev == pytest.approx(math.sqrt(0.5))


def test_one_needs_no_stored_rows_and_zero_sums_are_null(spark):
    rows = [(cell(8, 1), A, 5), (cell(8, 2), A, -5)]
    total = next(r for r in _stats(spark, rows, [(A, schemas.ONE_ID)]).collect() if r.r is None)
    assert total.sum is None and total.mean is None
    assert (total.min, total.max) == (-5.0, 5.0)


def test_stops_look_only_at_populated_cells(spark):
    rows = [(cell(8, i), A, i) for i in range(5)] + [(cell(8, 1), P, 0), (cell(8, 3), P, 7)]
    total = next(r for r in _stats(spark, rows, [(A, schemas.ONE_ID)]).collect() if r.r is None)
    assert total.p50 == 2.0 and total.p33 == pytest.approx(1.66) and total.p66 == pytest.approx(2.32)
    own = next(r for r in _stats(spark, rows, [(P, schemas.ONE_ID)]).collect() if r.r is None)
    assert own.p50 == 3.5
    without = _stats(spark, rows, [(A, schemas.ONE_ID)], ids=schemas.SystemIds())
    assert next(r for r in without.collect() if r.r is None).p33 == pytest.approx(1.32)


def test_full_override_keeps_stops(spark):
    rows = [(cell(8, i), A, i) for i in range(5)] + [(cell(8, 4), P, 1)]
    meta = metadata(
        spark,
        {"internal_id": A, "external_id": "ea"},
        {"internal_id": schemas.ONE_ID, "external_id": schemas.ONE_ID},
    )
    override = spark.createDataFrame(
        [{"numerator_id": "ea", "denominator_id": schemas.ONE_ID, "min": 0.0, "p25": 1.0, "p75": 2.0, "max": 3.0}],
        schemas.OVERRIDES,
    )
    stats = _stats(spark, rows, [(A, schemas.ONE_ID)], override, meta)
    table = axis_table(
        spark, {"numerator_uuid": A, "denominator_uuid": schemas.ONE_ID, "min": -1.0, "p25": -2.0, "p75": -3.0, "max": -4.0}
    )
    row = analytics.apply_analytics(table, analytics.analytics(stats)).first()
    assert (row.min, row.p25, row.p75, row.max) == (-1.0, -2.0, -3.0, -4.0)
    # the median is taken over all cells, populated or not
    assert row.median_value == 2.0 and row.mean_all_res == 2.0


def test_value_is_the_one_of_resolution_8(spark):
    rows = [(cell(8, 1), A, 1), (cell(7, 1), A, 100)]
    row = analytics.analytics(_stats(spark, rows, [(A, schemas.ONE_ID)], ids=schemas.SystemIds())).first()
    assert row.max_value == 1.0 and row.max_quality == pytest.approx(2.0)
    assert row.sum_quality == pytest.approx(math.log10(101))
    coarse_only = analytics.analytics(_stats(spark, rows[1:], [(A, schemas.ONE_ID)], ids=schemas.SystemIds())).first()
    assert coarse_only.max_value is None and coarse_only.max_quality is None


def test_system_numerators_are_left_out(spark):
    rows = [(cell(8, 1), schemas.ONE_ID, 1), (cell(8, 1), B, 1)]
    assert _stats(spark, rows, [(schemas.ONE_ID, B), (schemas.AREA_ID, B)]).count() == 0


def test_axis_without_common_cells_keeps_its_row(spark):
    table = axis_table(spark, {"numerator_uuid": A, "denominator_uuid": B})
    stats = _stats(spark, [(cell(8, 1), A, 1), (cell(8, 2), B, 1)], [(A, B)])
    assert analytics.apply_analytics(table, analytics.analytics(stats)).count() == 1


def test_stat_quality_matches_wide_form(spark):
    rows = [(cell(8, i), A, i + 1) for i in range(6)] + [(cell(7, 1), A, 50), (cell(8, 1), C, 3)]
    stats = _stats(spark, rows, [(A, schemas.ONE_ID)])
    wide = analytics.analytics(stats).first()
    for r in analytics.stat_quality(stats).collect():
        name = {"p50": "median"}.get(r.key, r.key)
        if name in schemas.STATISTICS:
            assert wide[f"{name}_value"] == r.value and wide[f"{name}_quality"] == r.quality
