import numpy as np
import pytest

from hexstats import schemas
from hexstats.functions.grid import AVG_AREA_KM2
from hexstats.operators import candidates, correlation
from tests.cells import A, B, C, IDS, axis_table, cell, empty, facts, metadata

ONE, AREA = schemas.ONE_ID, schemas.AREA_ID
KEYS = ", ".join(f"{k} string" for k in schemas.PAIR_KEYS)


def _pairs(spark, *rows):
    return spark.createDataFrame(list(rows), KEYS)


def _ids(n):
    return [f"00000000-0000-4000-8000-{i:012d}" for i in range(n)]


def _random_facts(n_indicators, n_cells, seed):
    """Indicators with gaps, one with a very large share of the rows."""
    rng = np.random.default_rng(seed)
    cells = [cell(8, *map(int, np.base_repr(i, 7).zfill(8))) for i in range(n_cells)]
    rows = []
    for k, name in enumerate(_ids(n_indicators)):
        share = 1.0 if k == 0 else rng.uniform(0.1, 0.5)
        common = np.arange(n_cells) * (k % 3)
        for i, h in enumerate(cells):
            if rng.random() < share:
                rows.append((h, name, float(common[i] + rng.normal(1e6 * k, n_cells))))
    return rows


def _brute(rows, x, y):
    a = {h: v for h, i, v in rows if i == x}
    b = {h: v for h, i, v in rows if i == y}
    both = sorted(a.keys() & b.keys())
    if len(both) < 2:
        return None
    return float(np.corrcoef([a[h] for h in both], [b[h] for h in both])[0, 1])


@pytest.mark.parametrize("block, group", [(512, 2_000_000), (3, 200)])
def test_blocks_and_groups_do_not_change_the_result(spark, monkeypatch, block, group):
    monkeypatch.setattr(correlation, "BLOCK_AXES", block)
    monkeypatch.setattr(correlation, "GROUP_VALUES", group)
    rows = _random_facts(10, 300, 7)
    names = _ids(10)
    wanted = [(x, ONE, y, ONE) for x in names for y in names if x > y]
    found = correlation.correlate(facts(spark, rows), _pairs(spark, *wanted), IDS).collect()
    assert len(found) == len(wanted)
    for r in found:
        assert r.correlation == pytest.approx(_brute(rows, r.x_numerator_id, r.y_numerator_id), rel=1e-9)


def test_constant_side_is_null(spark):
    h = [cell(8, i) for i in range(3)]
    rows = [(h[0], A, 1), (h[1], A, 1), (h[0], B, 2), (h[1], B, 3), (h[2], B, 9)]
    row = correlation.correlate(facts(spark, rows), _pairs(spark, (A, ONE, B, ONE)), IDS).first()
    assert row.correlation is None


def test_side_constant_only_on_common_cells_is_null(spark):
    h = [cell(8, i, j) for i in range(7) for j in range(7)]
    rows = [(c, A, 0.1 if i < 5 else i * 1e7) for i, c in enumerate(h)] + [(c, B, i) for i, c in enumerate(h[:5])]
    row = correlation.correlate(facts(spark, rows), _pairs(spark, (A, ONE, B, ONE)), IDS).first()
    assert row.correlation is None


def test_nearly_constant_side_is_exact(spark):
    h = [cell(8, i, j) for i in range(7) for j in range(7)]
    rows = [(c, A, 1 + 1e-9 * (i % 4) if i < 20 else i * 1e6) for i, c in enumerate(h)]
    rows += [(c, B, (i % 4) ** 2) for i, c in enumerate(h[:20])]
    row = correlation.correlate(facts(spark, rows), _pairs(spark, (A, ONE, B, ONE)), IDS).first()
    assert row.correlation == pytest.approx(_brute(rows, A, B), rel=1e-6)


def test_no_common_cells_is_null(spark):
    rows = [(cell(8, 1), A, 1), (cell(8, 2), B, 1)]
    assert correlation.correlate(facts(spark, rows), _pairs(spark, (A, ONE, B, ONE)), IDS).first().correlation is None


def test_area_is_the_average_of_the_resolution(spark):
    rows = [(cell(r, i), A, 1 + r * i) for r in (1, 2, 3) for i in range(4)]
    rows += [(h, B, v * v) for h, _, v in rows]
    x = [v / AVG_AREA_KM2[(h >> 52) & 15] for h, i, v in rows if i == A]
    y = [v for h, i, v in rows if i == B]
    row = correlation.correlate(facts(spark, rows), _pairs(spark, (A, AREA, B, ONE)), IDS).first()
    assert row.correlation == pytest.approx(float(np.corrcoef(x, y)[0, 1]))


def test_prune_keeps_the_larger_numerator(spark):
    kept = correlation.prune(_pairs(spark, (A, ONE, B, ONE), (B, ONE, A, ONE), (A, ONE, C, ONE))).collect()
    assert {(r.x_numerator_id, r.y_numerator_id) for r in kept} == {(B, A), (A, C)}


def _axis(spark):
    return axis_table(
        spark,
        {"numerator_uuid": A, "denominator_uuid": ONE, "quality": 0.6},
        {"numerator_uuid": B, "denominator_uuid": ONE, "quality": 0.7},
    )


def test_update_is_symmetric_scored_and_repeatable(spark):
    rows = _random_facts(2, 50, 1)
    names = {_ids(2)[0]: A, _ids(2)[1]: B}
    data = facts(spark, [(h, names[i], v) for h, i, v in rows])
    pairs = _pairs(spark, (A, ONE, B, ONE), (B, ONE, A, ONE), (C, ONE, A, ONE))
    once = correlation.update_correlations(empty(spark, schemas.CORRELATION), data, pairs, _axis(spark), IDS)
    twice = correlation.update_correlations(once, data, pairs, _axis(spark), IDS)
    for table in (once, twice):
        found = table.collect()
        # the pair with an unknown axis is dropped
        assert {(r.x_numerator_id, r.y_numerator_id) for r in found} == {(A, B), (B, A)}
        assert len({r.correlation for r in found}) == 1
        assert all(r.quality == pytest.approx(0.88) for r in found)


def test_candidates(spark, monkeypatch):
    meta = metadata(
        spark,
        {"internal_id": A, "external_id": "a"},
        {"internal_id": B, "external_id": "b", "is_base": True},
        {"internal_id": C, "external_id": "a"},
        {"internal_id": "gone", "external_id": "g", "state": "OUTDATED"},
        {"internal_id": ONE, "external_id": ONE, "is_base": True},
    )
    axis = axis_table(
        spark,
        *[{"numerator_uuid": n, "denominator_uuid": ONE, "quality": q} for n, q in ((A, 0.6), (B, 0.9), (C, 0.51), ("gone", 0.9))],
        {"numerator_uuid": A, "denominator_uuid": B, "quality": 0.5},
    )
    known = spark.createDataFrame([(0.1, 0.1, C, ONE, B, ONE)], schemas.CORRELATION)
    for tile in (2_000, 1):
        monkeypatch.setattr("hexstats.functions.pairing.TILE_ROWS", tile)
        found = candidates.new_correlations(meta, axis, known).collect()
        assert {(r.x_numerator_id, r.y_numerator_id) for r in found} == {(A, B)}


def test_new_axes_and_indicators(spark):
    meta = metadata(
        spark,
        {"internal_id": A, "external_id": "a", "state": "NEW", "param_id": "a"},
        {"internal_id": B, "external_id": "b", "is_base": True, "param_id": "b"},
        {"internal_id": C, "external_id": "b", "state": "NEW", "param_id": "b"},
        {"internal_id": "t", "external_id": "t", "state": "TMP CREATED", "param_id": "t"},
    )
    added = candidates.new_axes(meta, empty(spark, schemas.AXIS))
    assert [(r.numerator, r.denominator, r.numerator_uuid) for r in added.collect()] == [("a", "b", A)]
    assert [r.indicator_uuid for r in candidates.new_indicators(meta, added).collect()] == [A]
    again = candidates.new_axes(meta, axis_table(spark, {"numerator_uuid": A, "denominator_uuid": B}))
    assert again.count() == 0
