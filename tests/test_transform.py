import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators import transform
from tests.cells import A, B, IDS, axis_table, cell, facts

ONE = schemas.ONE_ID
_STATS = "numerator_uuid string, denominator_uuid string, transformation string, points array<double>, " + ", ".join(
    f"{c} double" for c in ("stddev", "mean", "debug_max", "lower_bound", "upper_bound", "skew")
)


def _axis(spark, values, **more):
    x = np.array(values, dtype=float)
    row = {"numerator_uuid": A, "denominator_uuid": ONE, "quality": 0.9, "min": float(x.min()),
           "mean_all_res": float(x.mean()), "stddev_all_res": float(x.std(ddof=1))}
    return axis_table(spark, {**row, **more})


def _facts(spark, values):
    rows = [(cell(8, *map(int, np.base_repr(i, 7).zfill(8))), A, v) for i, v in enumerate(values)]
    return facts(spark, rows + [(h, ONE, 1) for h, _, _ in rows])


def test_against_plain_computation(spark):
    values = np.sort(np.random.default_rng(3).lognormal(0, 1, 500))
    hist = transform.histogram(_facts(spark, values), _axis(spark, values), IDS)
    found = {r.transformation: r for r in transform.transform_stats(hist).collect()}
    assert set(found) == set(transform.NAMES)
    n = len(values)
    x = np.array([values[max(1, math.ceil(i / 100 * n)) - 1] for i in range(101)])
    mean, sd = values.mean(), values.std(ddof=1)
    near = values[(values >= mean - 3 * sd) & (values <= mean + 3 * sd)]
    centre = (x >= near.mean() - 3 * near.std(ddof=1)) & (x <= near.mean() + 3 * near.std(ddof=1))
    layer = (x >= mean - 3 * sd) & (x <= mean + 3 * sd)
    eps = 2.220446049250313e-16
    forms = {
        "no": x, "square_root": np.sign(x) * np.sqrt(abs(x)), "cube_root": np.cbrt(x),
        "log": np.log10(x - values.min() + 1), "log_epsilon": np.log10(x - values.min() + eps),
    }
    for name, t in forms.items():
        m, s, low, high = t[centre].mean(), t[centre].std(ddof=1), t[layer].min(), t[layer].max()
        k = centre.sum()
        inside = t[(t >= low) & (t <= high)]
        skew = k / (k - 1) / (k - 2) * (((inside - m) / (s + eps)) ** 3).sum()
        row = found[name]
        assert row.points == pytest.approx(list(t))
        assert (row.mean, row.stddev, row.debug_max) == pytest.approx((m, s, high))
        assert row.lower_bound == pytest.approx(max(low, m - 3 * s))
        assert row.upper_bound == pytest.approx(min(high, m + 3 * s))
        assert row.skew == pytest.approx(skew)


def _best(spark, *skews):
    rows = [(A, B, name, [1.0], 0.0, 0.0, 0.0, 0.0, 0.0, skew) for name, skew in skews]
    return transform.best_transform(spark.createDataFrame(rows, _STATS)).first().transformation


def test_best(spark):
    assert _best(spark, ("log", -0.5), ("no", 0.5), ("cube_root", 0.7)) == "no"
    assert _best(spark, ("log", -0.1), ("no", 0.5)) == "log"
    assert _best(spark, ("no", None), ("log", 5.0)) == "log"


def test_result_has_fixed_order_and_no_points_in_default(spark):
    rows = [(A, B, name, [1.0, 2.0], 0.0, 0.0, 0.0, 0.0, 0.0, 1.0 + i) for i, name in enumerate(sorted(transform.NAMES))]
    row = transform.transform_result(spark.createDataFrame(rows, _STATS)).first()
    assert [t.transformation for t in row.transformations] == list(transform.NAMES)
    assert row.default_transform.transformation == "cube_root"
    assert "points" not in row.default_transform.asDict()


def test_low_quality_axes_are_skipped_and_unrated_ones_are_not(spark):
    values = [1.0, 2.0, 3.0]
    assert transform.histogram(_facts(spark, values), _axis(spark, values, quality=0.4), IDS).count() == 0
    assert transform.histogram(_facts(spark, values), _axis(spark, values, quality=None), IDS).count() == 1


def test_stale_minimum_goes_back_to_analytics(spark):
    values = [1.0, 2.0, 3.0]
    hist = transform.histogram(_facts(spark, values), _axis(spark, values, min=1.5), IDS)
    assert [r.numerator_uuid for r in transform.repair(hist).collect()] == [A]
    assert transform.transform_stats(hist).count() == 0
    fresh = transform.histogram(_facts(spark, values), _axis(spark, values), IDS)
    assert transform.repair(fresh).count() == 0


def test_two_points_have_no_skew(spark):
    values = [1.0]
    hist = transform.histogram(_facts(spark, values), _axis(spark, values, stddev_all_res=None), IDS)
    assert transform.transform_stats(hist).filter(F.col("skew").isNotNull()).count() == 0
