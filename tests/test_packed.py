"""Cells packed once and multiplied into axes while they are read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators import correlation
from hexstats.operators.axis_values import axis_values, number_axes, pack, staged
from hexstats.sources.staging import stage
from tests.cells import A, B, IDS, P, axes, cell, facts
from tests.test_correlation import _brute, _pairs

ONE, AREA = schemas.ONE_ID, schemas.AREA_ID
NAMES = [f"00000000-0000-4000-8000-{i:012d}" for i in range(8)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    cells = [cell(8, *map(int, np.base_repr(i, 7).zfill(8))) for i in range(600)]
    return [(h, name, rng.normal()) for name in (*NAMES, ONE, AREA, P) for h in cells if rng.random() < 0.8]


def staged_bytes(table):
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.inputFiles()[0]).getParent()
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def test_staged_bytes_follow_facts_not_axes(spark, rows):
    data = facts(spark, rows)
    few = stage(number_axes(axes(spark, *zip(NAMES, NAMES[1:] + NAMES[:1], strict=True))))
    many = stage(number_axes(axes(spark, *[(x, y) for x in NAMES for y in NAMES if x != y])))
    sizes = [staged_bytes(staged(pack(data, wanted, IDS)).cells) for wanted in (few, many)]
    assert sizes[1] < 1.1 * sizes[0]
    values = [axis_values(staged(pack(data, w, IDS)), w, IDS, literal_one=False, average_area=False).count() for w in (few, many)]
    assert values[1] > 6 * values[0]


@pytest.mark.parametrize("one, area", [(True, False), (False, False), (True, True)])
def test_a_shared_copy_gives_the_same_values(spark, rows, one, area):
    data = facts(spark, rows)
    every = [(x, y) for x in (*NAMES[:3], ONE, P) for y in (NAMES[0], NAMES[4], ONE, AREA) if x != y]
    wanted = stage(number_axes(axes(spark, *every)))
    some = stage(wanted.filter("axis_id % 3 <> 0"))
    shared = staged(pack(data, wanted, IDS, population=P))
    rules = {"literal_one": one, "average_area": area, "population": P}
    found = [sorted(map(tuple, axis_values(source, some, IDS, **rules).collect())) for source in (data, shared)]
    assert found[0] == found[1] and found[0]


def test_nothing_is_shuffled_after_the_multiplication(spark, rows):
    wanted = stage(number_axes(axes(spark, *[(x, y) for x in NAMES for y in NAMES if x != y])))
    values = axis_values(staged(pack(facts(spark, rows), wanted, IDS)), wanted, IDS, literal_one=True, average_area=False)
    plan = values._jdf.queryExecution().executedPlan().toString()
    above = plan.split("try_element_at")[0] if "try_element_at" in plan else plan.split("Generate")[0]
    assert "Exchange" not in above


@pytest.fixture
def small_broadcasts(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    yield
    spark.conf.set(key, before)


def test_values_are_exchanged_before_they_are_listed(spark, rows):
    wanted = stage(number_axes(axes(spark, *zip(NAMES, NAMES[1:] + NAMES[:1], strict=True))))
    plan = pack(facts(spark, rows), wanted, IDS, population=P).cells._jdf.queryExecution().executedPlan().toString()
    # the plan is printed from its end: both steps of the lists stand above the exchange by cell
    assert plan.index("hashpartitioning(h3") > plan.rindex("collect_list(")


@pytest.mark.parametrize("one, area", [(True, False), (False, False), (True, True)])
def test_cells_are_multiplied_where_they_are_read(spark, rows, small_broadcasts, one, area):
    wanted = stage(number_axes(axes(spark, *[(x, y) for x in NAMES for y in (*NAMES, ONE, AREA) if x != y])))
    values = axis_values(staged(pack(facts(spark, rows), wanted, IDS)), wanted, IDS, literal_one=one, average_area=area)
    plan = values._jdf.queryExecution().executedPlan().toString()
    # neither exchanged by numerator before, nor filtered by functions that are not compiled
    assert "hashpartitioning" not in plan and "lambda" not in plan
    assert "BroadcastHashJoin" in plan


def test_correlations_of_shared_cells(spark, rows):
    data = facts(spark, rows)
    wanted = stage(number_axes(axes(spark, *[(x, y) for x in (*NAMES[:3], ONE) for y in (NAMES[4], ONE, AREA) if x != y])))
    x, y = wanted.select("axis_id"), wanted.select(F.col("axis_id").alias("other"))
    pairs = stage(x.join(y, F.col("axis_id") < F.col("other")).select(correlation.pack_pair(F.col("axis_id"), F.col("other")).alias("pair")))
    shared = staged(pack(data, wanted, IDS, population=P))
    own, found = (
        {r.pair: r.correlation for r in correlation.correlate_packed(cells, wanted, pairs, IDS).collect()} for cells in (data, shared)
    )
    assert found.keys() == own.keys() and any(found.values())
    assert all(found[k] == (r if r is None else pytest.approx(r, rel=1e-9)) for k, r in own.items())


@pytest.mark.parametrize("slices, group", [(1024, 2_000_000), (4, 30)])
def test_moments_put_together_cancel_nothing(spark, monkeypatch, slices, group):
    monkeypatch.setattr(correlation, "_SLICE_CELLS", slices)
    monkeypatch.setattr(correlation, "GROUP_VALUES", group)
    h = [cell(8, i, j, k) for i in range(7) for j in range(7) for k in range(2)]
    rows = [(c, A, 1 + 1e-7 * (i % 5) if i < 60 else i * 1e9) for i, c in enumerate(h)]
    rows += [(c, B, 5e8 + (i % 5) ** 2 + (i % 3)) for i, c in enumerate(h[:60])]
    rows += [(c, P, 0.1 if i < 60 else float(i)) for i, c in enumerate(h)]
    wanted = _pairs(spark, (A, ONE, B, ONE), (B, ONE, P, ONE), (A, ONE, P, ONE))
    found = {(r.x_numerator_id, r.y_numerator_id): r.correlation for r in correlation.correlate(facts(spark, rows), wanted, IDS).collect()}
    assert found[(A, B)] == pytest.approx(_brute(rows, A, B), rel=1e-6)
    assert found[(B, P)] is None  # constant on the common cells
    assert found[(A, P)] == pytest.approx(_brute(rows, A, P), rel=1e-9)
