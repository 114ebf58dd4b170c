"""System rows of a few new cells: the rest of the system indicators is not moved."""

from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators import system
from hexstats.sources import stored, tables
from tests.cells import A, B, IDS, cell, facts

ONE, AREA = schemas.ONE_ID, schemas.AREA_ID


def _stored(spark, path):
    """Many old cells with system rows, and an upload that has three of them and two new ones."""
    old = [cell(8, i, j, k) for i in range(7) for j in range(7) for k in range(7)]
    new = [cell(8, 3, 3, 3, 1), cell(8, 3, 3, 3, 2)]
    rows = [(h, i, 1.0) for h in old for i in (ONE, AREA, B)] + [(h, A, 2.0) for h in [*old[150:153], *new]]
    tables.write_facts(facts(spark, [*rows, (new[0], AREA, 7.0), (cell(9, 1), A, 1.0)]), path, partitions=2)
    return tables.read_facts(spark, path), old, new


def test_only_cells_of_the_upload_are_looked_up(spark, tmp_path):
    data, old, new = _stored(spark, str(tmp_path / "facts"))
    upload = spark.createDataFrame([(A,), (ONE,)], "indicator_uuid string")
    found = system.missing_cells(data, IDS, upload)
    assert {(r.h3, r.has_area) for r in found.collect()} == {(new[0], True), (new[1], False)}
    # with everything looked at, B's cells are there as well, all of them filled
    assert {(r.h3, r.has_area) for r in system.missing_cells(data, IDS).collect()} == {(new[0], True), (new[1], False)}


def test_system_rows_are_dropped_in_the_scan(spark, tmp_path):
    data, old, new = _stored(spark, str(tmp_path / "facts"))
    cells = data.filter(F.col("indicator_uuid") == A).select("h3").distinct()
    rows = data.filter(F.col("indicator_uuid").isin(ONE, AREA))
    left, seen = stored.counted(system.rows_of_cells(rows, cells), rows=F.count(F.lit(1)))
    left.write.format("noop").mode("overwrite").save()
    assert stored.measured(seen, "rows") == 2 * 3 + 1  # of 2 * 343 + 1
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "GreaterThanOrEqual(h3" in plan and "LessThanOrEqual(h3" in plan
    assert system.rows_of_cells(rows, cells.limit(0)).count() == 0


def test_cells_without_boundary_are_filled_later(spark):
    here, there = cell(8, 1), cell(8, 2)
    missing = system.missing_cells(facts(spark, [(here, A, 1), (there, A, 1)]), IDS)
    boundary = spark.createDataFrame([(here, None, 3.0), (there, None, None)], schemas.CELL_BOUNDARY)
    rows = system.system_rows(missing, boundary, IDS)
    assert {tuple(r) for r in rows.collect()} == {(here, ONE, 1.0), (here, AREA, 3.0)}
    assert [r.h3 for r in system.cells_without_area(missing, boundary).collect()] == [there]
    later = system.missing_cells(facts(spark, [(here, A, 1), (there, A, 1)]).unionByName(rows), IDS)
    assert [r.h3 for r in later.collect()] == [there]


def test_an_upload_with_an_infinite_value_is_left_alone(spark):
    from hexstats.operators import lifecycle
    from tests.cells import metadata

    meta = metadata(spark, *[{"internal_id": i, "upload_id": u, "state": "COPY IN PROGRESS"} for i, u in ((A, "u1"), (B, "u2"))])
    staged = spark.createDataFrame(
        [("u1", 1, A, 1.0), ("u1", 2, A, float("-inf")), ("u2", 1, B, 1.0)],
        "upload_id string, h3 long, indicator_uuid string, indicator_value double",
    )
    rows, after = lifecycle.ingest(staged, staged.select("upload_id").distinct(), meta)
    assert [r.indicator_uuid for r in rows.collect()] == [B]
    assert {r.internal_id: r.state for r in after.collect()} == {A: "COPY IN PROGRESS", B: "NEW"}


def test_of_several_overrides_the_largest_counts(spark):
    from hexstats.operators import overrides
    from tests.cells import axis_table, metadata

    meta = metadata(spark, {"internal_id": A, "external_id": "a"}, {"internal_id": B, "external_id": "b"})
    axis = axis_table(spark, {"numerator_uuid": A, "denominator_uuid": B, "min": 0.5})
    rows = [("a", "b", low, None, None, None, label, None, None, None, None) for low, label in ((1.0, "z"), (2.0, None), (2.0, "k"), (None, "zz"))]
    for order in (rows, rows[::-1]):
        found = overrides.apply_overrides(axis, spark.createDataFrame(order, schemas.OVERRIDES), meta).first()
        assert (found["min"], found["label"]) == (2.0, "k")
