"""Rounds that follow a first one: finished work stays finished, existing axes are maintained."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from hexstats import schemas
from hexstats.operators import lifecycle
from hexstats.plans import refresh
from hexstats.sources.staging import stage
from tests.cells import A, B, IDS, axis_table, cell, empty, facts, metadata
from tests.test_coverage import hexagon

NOW = datetime(2024, 2, 3, 12)
HERE, THERE = [[cell(8, k, j, base=base) for k in range(5) for j in range(7)] for base in (20, 30)]


@pytest.fixture(scope="module")
def base(spark):
    """Indicator A comes as an upload; the base indicator B has values in other cells only."""
    rows = [(h, B, 2.0 + k) for k, h in enumerate(THERE)]
    boundary = [(h, hexagon(k, j), None) for j, cells in enumerate((HERE, THERE)) for k, h in enumerate(cells)]
    versions = metadata(
        spark,
        {"internal_id": A, "external_id": "a", "param_id": "a", "state": "COPY IN PROGRESS", "upload_id": "u1", "date": NOW},
        {"internal_id": "old", "external_id": "a", "param_id": "a", "date": NOW - timedelta(days=9)},
        {"internal_id": B, "external_id": "b", "param_id": "b", "is_base": True, "date": NOW},
    )
    return refresh.Base(
        facts=facts(spark, rows), metadata=versions, axis=axis_table(spark),
        correlation=empty(spark, schemas.CORRELATION), overrides=empty(spark, schemas.OVERRIDES),
        cell_boundary=spark.createDataFrame(boundary, schemas.CELL_BOUNDARY),
        cell_geometry=empty(spark, "h3 long, resolution int, boundary array<struct<x: double, y: double>>"),
        completed=refresh.no_completed(spark),
    )


def _staged(base):
    return base if base is None else replace(base, **{
        name: stage(getattr(base, name)) for name in base.__dataclass_fields__
    })


@pytest.fixture(scope="module")
def first(spark, base):
    staged = spark.createDataFrame(
        [("u1", h, A, float(k + 1)) for k, h in enumerate(HERE)],
        "upload_id string, h3 long, indicator_uuid string, indicator_value double",
    )
    uploads = spark.createDataFrame([("u1",)], "upload_id string")
    return _staged(refresh.run(base, staged, uploads, "me", NOW)), staged, uploads


@pytest.fixture(scope="module")
def second(spark, first):
    done, staged, uploads = first
    overrides = spark.createDataFrame(
        [("a", "b", None, None, None, None, "new label", None, None, None, None)], schemas.OVERRIDES
    )
    return _staged(refresh.run(replace(done, overrides=overrides), staged, uploads, "me", NOW))


def _states(base):
    return {r.internal_id: r.state for r in base.metadata.collect()}


def test_an_axis_without_common_cells_does_not_hold_back_publication(first):
    done = first[0]
    axis = {(r.numerator_uuid, r.denominator_uuid): r for r in done.axis.collect()}
    assert axis[(A, B)].mean_all_res is None
    assert _states(done)[A] == "READY"
    assert "old" not in _states(done)


def test_without_records_such_an_axis_counts_as_open(first):
    done = first[0]
    none_open = done.correlation.select(*schemas.PAIR_KEYS).limit(0)
    live = lifecycle.unfinished_work(done.metadata, done.axis, none_open, IDS)
    assert any(r.kind == "analytics" and (r.x_num, r.x_den) == (A, B) for r in live.collect())
    known = lifecycle.unfinished_work(done.metadata, done.axis, none_open, IDS, done.completed)
    assert not any((r.x_num, r.x_den) == (A, B) for r in known.collect())


def test_new_overrides_reach_existing_axes(first, second):
    labels = {(r.numerator_uuid, r.denominator_uuid): r.label for r in second.axis.collect()}
    assert labels[(A, B)] == "new label"
    assert first[0].axis.count() == len(labels)


def test_an_upload_is_not_taken_twice(first, second):
    assert second.facts.count() == first[0].facts.count()
    assert _states(second) == _states(first[0])


def test_an_unfinished_axis_is_measured_in_the_next_round(spark, first):
    done = first[0]
    one = "11111111-1111-1111-1111-111111111111"
    keep = [c for c in done.axis.columns if c in ("numerator", "denominator", "numerator_uuid", "denominator_uuid")]
    bare = done.axis.select(*keep)
    emptied = done.axis.limit(0).unionByName(bare, allowMissingColumns=True)
    again = refresh.measure_axes(replace(done, axis=emptied, completed=refresh.no_completed(spark)), "me")
    means = {(r.numerator_uuid, r.denominator_uuid): r.mean_all_res for r in again.axis.collect()}
    before = {(r.numerator_uuid, r.denominator_uuid): r.mean_all_res for r in done.axis.collect()}
    assert means == before and means[(A, one)] is not None
