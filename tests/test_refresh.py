"""A whole round over data derived from the driver's tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from hexstats import schemas
from hexstats.plans import refresh
from hexstats.sources.staging import stage

NOW = datetime(2024, 2, 3, 12)


@pytest.fixture(scope="module")
def done(spark, sf_dir):
    facts = fx.facts(spark, sf_dir)
    uploaded = facts.filter(F.col("indicator_uuid") == fx.AVG_ORDER)
    staged = uploaded.select(F.lit("u5").alias("upload_id"), *schemas.FACTS.names)
    metadata = spark.createDataFrame([], schemas.METADATA).unionByName(
        fx.metadata(spark, sf_dir)
        .withColumn("state", F.when(F.col("internal_id") == fx.AVG_ORDER, "COPY IN PROGRESS").otherwise(F.col("state")))
        .withColumn("upload_id", F.when(F.col("internal_id") == fx.AVG_ORDER, "u5")),
        allowMissingColumns=True,
    )
    base = refresh.Base(
        facts=facts.filter(F.col("indicator_uuid") != fx.AVG_ORDER),
        metadata=stage(metadata),
        axis=fx.empty_axis(spark),
        correlation=spark.createDataFrame([], schemas.CORRELATION),
        overrides=stage(spark.createDataFrame([], schemas.OVERRIDES).unionByName(fx.overrides(spark, sf_dir))),
        cell_boundary=fx.cell_boundary(spark, sf_dir),
        cell_geometry=spark.createDataFrame(
            [], "h3 long, resolution int, boundary array<struct<x: double, y: double>>"
        ),
        completed=refresh.no_completed(spark),
    )
    uploads = spark.createDataFrame([("u5",)], "upload_id string")
    return refresh.run(base, staged, uploads, fx.OWNER, NOW)


def test_states(done):
    states = {r.internal_id: r.state for r in done.metadata.collect()}
    assert states[fx.AVG_ORDER] == "READY"
    # the newer version of revenue has replaced the older one, which is gone altogether
    assert states[fx.REVENUE_V2] == "READY" and fx.REVENUE not in states
    assert "OUTDATED" not in states.values() and "COPY IN PROGRESS" not in states.values()
    assert states[fx.uuid(8)] == "TMP CREATED"


def test_nothing_refers_to_removed_versions(done):
    known = {r.internal_id for r in done.metadata.collect()}
    for table, columns in (
        (done.facts, ["indicator_uuid"]),
        (done.axis, ["numerator_uuid", "denominator_uuid"]),
        (done.correlation, list(schemas.PAIR_KEYS)),
    ):
        for column in columns:
            assert {r[0] for r in table.select(column).distinct().collect()} <= known


def test_system_indicators_cover_all_cells(done):
    data = done.facts.filter(~F.col("indicator_uuid").isin(fx.ONE, fx.AREA)).select("h3").distinct()
    for indicator in (fx.ONE, fx.AREA):
        rows = done.facts.filter(F.col("indicator_uuid") == indicator)
        assert rows.count() == rows.select("h3").distinct().count()
        assert data.join(rows, "h3", "left_anti").count() == 0


def test_results(done):
    axis = {(r.numerator_uuid, r.denominator_uuid): r for r in done.axis.collect()}
    row = axis[(fx.AVG_ORDER, fx.ONE)]
    assert 0.5 < row.quality <= 1 and row.mean_all_res > 0
    assert len(row.transformations) == 5 and row.default_transform.transformation
    balance = axis[(fx.ACCTBAL, fx.ORDERS)]
    assert balance.min == -5.0 and balance.label == "Balance"
    assert all(-1 - 1e-9 <= r.correlation <= 1 + 1e-9 for r in done.correlation.collect() if r.correlation is not None)
    assert done.correlation.count() > 0
    meta = {r.internal_id: r for r in done.metadata.collect()}
    assert meta[fx.AVG_ORDER].max_res == 8 and meta[fx.AVG_ORDER].coverage_polygon
    assert meta[fx.AVG_ORDER].downscale in ("equal", "proportional")


def test_cells_of_recent_indicators_are_drawn(done):
    assert done.cell_geometry.count() == done.cell_geometry.select("h3").distinct().count() > 0
