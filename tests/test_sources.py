import os
import glob

from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators.axis_values import axis_values, number_axes
from hexstats.sources import staging, tables
from tests.cells import A, B, C, IDS, P, axes, cell, facts


def test_facts_round_trip_prunes_by_indicator_and_cell(spark, tmp_path):
    path = str(tmp_path / "facts")
    data = facts(spark, [(cell(8, i), ind, i) for i in range(7) for ind in (A, B)])
    tables.write_facts(data, path, partitions=3)
    tables.write_facts(facts(spark, [(cell(7, 1), A, 9)]), path)
    back = tables.read_facts(spark, path)
    assert back.schema.names == schemas.FACTS.names and back.count() == 15
    plan = back.filter((F.col("indicator_uuid") == A) & (F.col("h3") > 5))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(indicator_uuid" in plan and "GreaterThan(h3,5)" in plan


def test_hot_indicator_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "facts")
    hot = [(i, A, 1) for i in range(3_000)] + [(1, B, 1)]
    tables.write_facts(facts(spark, hot), path, partitions=4)
    assert len(glob.glob(f"{path}/indicator_uuid={A}/*.parquet")) > 1


def test_uploads_are_read_with_their_id(spark, tmp_path):
    path = str(tmp_path / "uploads")
    facts(spark, [(1, A, 1)]).write.parquet(f"{path}/upload_id=u1")
    facts(spark, [(1, B, 1)]).write.parquet(f"{path}/upload_id=u2")
    found = tables.read_uploads(spark, path)
    assert {(r.upload_id, r.indicator_uuid) for r in found.collect()} == {("u1", A), ("u2", B)}


def test_upload_tables_lists_names(spark):
    spark.range(1).createOrReplaceTempView("tmp_stat_h3_u1")
    assert "tmp_stat_h3_u1" in {r.table_name for r in tables.upload_tables(spark).collect()}
    spark.catalog.dropTempView("tmp_stat_h3_u1")


def test_stage_cuts_the_lineage(spark):
    staged = staging.stage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()
    assert staged.agg(F.sum("x")).first()[0] == 20


def test_axis_values_read_only_the_indicators_of_the_axes(spark, tmp_path):
    path = str(tmp_path / "facts")
    tables.write_facts(facts(spark, [(cell(8, 1), i, 1) for i in (A, B, C, P)]), path, partitions=2)
    numbered = staging.stage(number_axes(axes(spark, (A, B), (A, schemas.ONE_ID))))
    values = axis_values(
        tables.read_facts(spark, path), numbered, IDS, literal_one=True, average_area=False, population=P
    )
    plan = values._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("dynamicpruning#") == 2
    assert {(r.m, r.has_population) for r in values.collect()} == {(1.0, True)} and values.count() == 2


def test_dropped_indicators_leave_the_table(spark):
    spark.sql("drop table if exists fact_table")
    facts(spark, [(1, A, 1), (2, A, 1), (1, B, 1)]).write.partitionBy("indicator_uuid").saveAsTable("fact_table")
    tables.drop_indicators(spark, "fact_table", spark.createDataFrame([(A,), ("unknown",)], "internal_id string"))
    assert [r.indicator_uuid for r in spark.table("fact_table").collect()] == [B]
    spark.sql("drop table fact_table")


def test_nested_columns_become_json(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "k int, points array<double>")
    assert tuple(tables.nested_as_json(df).first()) == (1, "[1.0,2.0]")


def test_staged_tables_of_an_area_are_deleted(spark, tmp_path):
    from hexstats.sources.staging import stage, staging_area

    with staging_area(spark):
        inside = stage(spark.range(3))
        inside.write.parquet(str(tmp_path / "kept"))
        folder = inside.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert not os.path.exists(folder) and spark.read.parquet(str(tmp_path / "kept")).count() == 3
