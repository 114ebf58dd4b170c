from collections import Counter

import pytest
from pyspark.sql import functions as F

from hexstats.functions import pairing
from hexstats.sources.staging import stage


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_attach_is_an_inner_join_that_respects_the_threshold(spark, threshold):
    # two thirds of the rows share one key
    rows = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id") % 7).cast("int").alias("k"), "id")
    small = stage(spark.createDataFrame([(0, "a"), (0, "b"), (3, "c")], "k int, v string"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = pairing.attach(rows, small, ["k"])
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
        assert sorted(map(tuple, found.select("k", "v", "id").collect())) == sorted(
            (k, v, i)
            for i in range(300)
            for k in [0 if i < 200 else i % 7]
            for key, v in ((0, "a"), (0, "b"), (3, "c"))
            if k == key
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("tile", [1_000, 7, 1])
def test_match_rows_meets_every_pair_once(spark, monkeypatch, tile):
    monkeypatch.setattr(pairing, "TILE_ROWS", tile)
    a, b = spark.range(20).toDF("a"), spark.range(15).toDF("b")
    found = pairing.match_rows(a, b, F.col("a") != F.col("b")).collect()
    assert Counter(map(tuple, found)) == Counter((i, j) for i in range(20) for j in range(15) if i != j)
