"""The derived fact table."""

from pyspark.sql import functions as F

from checks import fixture as fx


def test_tasks_that_place_customers_grow_with_them(spark, tmp_path, monkeypatch):
    customers, each = 600, 20
    spark.range(1, customers + 1).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"), F.col("id").cast("double").alias("c_acctbal")
    ).write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.range(2 * customers).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % customers + 1).alias("o_custkey"), F.lit(2.0).alias("o_totalprice")
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.lit("A").alias("l_returnflag"), F.lit(3.0).alias("l_quantity")
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(fx, "_TASK_CUSTOMERS", each)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = fx.spread_customers(spark, str(tmp_path))
        facts = fx.derive(spark, str(tmp_path), fx.FACTS_SQL, customer=spread)
        found = facts.groupBy("indicator_uuid").agg(F.count("*"), F.round(F.sum("indicator_value"), 3))
        plan = facts._jdf.queryExecution().executedPlan().toString()
        # both sides of the join that multiplies rows are dealt by customer to that many tasks
        assert sum(f", {customers // each})" in line for line in plan.splitlines() if "hashpartitioning(" in line) >= 2
        own = fx.derive(spark, str(tmp_path), fx.FACTS_SQL).groupBy("indicator_uuid").agg(F.count("*"), F.round(F.sum("indicator_value"), 3))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, own.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
