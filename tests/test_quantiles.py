import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexstats.operators import quantiles


def _values(kind, n, seed):
    rng = random.Random(seed)
    if kind == "skewed":
        return [rng.lognormvariate(0, 4) * rng.choice((-1, 1)) for _ in range(n)]
    if kind == "narrow":
        return [1e6 + rng.random() * 1e-6 for _ in range(n)]
    if kind == "ties":
        return [rng.choice((-3.0, 0.0, 0.0, 0.0, 7.5)) for _ in range(n)]
    if kind == "nested":  # rounding noise, and an outlier at every scale around it
        return [1 + rng.randrange(200) * 2.0**-52 for _ in range(n - 45)] + [1 + 2.0**-j for j in range(5, 50)]
    if kind == "single":
        return [42.0]
    return [rng.gauss(0, 1) for _ in range(n)]


@pytest.mark.parametrize("sortable", [1_000_000, 1])
def test_exact_for_any_distribution(spark, sortable):
    groups = {k: _values(k, 2_003, i) for i, k in enumerate(("skewed", "narrow", "ties", "single", "normal", "nested"))}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double")
    continuous, discrete = (0.0, 0.33, 0.5, 0.66, 1.0), tuple(i / 100 for i in range(101))

    def ranks(n):
        return F.concat(quantiles.continuous_ranks(continuous)(n), quantiles.discrete_ranks(discrete)(n))

    found = quantiles.order_statistics(df, ["k"], "v", ranks, sortable_rows=sortable).select(
        "k", "n",
        F.array(*[quantiles.continuous(F.col("n"), F.col("by_rank"), p) for p in continuous]).alias("cont"),
        quantiles.discrete(F.col("n"), F.col("by_rank"), discrete).alias("disc"),
    )
    rows = {r.k: r for r in found.collect()}
    assert set(rows) == set(groups)
    for k, values in groups.items():
        ordered = np.sort(values)
        n = len(ordered)
        assert rows[k].n == n
        assert rows[k].cont == pytest.approx(np.quantile(ordered, continuous), rel=1e-12)
        wanted = [ordered[max(1, int(np.ceil(p * n))) - 1] for p in discrete]
        assert rows[k].disc == wanted


def test_agrees_with_builtin_percentiles(spark):
    df = spark.createDataFrame([(v,) for v in _values("skewed", 5_000, 9)], "v double").withColumn("k", F.lit(1))
    found = quantiles.order_statistics(df, ["k"], "v", quantiles.continuous_ranks((0.33, 0.66)))
    row = found.select(
        *[quantiles.continuous(F.col("n"), F.col("by_rank"), p).alias(str(p)) for p in (0.33, 0.66)]
    ).first()
    built_in = df.selectExpr("percentile_cont(0.33) within group (order by v)",
                             "percentile_cont(0.66) within group (order by v)").first()
    assert tuple(row) == pytest.approx(tuple(built_in), rel=1e-12)


def test_discrete_percentile_rounds_up(spark):
    df = spark.range(1, 101).selectExpr("1 as k", "cast(id as double) as v")
    found = quantiles.order_statistics(df, ["k"], "v", quantiles.discrete_ranks((0.07,)))
    assert found.select(quantiles.discrete(F.col("n"), F.col("by_rank"), (0.07,))).first()[0] == [8.0]


def test_slots_never_decrease(spark):
    values = sorted(_values("skewed", 3_000, 4) + [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf")])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    slots = [r[0] for r in df.orderBy("i").select(quantiles.log_slot(F.col("v"))).collect()]
    assert slots == sorted(slots)


@pytest.mark.parametrize("sortable", [10, 1_000_000])
def test_rows_count_for_their_group_and_the_total(spark, sortable):
    rng = np.random.default_rng(5)
    rows = [(int(g), int(r), float(round(v, 2))) for g, r, v in zip(rng.integers(0, 3, 3000), rng.integers(0, 4, 3000), rng.normal(0, 3, 3000), strict=True)]
    values = spark.createDataFrame([*rows, (0, None, 50.0)], "g int, r int, v double")
    both = values.withColumn("r", F.explode(F.array("r", F.lit(-1))))
    counts = quantiles.histogram(both, ["g", "r"], "v")
    ranks = quantiles.continuous_ranks((0.33, 0.5, 0.66))
    twice, once = (
        quantiles.order_statistics(rows, ["g", "r"], "v", ranks, counts=counts, sortable_rows=sortable, **rule)
        for rows, rule in ((both, {}), (values, {"total_of": ("r", -1)}))
    )
    expected = {(x.g, x.r): (x.n, x.by_rank) for x in twice.collect()}
    assert {(x.g, x.r): (x.n, x.by_rank) for x in once.collect()} == expected and len(expected) == 16
