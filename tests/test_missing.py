"""What is missing, formed tile by tile or only counted, against plain loops."""

from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from checks import fixture as fx
from checks import queries
from hexstats import schemas
from hexstats.functions import pairing
from hexstats.operators import candidates, correlation, lifecycle, pairs, report
from hexstats.sources.staging import stage
from tests.cells import IDS, axis_table, metadata

NAMES = [f"i{k}" for k in range(9)]


def _external(name):
    k = int(name[1:])
    return None if k == 8 else f"e{k // 2}"


@pytest.fixture(scope="module")
def tables(spark):
    """Nine versions, two of each logical indicator and one of none; some are base, one is unmarked, one gone."""
    meta = metadata(
        spark,
        *[
            {
                "internal_id": n, "external_id": _external(n), "is_base": None if n == "i5" else n in ("i1", "i4", "i8"),
                "state": "OUTDATED" if n == "i7" else "NEW" if n in ("i0", "i2") else "READY",
            }
            for n in NAMES
        ],
    )
    rows = [
        {"numerator_uuid": a, "denominator_uuid": b, "quality": 0.6 if (i + j) % 3 else 0.4}
        for i, a in enumerate(NAMES) for j, b in enumerate(("i1", "i4"))
    ]
    axis = axis_table(spark, *rows, rows[1], {"numerator_uuid": "unknown", "denominator_uuid": "i1", "quality": 0.9})
    ends = [(r["numerator_uuid"], r["denominator_uuid"]) for r in rows]
    known = [(0.1, 0.1, *x, *y) for k, (x, y) in enumerate(product(ends, ends)) if k % 4 == 1]
    return stage(meta), stage(axis), stage(spark.createDataFrame(known + known[:3], schemas.CORRELATION))


@pytest.mark.parametrize("tile", [1_000, 7, 1])
def test_marked_combinations_are_told(spark, monkeypatch, tile):
    monkeypatch.setattr(pairing, "TILE_ROWS", tile)
    left, right = spark.range(20).toDF("x"), spark.range(150).toDF("y")
    known = [(i, j, (i + j) % 2) for i in range(20) for j in range(150) if (i * j) % 5 < 3]
    marks = spark.createDataFrame(known + known[:9], "x long, y long, way int")
    plain = set(known)
    found = pairing.match_numbered(left, right, marks, ~pairing.is_known(0) & ~pairing.is_known(1), ways=2).collect()
    free = [(i, j) for i in range(20) for j in range(150) if not {(i, j, 0), (i, j, 1)} & plain]
    assert Counter(map(tuple, found)) == Counter(free)
    found = pairing.match_numbered(left, right, marks, pairing.is_known(1), ways=2, ascending=True).collect()
    assert sorted(map(tuple, found)) == sorted((i, j) for i, j, way in plain if way == 1 and i < j)


def test_tiles_are_dealt_to_a_fixed_number_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(pairing, "TILE_ROWS", 5)
    a, b = spark.range(20).toDF("a"), spark.range(15).toDF("b")
    found = pairing.match_rows(a, b, F.lit(True))
    assert found.rdd.getNumPartitions() == 24 and found.count() == 300


def test_missing_pairs_of_axes_are_not_shuffled(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = candidates.new_correlations(*tables)._jdf.queryExecution().executedPlan().toString()
        assert "x_numerator_id#" in plan and not [
            line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "x_num" in line and "y_num" in line
        ]
        plan = candidates.new_axes(*tables[:2])._jdf.queryExecution().executedPlan().toString()
        assert not [
            line for line in plan.splitlines() if "Exchange hashpartitioning(numerator_uuid" in line and "denominator_uuid" in line
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_correlations_against_plain_loops(spark, tables, monkeypatch):
    meta, axis, known = tables
    live = {r.internal_id: r for r in meta.collect() if r.state != "OUTDATED"}
    good = {(r.numerator_uuid, r.denominator_uuid) for r in axis.collect() if r.quality > 0.5}
    good = [a for a in good if a[0] in live and a[1] in live]
    there = {tuple(r[2:]) for r in known.select("correlation", "quality", *schemas.PAIR_KEYS).collect()}

    def apart(x, y):
        a, b = _external(x[0]), _external(y[0])
        return a is not None and b is not None and a != b

    wanted = {
        (*x, *y) for x, y in product(good, good)
        if live[x[0]].is_base is False and apart(x, y) and (*x, *y) not in there
    }
    assert wanted
    for tile in (1_000, 3):
        monkeypatch.setattr(pairing, "TILE_ROWS", tile)
        found = candidates.new_correlations(*tables)
        assert Counter(map(tuple, found.collect())) == Counter(wanted)
        pruned = candidates.new_correlations(*tables, pruned=True).collect()
        assert Counter(map(tuple, pruned)) == Counter(map(tuple, correlation.prune(found).collect()))
        dictionary = stage(pairs.rated_axes(meta, axis))
        numbers = {r.axis_id: (r.numerator_uuid, r.denominator_uuid) for r in dictionary.collect()}
        packed = pairs.missing_pairs(dictionary, known).collect()
        both = [frozenset((numbers[r.pair >> 32], numbers[r.pair & 0xFFFFFFFF])) for r in packed]
        assert Counter(both) == Counter({frozenset((p[:2], p[2:])) for p in wanted})


def test_counted_work_is_the_work(spark, tables):
    meta, axis, known = tables
    found = stage(candidates.new_correlations(*tables))
    counts = stage(candidates.count_new_correlations(*tables))
    for s in "xy":
        formed = found.groupBy(f"{s}_numerator_id", f"{s}_denominator_id").count().collect()
        counted = counts.filter(f"as_{s} > 0").select("numerator_uuid", "denominator_uuid", f"as_{s}").collect()
        assert set(map(tuple, formed)) == set(map(tuple, counted))
    whole = stage(lifecycle.unfinished_work(meta, axis, found, IDS))
    own = stage(lifecycle.unfinished_work(meta, axis, found.limit(0), IDS))
    counted = lifecycle.counted_work(own, counts)
    for of in (report.unfinished_by_kind, report.unfinished_by_indicator):
        assert set(map(tuple, of(counted).collect())) == set(map(tuple, of(whole).collect()))
    assert set(lifecycle.indicators_with_work(own, counts).collect()) == set(lifecycle.indicators_with_work(whole).collect())


def test_lacking_axes_are_those_of_the_missing_ones(spark, tables):
    meta, axis, _ = tables
    for there in (axis, axis.limit(0), axis.filter("numerator_uuid <> 'i2'")):
        added = candidates.new_axes(meta, there)
        lacking = candidates.lacking_axes(meta, there)
        assert set(map(tuple, lacking.collect())) == set(map(tuple, added.groupBy("numerator_uuid").count().collect()))
        new = candidates.new_indicators(meta, lacking)
        assert set(new.collect()) == set(candidates.new_indicators(meta, added).collect())


def test_named_pairs_are_not_exchanged_for_their_names(spark, tables, tmp_path):
    """Ten suppliers, one of them twice, rated well over one and each other: names come once for every row of an axis."""
    spark.range(10).union(spark.range(3, 4)).selectExpr(
        "cast(id as int) as s_suppkey", "cast(id as int) as s_nationkey", "9000.0D as s_acctbal"
    ).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(10).selectExpr("cast(id as int) as l_suppkey", "date'2020-01-01' as l_shipdate").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries.missing_pairs(spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange hashpartitioning(y#" not in plan
    registry, axis = queries._registry(spark, str(tmp_path)), queries._registry_axis(spark, str(tmp_path))
    dictionary = stage(pairs.rated_axes(registry, axis))
    known = fx.derive(spark, str(tmp_path), fx.REGISTRY_CORRELATION_SQL)
    copies = Counter(r.axis_id for r in dictionary.collect())
    names = {r.axis_id: (r.numerator_uuid, r.denominator_uuid) for r in dictionary.collect()}
    plain = Counter()
    for r in pairs.missing_pairs(dictionary, known).collect():
        x, y = r.pair >> 32, r.pair & 0xFFFFFFFF
        plain[(*max(names[x], names[y]), *min(names[x], names[y]))] += copies[x] * copies[y]
    assert plain and max(plain.values()) > 1
    assert Counter(tuple(r)[:4] for r in rows) == plain


@pytest.mark.parametrize("marked", [False, True])
def test_repeated_sides_are_never_broadcast(spark, marked):
    a, b = stage(spark.range(20).toDF("x")), stage(spark.range(15).toDF("y"))
    known = spark.createDataFrame([(1, 2, 0)], "x long, y long, way int")
    found = pairing.match_numbered(a, b, known, ~pairing.is_known()) if marked else pairing.match_rows(a, b, F.col("x") != F.col("y"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [_row" not in plan and "SortMergeJoin [_row" in plan


def test_right_rows_of_a_tile_come_as_one_list(spark, monkeypatch):
    monkeypatch.setattr(pairing, "TILE_ROWS", 8)
    left = stage(spark.createDataFrame([(0, "a"), (3, None), (3, None), (9, "b")], "x long, a string"))
    right = stage(spark.createDataFrame([(1, "p"), (2, None), (2, None), (10, "q")], "y long, b string"))
    known = spark.createDataFrame([(3, 2, 0), (9, 10, 0), (9, 10, 0)], "x long, y long, way int")
    found = pairing.match_numbered(left, right, known, ~pairing.is_known())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline(" in plan and found.columns == ["x", "a", "y", "b"]
    wanted = [
        (*x, *y) for x, y in product(map(tuple, left.collect()), map(tuple, right.collect()))
        if (x[0], y[0]) not in {(3, 2), (9, 10)}
    ]
    assert Counter(map(tuple, found.collect())) == Counter(wanted)


def test_texts_are_apart_by_their_hashes_or_themselves(spark):
    rows = spark.createDataFrame([("a", 1, "a", 1), ("a", 1, "b", 2), ("a", 1, "b", 1)], "x string, x_hash long, y string, y_hash long")
    assert [r[0] for r in rows.select(pairing.apart("x", "y")).collect()] == [False, True, True]
