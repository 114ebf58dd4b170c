"""Tables kept in a folder: only what a change touches is written, and every change is counted."""

import glob
import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hexstats import schemas
from hexstats.plans import refresh, stored_round
from hexstats.sources import stored, tables
from tests.cells import A, B, C, axis_table, cell, empty, facts, metadata
from tests.test_coverage import hexagon
from tests.test_rounds import HERE, NOW, THERE

LAYOUT = T.StructType(
    [T.StructField(n, T.StringType()) for n in "ab"] + [T.StructField("x", T.DoubleType()), T.StructField("y", T.ArrayType(T.IntegerType()))]
)


def files(path):
    found = glob.glob(f"{path}/**/*.parquet", recursive=True)
    return {f.removeprefix(str(path)): os.stat(f).st_mtime_ns for f in found}


def rows(spark, *values):
    return spark.createDataFrame(list(values), "a string, b string, x double")


@pytest.fixture
def table(spark, tmp_path):
    made = stored.KeyedTable(spark, str(tmp_path / "t"), LAYOUT, ("a", "b"), 16)
    done = made.merge(spark.createDataFrame([(f"k{i}", "z", float(i), [i]) for i in range(100)], LAYOUT))
    assert (done.added, done.altered, len(done.parts)) == (100, 0, 16)
    return made


def test_only_touched_parts_are_written(spark, table):
    before = files(table.path)
    done = table.merge(rows(spark, ("k3", "z", 3.0), ("k5", "z", 7.5), ("new", "z", 1.0)))
    after = files(table.path)
    # k3 does not differ, so its part stays
    assert (done.added, done.altered) == (1, 1) and len(done.parts) <= 2
    changed = {f for f in before if after.get(f) != before[f]}
    assert {f.split("/")[1] for f in changed} <= {f"part={p}" for p in done.parts}
    found = {r.a: r for r in table.read().collect()}
    assert len(found) == 101 and found["k5"].x == 7.5 and found["k5"].y == [5] and found["new"].y is None


def test_repeated_changes_write_nothing(spark, table):
    change = rows(spark, ("k5", "z", None), ("new", "z", 1.0))
    assert table.merge(change).parts
    before = files(table.path)
    assert table.merge(change) == stored.Change() and files(table.path) == before
    assert table.merge(rows(spark)) == stored.Change() and files(table.path) == before


def test_merge_can_leave_known_or_new_rows_alone(spark, table):
    change = rows(spark, ("k5", "z", -1.0), ("new", "z", 1.0))
    assert table.merge(change, add=False).altered == 1
    assert table.merge(rows(spark, ("k6", "z", -1.0), ("new", "z", 1.0)), alter=False).added == 1
    found = {r.a: r.x for r in table.read().collect()}
    assert (found["k5"], found["k6"], found["new"]) == (-1.0, 6.0, 1.0)


def test_deleted_rows_come_back(spark, table):
    before = files(table.path)
    done, removed = table.delete(rows(spark, ("k7", "z", 0.0), ("k7", "z", 1.0), ("unknown", "z", 0.0)))
    assert (done.removed, len(done.parts)) == (1, 1) and [r.y for r in removed.collect()] == [[7]]
    assert {f.split("/")[1] for f in before if f not in files(table.path)} == {f"part={done.parts[0]}"}
    done, removed = table.delete(table.read())
    assert done.removed == removed.count() == 99 and table.read().count() == 0 and not files(table.path)
    assert table.delete(rows(spark))[0] == stored.Change()


def test_keys_of_two_columns_do_not_mix(spark, tmp_path):
    made = stored.KeyedTable(spark, str(tmp_path / "t"), LAYOUT, ("a", "b"), 2)
    made.merge(rows(spark, ("x", "y", 1.0), ("xy", "", 2.0)))
    assert made.merge(rows(spark, ("x", "y", 3.0))).altered == 1
    assert sorted((r.a, r.x) for r in made.read().collect()) == [("x", 3.0), ("xy", 2.0)]


# --- rounds -------------------------------------------------------------------------------------


EXTRA = [cell(8, 6, 6, k, base=20) for k in range(3)]
# cells with their parents, so that axes are rated, and cells at the resolution of reported values
COARSE = [cell(4, 1, 1, 1, k) for k in range(5)]
OWN = COARSE + [cell(5, 1, 1, 1, k, j) for k in range(5) for j in range(7)] + HERE


def upload(spark, name, indicator, cells, step=3):
    staged = [(name, h, indicator, 20.0 + k * step % 7) for k, h in enumerate(cells)]
    return (
        spark.createDataFrame(staged, "upload_id string, h3 long, indicator_uuid string, indicator_value double"),
        spark.createDataFrame([(name,)], "upload_id string"),
    )


@pytest.fixture(scope="module")
def base(spark):
    rows = [(h, B, 9.0 + k * 5 % 11) for k, h in enumerate(THERE + OWN)]
    boundary = [(h, hexagon(k, j), None) for j, cells in enumerate((OWN, THERE, EXTRA)) for k, h in enumerate(cells)]
    versions = metadata(
        spark,
        {"internal_id": A, "external_id": "a", "param_id": "a", "state": "COPY IN PROGRESS", "upload_id": "u1", "date": NOW},
        {"internal_id": "old", "external_id": "a", "param_id": "a", "date": NOW - timedelta(days=9)},
        {"internal_id": B, "external_id": "b", "param_id": "b", "is_base": True, "date": NOW},
        {"internal_id": C, "external_id": "c", "param_id": "c", "state": "COPY IN PROGRESS", "upload_id": "u2", "date": NOW},
    )
    overrides = [("a", "b", None, None, None, None, "label", None, None, None, None), ("gone", "b", *[None] * 9)]
    return refresh.Base(
        facts=facts(spark, [*rows, (THERE[0], "old", 1.0)]), metadata=versions, axis=axis_table(spark),
        correlation=empty(spark, schemas.CORRELATION), overrides=spark.createDataFrame(overrides, schemas.OVERRIDES),
        cell_boundary=spark.createDataFrame(boundary, schemas.CELL_BOUNDARY),
        cell_geometry=empty(spark, schemas.CELL_GEOMETRY), completed=refresh.no_completed(spark),
    )


@pytest.fixture(scope="module")
def store(spark, base, tmp_path_factory):
    made = stored_round.Store(spark, str(tmp_path_factory.mktemp("store")), base.cell_boundary, parts=16)
    made.load(base)
    return made


@pytest.fixture(scope="module")
def first(spark, store):
    return stored_round.run(store, *upload(spark, "u1", A, OWN), "me", NOW, running=spark.createDataFrame([(C,)], "internal_id string"))


def plain(table, *, digits=9):
    """Rows as text, with doubles rounded."""
    def value(v):
        if isinstance(v, float):
            return round(v, digits)
        return tuple(value(x) for x in v) if isinstance(v, (list, tuple)) else v

    return sorted(str(value(tuple(r))) for r in table.select(*sorted(table.columns)).collect())


def test_a_stored_round_equals_one_in_memory(spark, base, store, first):
    staged, uploads = upload(spark, "u1", A, OWN)
    running = spark.createDataFrame([(C,)], "internal_id string")
    done = refresh.ingest(base, staged, uploads)
    done = refresh.fill_system(done, "me", tables.system_ids(done.metadata, "me"))
    done = refresh.measure_axes(done, "me")
    done = refresh.correlate(done, "me")
    done = refresh.draw_cells(refresh.publish(done, "me"), NOW)
    done = refresh.purge(done, NOW, running)
    kept = store.base()
    for name in ("facts", "metadata", "axis", "correlation", "overrides", "cell_geometry", "completed"):
        assert plain(getattr(kept, name)) == plain(getattr(done, name)), name
    assert kept.axis.count() > 0 and kept.correlation.count() > 0 and kept.cell_geometry.count() > 0


def test_counts_of_the_first_round(first, store):
    assert first["ingested rows"] == len(OWN) and first["ingested versions"] == 1
    assert first["system indicators"] == 2 and first["system rows"] == 2 * len(OWN)
    for name, table in (("axis", store.axis), ("correlation", store.correlation)):
        added = first["axes added" if name == "axis" else "correlations added"]
        assert added == table.read().count() + first[f"purged {name}"]
    assert first["states changed"] == 4  # A, one and area_km2 are published, the older version of A is outdated
    assert first["cells drawn"] == len(OWN) + len(THERE)
    assert (first["purged metadata"], first["purged facts"], first["purged overrides"]) == (1, 1, 1)


def test_a_round_without_news_writes_nothing(spark, store, first):
    before = files(store.root)
    # the same upload again: its version is no longer in progress
    again = stored_round.run(store, *upload(spark, "u1", A, OWN), "me", NOW, running=spark.createDataFrame([(C,)], "internal_id string"))
    assert set(again.values()) == {0} and files(store.root) == before


def test_an_upload_writes_its_own_rows_only(spark, store, first):
    before = files(store.root)
    counts = stored_round.run(store, *upload(spark, "u2", C, OWN + EXTRA, step=2), "me", NOW)
    after = files(store.root)
    assert counts["ingested rows"] == len(OWN) + 3
    facts_changed = {f.split("/")[2] for f in set(before) | set(after) if "/facts/" in f and before.get(f) != after.get(f)}
    # the folder of its indicator, and files appended to the system indicators
    assert f"indicator_uuid={C}" in facts_changed and facts_changed <= {f"indicator_uuid={i}" for i in (C, schemas.ONE_ID, schemas.AREA_ID)}
    assert all(after.get(f) == at for f, at in before.items() if "/facts/" in f)
    touched = {f.split("/")[2] for f in set(before) | set(after) if f.startswith("/correlation/") and before.get(f) != after.get(f)}
    new = store.correlation.read().filter((F.col("x_numerator_id") == C) | (F.col("y_numerator_id") == C))
    assert touched == {f"part={r[0]}" for r in new.select(store.correlation._part()).distinct().collect()}
    assert counts["correlations added"] == new.count() > 0 and counts["correlations altered"] == 0
    states = {r.internal_id: r.state for r in store.metadata.read().collect()}
    assert states[C] == "READY"


def test_an_interrupted_ingest_is_repeated(spark, base, tmp_path):
    store = stored_round.Store(spark, str(tmp_path), base.cell_boundary, parts=4)
    store.load(base)
    staged, uploads = upload(spark, "u1", A, OWN)
    # the rows were written, the state was not
    tables.write_facts(staged.select(*schemas.FACTS.names), store.facts_path, "replace")
    assert stored_round.ingest(store, staged, uploads) == {"ingested rows": len(OWN), "ingested versions": 1}
    assert store.facts().filter(F.col("indicator_uuid") == A).count() == len(OWN)
    assert stored_round.ingest(store, staged, uploads) == {"ingested rows": 0, "ingested versions": 0}


def test_purged_rows_are_handed_back(spark, base, tmp_path):
    store = stored_round.Store(spark, str(tmp_path), base.cell_boundary, parts=4)
    store.load(base)
    dead = base.metadata.filter(F.col("internal_id") == "old").withColumn("state", F.lit("OUTDATED"))
    store.metadata.merge(dead, ["state"])
    store.axis.merge(spark.createDataFrame([("old", B), (B, "old"), (A, B)], "numerator_uuid string, denominator_uuid string"))
    counts, removed = stored_round.purge(store, NOW + timedelta(days=1))
    assert counts == {"correlation": 0, "axis": 2, "completed": 0, "overrides": 1, "metadata": 3, "facts": 1}
    assert {(r.numerator_uuid, r.denominator_uuid) for r in removed["axis"].collect()} == {("old", B), (B, "old")}
    assert [r.numerator_id for r in removed["overrides"].collect()] == ["gone"]
    assert store.facts().filter("indicator_uuid = 'old'").count() == 0
