from datetime import datetime, timedelta

import pytest

from hexstats import schemas
from hexstats.operators import lifecycle, overrides, report, system
from hexstats.sources import tables
from tests.cells import A, B, C, IDS, axis_table, cell, empty, facts, metadata

DAY = datetime(2024, 1, 1)
ONE, AREA = schemas.ONE_ID, schemas.AREA_ID
_UPLOAD = "upload_id string, h3 long, indicator_uuid string, indicator_value double"


def states(df):
    return {r.internal_id: r.state for r in df.collect()}


def test_discovery(spark):
    names = spark.createDataFrame([("tmp_stat_h3_u1",), ("tmp_stat_h3_other",), ("xtmp_stat_h3_u2",)], "table_name string")
    meta = metadata(spark, {"internal_id": A, "upload_id": "u1"}, {"internal_id": B, "upload_id": "u2"})
    assert [r.internal_id for r in lifecycle.discover_uploads(names, meta).collect()] == [A]


def test_ingest(spark):
    staged = spark.createDataFrame(
        [("u1", 1, A, 5.0), ("u1", 1, A, 7.0), ("u1", 2, A, None), ("u9", 1, C, 1.0)], _UPLOAD
    )
    uploads = spark.createDataFrame([("u1",), ("u2",), ("u9",)], "upload_id string")
    meta = metadata(
        spark,
        *[{"internal_id": i, "upload_id": u, "state": "COPY IN PROGRESS"} for i, u in ((A, "u1"), (B, "u2"), (C, "u3"))],
    )
    rows, after = lifecycle.ingest(staged, uploads, meta)
    assert {(r.h3, r.indicator_uuid, r.indicator_value) for r in rows.collect()} == {(1, A, 7.0), (2, A, None)}
    assert states(after) == {A: "NEW", B: "OUTDATED", C: "COPY IN PROGRESS"}


def test_ingest_leaves_out_an_upload_with_not_a_number(spark):
    staged = spark.createDataFrame([("u1", 1, A, float("nan")), ("u1", 2, A, 1.0), ("u2", 1, B, 2.0)], _UPLOAD)
    uploads = spark.createDataFrame([("u1",), ("u2",)], "upload_id string")
    meta = metadata(
        spark, *[{"internal_id": i, "upload_id": u, "state": "COPY IN PROGRESS"} for i, u in ((A, "u1"), (B, "u2"))]
    )
    rows, after = lifecycle.ingest(staged, uploads, meta)
    assert [tuple(r) for r in rows.collect()] == [(1, B, 2.0)]
    assert states(after) == {A: "COPY IN PROGRESS", B: "NEW"}


def test_an_upload_is_consumed_once(spark):
    staged = spark.createDataFrame([("u1", 1, A, 5.0)], _UPLOAD)
    uploads = spark.createDataFrame([("u1",)], "upload_id string")
    ready = metadata(spark, {"internal_id": A, "upload_id": "u1", "state": "READY"})
    rows, after = lifecycle.ingest(staged, uploads, ready)
    assert rows.count() == 0 and states(after) == {A: "READY"}


def test_previous_version_is_the_oldest_earlier_live_one(spark):
    rows = [("v0", -1, "OUTDATED"), ("v1", 0, "READY"), ("v2", 1, "READY"), ("v3", 2, "NEW"), ("v4", 3, "READY")]
    meta = metadata(
        spark,
        *[{"internal_id": i, "external_id": "e", "state": s, "date": DAY + timedelta(days=d)} for i, d, s in rows],
        {"internal_id": "lone", "external_id": "f", "state": "NEW", "date": DAY},
    )
    assert [tuple(r) for r in lifecycle.previous_versions(meta).collect()] == [("v3", "v1")]


def _drift(spark, new, old):
    versions = spark.createDataFrame([(B, A)], "internal_id string, previous_id string")
    rows = [(h, A, v) for h, v in old.items()] + [(h, B, v) for h, v in new.items()]
    return lifecycle.drift(facts(spark, rows), versions).first()


def test_drift(spark):
    old = {h: float(h) for h in range(1, 200)}
    same = _drift(spark, {h: v * 1.0005 for h, v in old.items()}, old)
    assert same.slope == pytest.approx(1.0005) and same.fill_ratio == 1.0 and same.discard
    shrunk = _drift(spark, {h: v for h, v in old.items() if h < 100}, old)
    assert shrunk.fill_ratio == pytest.approx(99 / 199) and not shrunk.discard
    changed = _drift(spark, {h: v * 2 for h, v in old.items()}, old)
    assert not changed.discard
    constant = _drift(spark, {1: 1.0, 2: 1.0}, {1: 3.0, 2: 3.0})
    assert constant.slope is None and not constant.discard
    # zeros of the previous version are left out of the regression but count as filled
    zeros = _drift(spark, {1: 9.0, 2: 2.0, 3: 3.0}, {1: 0.0, 2: 2.0, 3: 3.0})
    assert zeros.slope == pytest.approx(1.0) and zeros.fill_ratio == 1.0


def _axis(spark, *numerators):
    done = {"quality": 0.4, "sum_value": 1.0, "denominator_uuid": ONE}
    return axis_table(spark, *[{"numerator_uuid": n, **done} for n in numerators])


def _work(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.UNFINISHED)


def test_publish_and_publish_again(spark):
    meta = metadata(
        spark,
        {"internal_id": "old", "external_id": "e", "date": DAY},
        {"internal_id": "new", "external_id": "e", "state": "NEW", "date": DAY + timedelta(days=1)},
        {"internal_id": "busy", "external_id": "f", "state": "NEW"},
        {"internal_id": "axisless", "external_id": "g", "state": "NEW"},
    )
    work = _work(spark, ("quality", "busy", ONE, None, None), ("correlations", "new", ONE, "busy", ONE))
    axis = _axis(spark, "old", "new", "busy")
    once = lifecycle.publish(meta, axis, work)
    expected = {"old": "OUTDATED", "new": "READY", "busy": "NEW", "axisless": "NEW"}
    assert states(once) == expected
    assert {r.internal_id for r in lifecycle.changed_states(meta, once).collect()} == {"old", "new"}
    assert states(lifecycle.publish(once, axis, work)) == expected


def test_undated_version_counts_as_newest(spark):
    meta = metadata(
        spark, {"internal_id": "dated", "external_id": "e", "date": DAY}, {"internal_id": "undated", "external_id": "e"}
    )
    assert states(lifecycle.newest_ready_only(meta)) == {"dated": "OUTDATED", "undated": "READY"}


def test_unfinished_work(spark):
    meta = metadata(
        spark,
        {"internal_id": A, "state": "NEW"},
        {"internal_id": B, "state": "NEW", "max_res": 8},
        {"internal_id": C, "state": "OUTDATED"},
        {"internal_id": ONE},
    )
    axis = axis_table(
        spark,
        {"numerator_uuid": A, "denominator_uuid": ONE},
        {"numerator_uuid": B, "denominator_uuid": ONE, "quality": 0.1, "mean_all_res": 1.0},
        {"numerator_uuid": C, "denominator_uuid": ONE},
        {"numerator_uuid": ONE, "denominator_uuid": B},
    )
    pairs = spark.createDataFrame([(A, ONE, B, ONE)], ", ".join(f"{k} string" for k in schemas.PAIR_KEYS))
    work = lifecycle.unfinished_work(meta, axis, pairs, IDS)
    assert {(r.kind, r.x_num) for r in work.collect()} == {
        ("quality", A), ("analytics", A), ("transformations", A), ("max_resolution", A), ("correlations", A)
    }
    assert {r.indicator_uuid for r in lifecycle.indicators_with_work(work).collect()} == {A, B, ONE}
    assert {r.indicator_uuid for r in lifecycle.indicators_with_important_work(work).collect()} == {A}
    kinds = [tuple(r) for r in report.unfinished_by_kind(work).collect()]
    assert len(kinds) == 5 and all(n == 1 for _, n in kinds)


def test_purge_leaves_no_orphans(spark):
    meta = metadata(
        spark,
        {"internal_id": A, "external_id": "a", "state": "OUTDATED"},
        {"internal_id": B, "external_id": "b"},
        {"internal_id": C, "external_id": "c"},
    )
    axis = axis_table(spark, *[{"numerator_uuid": n, "denominator_uuid": d} for n, d in ((A, B), (B, A), (B, C))])
    correlation = spark.createDataFrame(
        [(0.1, 0.1, *k) for k in ((A, B, C, B), (B, A, C, B), (C, B, A, B), (C, B, B, A), (B, C, C, B))], schemas.CORRELATION
    )
    ovr = spark.createDataFrame(
        [{"numerator_id": n, "denominator_id": d} for n, d in (("a", "b"), ("b", "a"), ("b", "c"), ("x", "c"))],
        schemas.OVERRIDES,
    )
    data = facts(spark, [(1, A, 1), (1, B, 1)])
    facts_, meta_, axis_, corr_, ovr_ = lifecycle.purge(data, meta, axis, correlation, ovr)
    assert [r.indicator_uuid for r in facts_.collect()] == [B]
    assert set(states(meta_)) == {B, C}
    assert [(r.numerator_uuid, r.denominator_uuid) for r in axis_.collect()] == [(B, C)]
    assert [tuple(r[k] for k in schemas.PAIR_KEYS) for r in corr_.collect()] == [(B, C, C, B)]
    assert [(r.numerator_id, r.denominator_id) for r in ovr_.collect()] == [("b", "c")]
    orphans = overrides.orphaned(ovr, meta_).collect()
    assert {(r.numerator_id, r.denominator_id) for r in orphans} == {("a", "b"), ("b", "a"), ("x", "c")}


def test_failed_uploads(spark):
    now = DAY
    rows = [("old", 120), ("running", 120), ("fresh", 30)]
    meta = metadata(
        spark,
        *[{"internal_id": i, "state": "COPY IN PROGRESS", "date": now - timedelta(seconds=s)} for i, s in rows],
        {"internal_id": "ready", "date": now - timedelta(days=9)},
    )
    running = spark.createDataFrame([("running",)], "internal_id string")
    assert set(states(lifecycle.failed_uploads(meta, now))) == {"old", "running"}
    assert set(states(lifecycle.remove_failed_uploads(meta, now, running))) == {"running", "fresh", "ready"}


def test_overrides_keep_what_they_do_not_set(spark):
    meta = metadata(
        spark,
        {"internal_id": A, "external_id": "a"}, {"internal_id": B, "external_id": "a"}, {"internal_id": C, "external_id": "c"},
    )
    axis = axis_table(
        spark, *[{"numerator_uuid": n, "denominator_uuid": C, "min": 1.0, "max": 2.0, "label": "old"} for n in (A, B)],
        {"numerator_uuid": C, "denominator_uuid": C, "min": 1.0},
    )
    ovr = spark.createDataFrame([{"numerator_id": "a", "denominator_id": "c", "min": 9.0, "label": "new"}], schemas.OVERRIDES)
    found = {r.numerator_uuid: (r.min, r.max, r.label) for r in overrides.apply_overrides(axis, ovr, meta).collect()}
    # every version of the logical indicator gets them
    assert found == {A: (9.0, 2.0, "new"), B: (9.0, 2.0, "new"), C: (1.0, None, None)}


def test_inactive_ids(spark):
    meta = metadata(
        spark, {"internal_id": A}, {"internal_id": B, "state": "TMP CREATED"}, {"internal_id": C, "state": "COPY IN PROGRESS"}
    )
    ids = spark.createDataFrame([(A,), (B,), (C,), ("unknown",), (None,)], "x string")
    assert {r.x for r in tables.inactive_ids(ids, meta, "x").collect()} == {C, "unknown"}
    assert set(states(tables.active(meta))) == {A}


def test_system_fill(spark):
    fine, coarse, known = cell(9, 1), cell(8, 2), cell(8, 3)
    data = facts(spark, [(fine, A, 1), (coarse, A, 1), (known, A, 1), (known, ONE, 1), (coarse, AREA, 5)])
    missing = system.missing_cells(data, IDS)
    assert [(r.h3, r.has_area) for r in missing.collect()] == [(coarse, True)]
    boundary = spark.createDataFrame([(coarse, None, 3.0)], schemas.CELL_BOUNDARY)
    rows = system.system_rows(missing, boundary, IDS).collect()
    assert [tuple(r) for r in rows] == [(coarse, ONE, 1.0)]
    bare = system.missing_cells(facts(spark, [(coarse, A, 1)]), IDS)
    assert {tuple(r) for r in system.system_rows(bare, boundary, IDS).collect()} == {(coarse, ONE, 1.0), (coarse, AREA, 3.0)}
    other = spark.createDataFrame([(B,)], "indicator_uuid string")
    assert system.missing_cells(data, IDS, other).count() == 0


def test_system_metadata_is_added_once(spark):
    meta, added = system.add_system_metadata(empty(spark, schemas.METADATA), "me", IDS)
    assert {r.internal_id for r in added.collect()} == {ONE, AREA}
    assert tables.system_ids(meta, "me") == schemas.SystemIds(ONE, AREA, None)
    again, more = system.add_system_metadata(meta, "me", IDS)
    assert more.count() == 0 and again.count() == 2


def test_newest_published_population_is_used(spark):
    def pop(i, state, date):
        return {"internal_id": i, "param_id": "population", "state": state, "date": date}

    meta = metadata(
        spark, pop("p1", "READY", DAY), pop("p2", "READY", DAY + timedelta(days=1)), pop("p3", "NEW", DAY + timedelta(days=2))
    )
    assert tables.system_ids(meta, "me").population == "p2"


def test_upsert_and_insert_absent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = tables.upsert(old, new, ["k"])
    for table in (once, tables.upsert(once, new, ["k"])):
        assert sorted(map(tuple, table.collect())) == [(1, "a"), (2, "B"), (3, "C")]
    table, added = tables.insert_absent(old, new, ["k"])
    assert sorted(map(tuple, table.collect())) == [(1, "a"), (2, "b"), (3, "C")]
    assert [tuple(r) for r in added.collect()] == [(3, "C")]
