from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException

from hexstats import schemas
from hexstats.operators import lifecycle
from hexstats.sources.staging import stage
from hexstats.streaming.uploads import _LAYOUT, Landing, land_uploads, watch_uploads
from tests.cells import A, B, facts, metadata


def test_each_upload_is_ingested_once(spark, tmp_path):
    path, checkpoint = str(tmp_path / "uploads"), str(tmp_path / "checkpoint")
    state = {
        "metadata": metadata(
            spark, *[{"internal_id": i, "upload_id": u, "state": schemas.COPY_IN_PROGRESS} for i, u in ((A, "u1"), (B, "u2"))]
        ),
        "rows": [],
    }

    def handle(staged, uploads):
        rows, after = lifecycle.ingest(staged, uploads, state["metadata"])
        state["rows"] += rows.collect()
        state["metadata"] = stage(after)

    def poll():
        watch_uploads(spark, path, checkpoint, handle).awaitTermination()
        return {r.internal_id: r.state for r in state["metadata"].collect()}

    facts(spark, [(1, A, 1), (1, A, 4), (2, A, 2)]).write.parquet(f"{path}/upload_id=u1")
    assert poll() == {A: "NEW", B: "COPY IN PROGRESS"}
    facts(spark, [(1, B, 3)]).write.parquet(f"{path}/upload_id=u2")
    assert poll() == {A: "NEW", B: "NEW"}
    assert sorted((r.h3, r.indicator_uuid, r.indicator_value) for r in state["rows"]) == [(1, A, 4.0), (1, B, 3.0), (2, A, 2.0)]


def test_a_handled_batch_is_not_handled_again(spark, tmp_path):
    path, ledger = str(tmp_path / "uploads"), str(tmp_path / "ledger")
    facts(spark, [(1, A, 1)]).write.parquet(f"{path}/upload_id=u1")
    seen = []

    def handle(staged, uploads):
        seen.append([r.upload_id for r in uploads.collect()])

    # a new checkpoint begins with the same batch again, as after a failure before its commit
    for k in range(2):
        watch_uploads(spark, path, str(tmp_path / f"checkpoint{k}"), handle, ledger=ledger).awaitTermination()
    assert seen == [["u1"]]
    watch_uploads(spark, path, str(tmp_path / "checkpoint2"), handle).awaitTermination()
    assert seen == [["u1"], ["u1"]]


def test_a_batch_that_was_cut_off_comes_again(spark, tmp_path):
    path, ledger = str(tmp_path / "uploads"), str(tmp_path / "ledger")
    facts(spark, [(1, A, 1)]).write.parquet(f"{path}/upload_id=u1")
    calls = []

    def handle(staged, uploads):
        calls.append(staged.count())
        if len(calls) == 1:
            raise RuntimeError("cut off")

    with pytest.raises(StreamingQueryException):
        watch_uploads(spark, path, str(tmp_path / "checkpoint"), handle, ledger=ledger).awaitTermination()
    watch_uploads(spark, path, str(tmp_path / "checkpoint"), handle, ledger=ledger).awaitTermination()
    assert calls == [1, 1]


def test_parts_of_an_upload_wait_for_each_other(spark, tmp_path):
    path, checkpoint = str(tmp_path / "uploads"), str(tmp_path / "checkpoint")
    landing = Landing(spark, str(tmp_path / "landing"))
    assert [t.count() for t in landing.complete()] == [0, 0]
    for k in range(3):  # three files, one batch each
        facts(spark, [(k, A, k), (9, A, k)]).coalesce(1).write.mode("append").parquet(f"{path}/upload_id=u1")
    land_uploads(spark, path, checkpoint, landing, files=1).awaitTermination()
    batches = {r.batch for r in landing.rows().select("batch").distinct().collect()}
    assert len(batches) == 3
    landing.take(_copy(spark, landing, min(batches)), min(batches))  # handed over again
    staged, uploads = landing.complete()
    assert staged.count() == 6 and [r.upload_id for r in uploads.collect()] == ["u1"]
    # files may still come
    assert landing.complete(before=datetime(2020, 1, 1))[1].count() == 0
    waiting = metadata(spark, {"internal_id": A, "upload_id": "u1", "state": schemas.COPY_IN_PROGRESS})
    rows, after = lifecycle.ingest(staged, uploads, waiting)
    assert sorted((r.h3, r.indicator_value) for r in rows.collect()) == [(0, 0.0), (1, 1.0), (2, 2.0), (9, 2.0)]
    assert after.first().state == "NEW"
    assert landing.clear(spark.createDataFrame([("u1",)], "upload_id string")) == 0
    assert landing.clear(spark.createDataFrame([], "upload_id string")) == 3 and landing.rows().count() == 0


def _copy(spark, landing, batch):
    """The rows of a batch as the stream would hand them over again."""
    return spark.createDataFrame(landing.rows().filter(f"batch = {batch}").drop("landed_at", "batch").collect(), _LAYOUT)
