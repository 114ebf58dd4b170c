"""From upload to removal of an indicator version."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators.axis_values import AXIS_KEYS, listed, without_system_numerators
from hexstats.operators.overrides import without_orphans
from hexstats.operators.transform import MIN_QUALITY
from hexstats.schemas import PAIR_KEYS, SystemIds
from hexstats.sources.tables import active

# Fixed value: prefix of the table names uploads arrive under.
UPLOAD_PREFIX = "tmp_stat_h3_"
# A new version within these bounds of the previous one brings nothing new.
SAME_SLOPE = (0.999, 1.001)
SAME_INTERCEPT = (-0.01, 0.01)
SAME_FILL = (0.99, 1.01)


def set_state(metadata: DataFrame, states: DataFrame) -> DataFrame:
    """``states`` holds (internal_id, new_state) for the versions that change."""
    return (
        metadata.join(states.select("internal_id", "new_state"), "internal_id", "left")
        .withColumn("state", F.coalesce(F.col("new_state"), F.col("state")))
        .select(*metadata.columns)
    )


# --- upload ---------------------------------------------------------------------------------


def discover_uploads(table_names: DataFrame, metadata: DataFrame) -> DataFrame:
    """Uploaded tables that belong to a known indicator: (internal_id, upload_id)."""
    uploads = table_names.filter(F.col("table_name").startswith(UPLOAD_PREFIX)).select(
        F.regexp_replace("table_name", f"^{UPLOAD_PREFIX}", "").alias("upload_id")
    )
    return metadata.join(uploads, "upload_id", "left_semi").select("internal_id", "upload_id")


def dedup_upload(staged: DataFrame) -> DataFrame:
    """One row per upload and cell; of duplicates the largest value survives.

    An upload holds a single indicator, so the cell alone identifies a row. The maximum is
    combined before the shuffle; no cell's rows are sorted.
    """
    kept = F.max(F.struct("indicator_value", "indicator_uuid")).alias("kept")
    return (
        staged.groupBy("upload_id", "h3")
        .agg(kept)
        .select(
            "upload_id", "h3", F.col("kept.indicator_uuid").alias("indicator_uuid"),
            F.col("kept.indicator_value").alias("indicator_value"),
        )
    )


def acceptable_uploads(staged: DataFrame, uploads: DataFrame, metadata: DataFrame) -> DataFrame:
    """(internal_id, upload_id) of the uploads to move now.

    Only versions whose copy is in progress wait for one, so an upload is consumed once. An upload with
    a value that is not a number, or infinite, is left alone: it would count as the largest value of every
    statistic, or turn its means and deviations into no number; its version stays in progress and is
    removed as a failed upload.
    """
    waiting = metadata.filter(F.col("state") == schemas.COPY_IN_PROGRESS)
    value = F.col("indicator_value")
    spoiled = staged.filter(F.isnan(value) | (F.abs(value) == float("inf"))).select("upload_id").distinct()
    return discovered_versions(uploads, waiting).join(spoiled, "upload_id", "left_anti")


def ingest(staged: DataFrame, uploads: DataFrame, metadata: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New fact rows of the discovered uploads, and the metadata with the states after it.

    ``uploads`` are the uploads whose data was found. A version becomes NEW when its upload has
    rows and OUTDATED when it is empty; versions without acceptable data are left alone.
    """
    taken = acceptable_uploads(staged, uploads, metadata)
    rows = dedup_upload(staged.join(taken.select("upload_id").distinct(), "upload_id", "left_semi"))
    filled = staged.select("upload_id").distinct().withColumn("filled", F.lit(True))
    states = taken.join(filled, "upload_id", "left").select(
        "internal_id",
        F.when(F.col("filled"), F.lit(schemas.NEW)).otherwise(F.lit(schemas.OUTDATED)).alias("new_state"),
    )
    return rows.drop("upload_id"), set_state(metadata, states)


def discovered_versions(uploads: DataFrame, metadata: DataFrame) -> DataFrame:
    return metadata.select("internal_id", "upload_id").join(
        uploads.select("upload_id").distinct(), "upload_id", "left_semi"
    )


# --- comparison with the previous version ---------------------------------------------------


def previous_versions(metadata: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """For each new version the oldest earlier live one: (internal_id, previous_id).

    ``new`` (internal_id) selects the versions to check; by default all in state NEW.
    """
    if new is None:
        new = metadata.filter(F.col("state") == schemas.NEW).select("internal_id")
    checked = metadata.join(new, "internal_id", "left_semi").select(
        "internal_id", "external_id", F.col("date").alias("upload_date")
    )
    # the oldest live version of all is the one sought, if it is older than the new one
    oldest = (
        active(metadata)
        .filter(F.col("date").isNotNull())
        .groupBy("external_id")
        .agg(F.min(F.struct("date", F.col("internal_id").alias("id"))).alias("oldest"))
    )
    return (
        checked.join(oldest, "external_id")
        .filter(F.col("oldest.date") < F.col("upload_date"))
        .select("internal_id", F.col("oldest.id").alias("previous_id"))
    )


def drift(facts: DataFrame, versions: DataFrame) -> DataFrame:
    """Regression of each new version on its previous one over all cells, and their fill ratio.

    ``discard`` marks versions that repeat the previous one.
    """
    new = listed(versions, "internal_id")
    old = versions.select("internal_id", F.col("previous_id").alias("indicator_uuid"))
    a = facts.join(new, "indicator_uuid", "left_semi").select(
        F.col("indicator_uuid").alias("internal_id"), "h3", F.col("indicator_value").alias("a")
    )
    b = (
        facts.join(listed(versions, "previous_id"), "indicator_uuid", "left_semi")
        .join(old, "indicator_uuid")
        .select("internal_id", "h3", F.col("indicator_value").alias("b"))
    )
    nonzero = F.nullif(F.col("b"), F.lit(0.0))
    compared = (
        a.join(b, ["internal_id", "h3"], "full")
        .groupBy("internal_id")
        .agg(
            F.regr_slope("a", nonzero).alias("slope"),
            F.regr_intercept("a", nonzero).alias("intercept"),
            F.try_divide(F.count("a").cast("double"), F.count("b").cast("double")).alias("fill_ratio"),
        )
    )
    same = (
        F.col("slope").between(*SAME_SLOPE)
        & F.col("intercept").between(*SAME_INTERCEPT)
        & F.col("fill_ratio").between(*SAME_FILL)
    )
    return versions.join(compared, "internal_id", "left").withColumn(
        "discard", F.coalesce(same, F.lit(False))
    )


def discard_unchanged(metadata: DataFrame, drifts: DataFrame) -> DataFrame:
    return set_state(
        metadata,
        drifts.filter("discard").select("internal_id", F.lit(schemas.OUTDATED).alias("new_state")),
    )


# --- publication ----------------------------------------------------------------------------


COMPLETED_KEYS = ["kind", *AXIS_KEYS]


def completion(kind: str, axes: DataFrame, minimum: Column | None = None) -> DataFrame:
    """Records that work of a kind has run for these axes, whatever it found, and with which minimum."""
    least = F.lit(None) if minimum is None else minimum
    return axes.select(F.lit(kind).alias("kind"), *AXIS_KEYS, least.cast("double").alias("minimum"))


def without_resolution(metadata: DataFrame, axis: DataFrame, ids: SystemIds) -> DataFrame:
    """Live indicators, numerators of some axis, whose finest resolution is not known: (internal_id)."""
    return (
        active(metadata)
        .filter(F.col("max_res").isNull() & ~F.col("internal_id").isin(*ids.constants))
        .join(axis.select(F.col("numerator_uuid").alias("internal_id")), "internal_id", "left_semi")
        .select("internal_id")
    )


def unfinished_work(
    metadata: DataFrame,
    axis: DataFrame,
    correlation_candidates: DataFrame,
    ids: SystemIds,
    completed: DataFrame | None = None,
) -> DataFrame:
    """Open work: result columns that are still empty, unless ``completed`` (kind, axis) says that the
    work has run and found nothing, as for an axis whose two indicators share no cell."""
    nothing = F.lit(None).cast("string")
    live = active(metadata).select("internal_id")
    open_axes = without_system_numerators(axis, ids)
    for key in AXIS_KEYS:
        open_axes = open_axes.join(live.toDF(key), key, "left_semi")
    measured = [f"{s}_{part}" for s in schemas.STATISTICS for part in ("value", "quality")]
    no_analytics = F.coalesce(*[F.col(c) for c in (*measured, "mean_all_res", "stddev_all_res")]).isNull()
    no_transforms = F.col("transformations").isNull() & (
        F.coalesce(F.col("quality"), F.lit(1.0)) >= MIN_QUALITY
    )
    kinds = F.array(
        F.when(F.col("quality").isNull(), F.lit("quality")),
        F.when(no_analytics, F.lit("analytics")),
        F.when(no_transforms, F.lit("transformations")),
    )
    per_axis = open_axes.select(
        F.explode(F.array_compact(kinds)).alias("kind"),
        F.col("numerator_uuid").alias("x_num"),
        F.col("denominator_uuid").alias("x_den"),
        nothing.alias("y_num"),
        nothing.alias("y_den"),
    )
    if completed is not None:
        done = completed.select("kind", F.col(AXIS_KEYS[0]).alias("x_num"), F.col(AXIS_KEYS[1]).alias("x_den"))
        per_axis = per_axis.join(done.distinct(), ["kind", "x_num", "x_den"], "left_anti").select(
            "kind", "x_num", "x_den", "y_num", "y_den"
        )
    per_indicator = without_resolution(metadata, axis, ids).select(
        F.lit("max_resolution").alias("kind"), F.col("internal_id").alias("x_num"),
        nothing.alias("x_den"), nothing.alias("y_num"), nothing.alias("y_den"),
    )
    pairs = correlation_candidates.select(F.lit("correlations").alias("kind"), *PAIR_KEYS).toDF(
        *schemas.UNFINISHED.names
    )
    return per_axis.unionByName(per_indicator).unionByName(pairs)


def counted_work(unfinished: DataFrame, pair_counts: DataFrame) -> DataFrame:
    """Open work with a number ``open``: that without correlations row by row, the correlations as one row per
    axis with the number of its pairs (``candidates.count_new_correlations``)."""
    nothing = F.lit(None).cast("string")
    counted = pair_counts.filter("as_x > 0").select(F.lit("correlations"), *AXIS_KEYS, nothing, nothing, "as_x")
    return unfinished.withColumn("open", F.lit(1).cast("long")).unionByName(counted.toDF(*schemas.UNFINISHED.names, "open"))


def indicators_with_work(unfinished: DataFrame, pair_counts: DataFrame | None = None) -> DataFrame:
    """All indicators named anywhere in the open work.

    Open correlations may be given as the counts of their axes instead (``candidates.count_new_correlations``).
    """
    named = unfinished.select(F.explode(F.array("x_num", "x_den", "y_num", "y_den")).alias("indicator_uuid"))
    if pair_counts is not None:
        paired = pair_counts.filter("as_x > 0 or as_y > 0")
        named = named.unionByName(paired.select(F.explode(F.array(*AXIS_KEYS)).alias("indicator_uuid")))
    return named.filter(F.col("indicator_uuid").isNotNull()).distinct()


def indicators_with_important_work(unfinished: DataFrame) -> DataFrame:
    """Numerators with open work other than correlations, which do not delay publication."""
    return (
        unfinished.filter((F.col("kind") != "correlations") & F.col("x_num").isNotNull())
        .select(F.col("x_num").alias("indicator_uuid"))
        .distinct()
    )


def publishable(metadata: DataFrame, axis: DataFrame, unfinished: DataFrame) -> DataFrame:
    """Live, finished versions of logical indicators that have a finished NEW version."""
    busy = indicators_with_important_work(unfinished).toDF("internal_id")
    idle = metadata.join(busy, "internal_id", "left_anti")
    with_axis = axis.select(F.col("numerator_uuid").alias("internal_id"))
    finished = (
        idle.filter(F.col("state") == schemas.NEW)
        .join(with_axis, "internal_id", "left_semi")
        .select("external_id")
    )
    return active(idle).join(finished, "external_id", "left_semi").select("internal_id", "state")


def newest_ready_only(metadata: DataFrame) -> DataFrame:
    """Of several READY versions keep the newest; a version without a date counts as newest."""
    ready = metadata.filter(F.col("state") == schemas.READY)
    newest = ready.groupBy("external_id").agg(
        F.max(F.struct(F.col("date").isNull().alias("undated"), "date", "internal_id"))["internal_id"].alias(
            "internal_id"
        )
    )
    superseded = ready.join(newest.select("internal_id"), "internal_id", "left_anti")
    return set_state(metadata, superseded.select("internal_id", F.lit(schemas.OUTDATED).alias("new_state")))


def publish(metadata: DataFrame, axis: DataFrame, unfinished: DataFrame) -> DataFrame:
    """NEW to READY and READY to OUTDATED where a new version is finished, newest READY kept."""
    switched = publishable(metadata, axis, unfinished).select(
        "internal_id",
        F.when(F.col("state") == schemas.READY, F.lit(schemas.OUTDATED))
        .otherwise(F.lit(schemas.READY))
        .alias("new_state"),
    )
    return newest_ready_only(set_state(metadata, switched))


def changed_states(before: DataFrame, after: DataFrame) -> DataFrame:
    """Versions whose state differs between two metadata tables."""
    old = before.select("internal_id", F.col("state").alias("old_state"))
    return (
        after.join(old, "internal_id")
        .filter(~F.col("state").eqNullSafe(F.col("old_state")))
        .select("param_id", "internal_id", "external_id", "old_state", "state")
    )


# --- removal --------------------------------------------------------------------------------


def failed_uploads(metadata: DataFrame, now: datetime, running: DataFrame | None = None) -> DataFrame:
    """Versions still being copied a minute after they were created, and by no running upload."""
    stuck = metadata.filter(
        (F.col("state") == schemas.COPY_IN_PROGRESS)
        & (F.col("date") < F.lit(now).cast("timestamp") - F.expr("INTERVAL '1' MINUTE"))
    )
    if running is not None:
        stuck = stuck.join(running.select("internal_id"), "internal_id", "left_anti")
    return stuck


def remove_failed_uploads(metadata: DataFrame, now: datetime, running: DataFrame | None = None) -> DataFrame:
    return metadata.join(
        failed_uploads(metadata, now, running).select("internal_id"), "internal_id", "left_anti"
    )


def outdated(metadata: DataFrame) -> DataFrame:
    return metadata.filter(F.col("state") == schemas.OUTDATED).select("internal_id")


def purge_facts(facts: DataFrame, metadata: DataFrame) -> DataFrame:
    return facts.join(outdated(metadata).toDF("indicator_uuid"), "indicator_uuid", "left_anti").select(
        *facts.columns
    )


def purge_axes(axis: DataFrame, metadata: DataFrame) -> DataFrame:
    gone = outdated(metadata)
    for key in AXIS_KEYS:
        axis = axis.join(gone.toDF(key), key, "left_anti").select(*axis.columns)
    return axis


def purge_correlations(correlation: DataFrame, metadata: DataFrame) -> DataFrame:
    gone = outdated(metadata)
    columns = correlation.columns
    for key in PAIR_KEYS:
        correlation = correlation.join(gone.toDF(key), key, "left_anti").select(*columns)
    return correlation


def purge_metadata(metadata: DataFrame) -> DataFrame:
    return metadata.filter(~F.col("state").eqNullSafe(schemas.OUTDATED))


def purge(
    facts: DataFrame, metadata: DataFrame, axis: DataFrame, correlation: DataFrame, overrides: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """All tables without outdated versions and without what hung on them."""
    kept = purge_metadata(metadata)
    return (
        purge_facts(facts, metadata),
        kept,
        purge_axes(axis, metadata),
        purge_correlations(correlation, metadata),
        without_orphans(overrides, kept),
    )
