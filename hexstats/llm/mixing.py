"""Mixing sources to target weights.

Words are summed per source, the total is shared out by weight, and each document is repeated at
its source's rate: the whole part always, the fraction with that probability, drawn from a hash of
the document's id, or of its text if it has none, so that a rerun takes the same documents.

Edge cases: a null or empty text has size 0; a null source is a source of its own and comes last;
sources without words get nothing; an empty table stays empty; equal ids draw alike, and so do equal texts without id; columns other
than doc_id, text and source are passed through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats.sources.staging import stage

#: weights of the sources in code point order, repeated from the start after the last
WEIGHTS = (5, 2, 1)
#: a target is at most this many times the size of its source
MOST_REPEATS = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def size(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_totals(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight), one row per source; ``sized`` has source and size.

    The running number behind the weight is taken from sorted ranges and the number of rows before
    each range, so that any number of sources can be numbered without passing through one task.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    ranged = stage(totals.repartitionByRange(order).withColumn("_range", F.spark_partition_id()))
    per_range = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))  # a row per partition
    before = per_range.withColumn(
        "_before", F.sum("_rows").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    ).select("_range", F.coalesce("_before", F.lit(0)).alias("_before"))
    number = F.col("_before") + F.row_number().over(W.partitionBy("_range").orderBy(order)) - 1
    weight = F.element_at(F.lit(list(WEIGHTS)), (F.pmod(number, F.lit(len(WEIGHTS))) + 1).cast("int"))
    return stage(ranged.join(before, "_range").select("source", "source_size", weight.alias("weight")))


def with_targets(totals: DataFrame) -> DataFrame:
    """Add target: everything is shared by weight, no source gets more than its limit.

    A level (words per unit of weight) that fits all sources below their limit is raised until no
    further source reaches its limit. Each step is one small aggregation; the level only rises and
    every step settles at least one more source.
    """
    limit = F.col("source_size") * MOST_REPEATS
    level, settled = 0.0, -1
    while True:
        full = limit < F.lit(level) * F.col("weight")
        got = totals.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, limit).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)).alias("weight"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if not got["all"] or got["n"] == settled:
            break
        level, settled = (got["all"] - got["full"]) / got["weight"], got["n"]
    return totals.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight")))


def draw(doc_id: Column, text: Column) -> Column:
    """Number in [0, 1) that depends only on the id, or on the text where that is null."""
    key = F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Add source_size, target and copies to ``rows`` (source, drawn, ...).

    ``targets`` has a row per source; Spark broadcasts it while it is under the session's
    threshold, and splits a hot source otherwise.
    """
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    copies = F.floor(rate) + (F.col("drawn") < rate - F.floor(rate)).cast("long")
    right = targets.select(F.col("source").alias("_source"), "source_size", "target")
    joined = rows.join(right, rows["source"].eqNullSafe(right["_source"])).drop("_source")
    return joined.withColumn("copies", copies).drop("drawn")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, drawn, size) of every document."""
    return docs.select("doc_id", "source", draw(F.col("doc_id"), F.col("text")).alias("drawn"), size(F.col("text")).alias("size"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: columns of ``docs``, each document as often as it is taken."""
    columns = docs.columns
    targets = with_targets(source_totals(sized(docs)))
    packed = docs.select("source", draw(F.col("doc_id"), F.col("text")).alias("drawn"), F.struct(*columns).alias("_row"))
    taken = with_copies(packed, targets).select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("_row.*")


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    rows = stage(sized(docs))
    found = with_copies(rows, with_targets(source_totals(rows)))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
