"""Exact order statistics of many groups, whatever the size of a group.

The built-in exact percentiles keep all distinct values of a group in one task. Here only
counts are shuffled: a first pass counts values on a fixed logarithmic scale, and only the few
value ranges that hold a wanted rank are looked at again, split more finely, until the value at
the rank is known. Equal values collapse into one count, so ties do not matter either.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats.functions.pairing import attach
from hexstats.sources.staging import stage

#: counting ranges per power of two in the first pass, and per range in the later ones
_FIRST_SPLIT = 32
_SPLIT = 1024
#: ranges with at most this many rows are settled by ordering their values
SORTABLE_ROWS = 1_000_000


def log_slot(value: Column) -> Column:
    """Counting range of a value. Never decreases with the value and needs no knowledge of the
    data, so a recomputed task always agrees with the first attempt."""
    magnitude = F.greatest(F.lit(-1100.0), F.least(F.lit(1100.0), F.log2(F.abs(value))))
    rank = F.floor(magnitude * _FIRST_SPLIT) + 1101 * _FIRST_SPLIT
    return F.when(value > 0, rank).when(value < 0, -rank).otherwise(F.lit(0)).cast("long")


def histogram(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    """First pass: (keys, slot, n, lo, hi)."""
    return (
        values.groupBy(*keys, log_slot(F.col(value)).alias("slot"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    )


def _wanted_in_range(wanted: Column, before: Column, n: Column) -> Column:
    return F.filter(wanted, lambda w: (w["at"] > before) & (w["at"] <= before + n))


def _locate(counts: DataFrame, keys: list[str], order: str, wanted: Column) -> DataFrame:
    """Find the range of each wanted rank: ``counts`` has (keys, order, n, lo, hi)."""
    upto = F.sum("n").over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return (
        counts.withColumn("before", upto - F.col("n"))
        .withColumn("hit", F.explode(_wanted_in_range(wanted, F.col("before"), F.col("n"))))
        .withColumn("at", F.col("hit.at") - F.col("before"))
        .withColumn("rank", F.col("hit.rank"))
    )


def _attach_both(rows: DataFrame, ranges: DataFrame, keys: list[str], key: str, all_values: int) -> DataFrame:
    """Rows with the ranges of their own group and of the group over all values of ``key``."""
    others = [k for k in keys if k != key]
    by_slot = ranges.groupBy(*others, "slot").agg(F.collect_list(F.struct(key, "lo", "hi", "number")).alias("ranges"))
    mine = F.filter("ranges", lambda r: (r[key] == F.col(key)) | (r[key] == all_values))
    return (
        attach(rows, stage(by_slot), [*others, "slot"])
        .select(*others, "slot", "v", F.explode(mine).alias("range"))
        .select(*others, "slot", "v", *[F.col(f"range.{c}").alias(c) for c in (key, "lo", "hi", "number")])
    )


def order_statistics(
    values: DataFrame,
    keys: list[str],
    value: str,
    ranks: Callable[[Column], Column],
    counts: DataFrame | None = None,
    sortable_rows: int = SORTABLE_ROWS,
    total_of: tuple[str, int] | None = None,
) -> DataFrame:
    """Values at 1-based ranks: (keys, n, by_rank map<rank, value>).

    ``ranks`` turns the row count of a group into the array of ranks wanted from it. ``values``
    is read once per pass and must hold no NULL; ``counts`` may bring a ready first pass.

    With ``total_of``, a key and the number that stands for all its values, every row also counts for the group
    of that number, which ``counts`` must hold. Only rows in a range of either group are looked at twice.

    Ranges are numbered anew in every pass: a group has at most one per wanted rank, so the numbers
    stay small however often a range is split.
    """
    rows = values.select(
        *keys,
        F.col(value).alias("v"),
        log_slot(F.col(value)).alias("slot"),
    )
    if counts is None:
        counts = histogram(values, keys, value)
    total = F.sum("n").over(W.partitionBy(*keys))
    counted = counts.withColumn("total", total).withColumn(
        "wanted",
        F.transform(F.array_distinct(ranks(F.col("total"))), lambda r: F.struct(r.alias("at"), r.alias("rank"))),
    )
    hits = stage(
        _locate(counted, keys, "slot", F.col("wanted")).select(
            *keys, "slot", "n", "lo", "hi", "at", "rank", "total"
        )
    )

    settled = []
    while True:
        settled.append(hits.filter(F.col("lo") == F.col("hi")).select(*keys, "total", "rank", F.col("lo").alias("v")))
        unsettled = hits.filter(F.col("lo") < F.col("hi"))
        largest = unsettled.agg(F.max("n")).first()[0]  # one number
        if largest is None:
            break
        ranges = unsettled.groupBy(*keys, "slot", "lo", "hi", "total").agg(
            F.collect_list(F.struct("at", "rank")).alias("wanted")
        )
        ranges = stage(ranges.withColumn("number", F.row_number().over(W.partitionBy(*keys).orderBy("slot")) - 1))
        if total_of is None:
            rows = attach(rows, ranges.select(*keys, "slot", "lo", "hi", "number"), [*keys, "slot"])
        else:
            rows = _attach_both(rows, ranges, keys, *total_of)
            total_of = None
        sort_now = largest <= sortable_rows
        if sort_now:
            step = F.col("v")
        else:
            along = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo"))
            step = F.least(F.floor(along * _SPLIT), F.lit(_SPLIT - 1)).cast("long")
        finer = (
            rows.groupBy(*keys, "slot", step.alias("step"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .join(ranges.drop("lo", "hi"), [*keys, "slot"])
        )
        found = _locate(finer, [*keys, "slot"], "step", F.col("wanted"))
        if sort_now:
            settled.append(found.select(*keys, "total", "rank", F.col("lo").alias("v")))
            break
        split = F.col("number").cast("long") * _SPLIT
        rows = rows.select(*keys, "v", (split + step).alias("slot"))
        hits = stage(
            found.select(
                *keys, (split + F.col("step")).alias("slot"), "n", "lo", "hi", "at", "rank", "total"
            )
        )

    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    return out.groupBy(*keys).agg(
        F.first("total").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("by_rank")
    )


def _position(n: Column, p: float) -> Column:
    return F.lit(p) * (n - 1).cast("double")


def continuous_ranks(probabilities: tuple[float, ...]) -> Callable[[Column], Column]:
    def ranks(n: Column) -> Column:
        return F.array(
            *[edge(_position(n, p)) + 1 for p in probabilities for edge in (F.floor, F.ceil)]
        )

    return ranks


def continuous(n: Column, by_rank: Column, p: float) -> Column:
    """Interpolated percentile from the two neighbouring order statistics."""
    at = _position(n, p)
    low = F.try_element_at(by_rank, F.floor(at) + 1)
    high = F.try_element_at(by_rank, F.ceil(at) + 1)
    return low + (at - F.floor(at)) * (high - low)


def _discrete_rank(n: Column, p: Column) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(p * n.cast("double")))


def discrete_ranks(probabilities: tuple[float, ...]) -> Callable[[Column], Column]:
    def ranks(n: Column) -> Column:
        return F.transform(F.lit(list(probabilities)), lambda p: _discrete_rank(n, p))

    return ranks


def discrete(n: Column, by_rank: Column, probabilities: tuple[float, ...]) -> Column:
    """Discrete percentiles as one array, in the order of ``probabilities``."""
    return F.transform(
        F.lit(list(probabilities)), lambda p: F.try_element_at(by_rank, _discrete_rank(n, p))
    )
