"""Connected components of links, by joins and aggregations only."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats.sources.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component): every id that has a link, and the smallest id it can reach.

    ``links`` has long columns a and b, in any order, repeated or not. Alternates between hanging
    all larger neighbours of an id, and then the id itself with its smaller ones, under the
    smallest of them, until nothing changes; the number of rounds grows with the logarithm of
    the longest path. A hub's neighbours are never collected: minima are aggregated and joined
    back, and a hub's rows may be split between tasks.
    """
    links = stage(_ordered(links.select("a", "b")))
    seen = _fingerprint(links)
    while seen[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        hung = both.join(lowest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        hung = _ordered(hung)  # a is the larger end
        lowest = hung.groupBy("a").agg(F.min("b").alias("low"))
        small = hung.join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stage(_ordered(small.unionByName(lowest.select("a", F.col("low").alias("b")))))
        now = _fingerprint(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _ordered(links: DataFrame) -> DataFrame:
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    return links.filter(F.col("a") != F.col("b")).select(larger.alias("a"), smaller.alias("b")).distinct()


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of a task's ids the smallest that its links, pairs of positions (i, j), lead to."""
    label = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        if (label == before).all():
            return np.sort(ids)[label]
