r"""MinHash near-dedup with weighted signatures from hashed darts.

A document is the multiset of its runs of five words; the similarity of two documents is their
weighted Jaccard, the shared runs (each as often as both have it) over all. Every run, and every further
copy of it, is a region of weight 1 into which darts are thrown at hashed ranks, the same darts in all
documents. Each dart belongs to one of ``COORDINATES``; the earliest dart per coordinate is the
signature. Documents that agree in a band of coordinates are candidates, and are then compared exactly.

Documents with equal multisets are one class from the start; only one of each class goes on. In each
bucket all are compared with the one that shares most buckets, then those that are still in different
components with each other, so a bucket of near copies does not turn into all its pairs. That second
step multiplies blocks of a bucket inside tasks and returns one link per document, never the pairs.

Edge cases: a text of one to four words is a single run of all its words; one without words (or null)
is like nothing else; rows with the same id are one document, seen through the smallest of its run
hashes, and one of them stays; a null id is never linked and stays; an empty table stays empty;
columns other than doc_id and text are passed through whatever their names. Ties: a class is named
after its smallest id, which is the one that stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats.llm import flat
from hexstats.llm.common import map_texts
from hexstats.llm.components import components, local_roots
from hexstats.sources.staging import stage

WORDS = 5
#: similarity from which documents are linked, as a fraction
SIMILAR = (4, 5)
#: a band of 5 coordinates agrees with probability 0.8^5; all 24 bands miss a pair at 0.8 once in 14,000
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
#: darts per document in the first throw: enough that a coordinate stays empty in one document of 20
DARTS = COORDINATES * (np.log(COORDINATES) + 3)
#: documents of a bucket that meet in one task, and runs that are multiplied at a time
BLOCK, COLUMNS = 1024, 4096
#: limits of the rank cells below 1; from there on a cell is 1 long
_FINE = np.array([0, 1 / 16, 1 / 8, 1 / 4, 1 / 2])
_STEP = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, runs long, k1 long, k2 long, bands array<long>"


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the runs of each text, the n-th copy of a run with a hash of its own."""
    starts, ends, first = flat.words(data, offsets, flat.NOT_SPACE)
    words = flat.span_hashes(data, starts, ends)
    found, text = flat.windows(words, first, WORDS)
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        whole = flat.sequence_hashes(words, first[short], first[short] + count[short])
        found, text = np.concatenate([found, whole]), np.concatenate([text, short])
    order = np.lexsort((found, text))
    found, text = found[order], text[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    copy = np.arange(len(found)) - np.repeat(begin, np.diff(np.append(begin, len(found))))
    return flat.mixed(found + copy.astype(np.uint64) * _STEP), text


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(11)).astype(np.float64) * 2.0**-53


def signatures(units: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Earliest rank per text and coordinate; texts without runs keep infinity. ``text`` is sorted."""
    out = np.full((texts, COORDINATES), np.inf)
    size = np.bincount(text, minlength=texts)
    darts, todo = DARTS, size > 0
    while todo.any():
        limit = np.where(todo, darts / np.maximum(size, 1), 0.0)
        _throw(units, text, limit, out)
        todo &= np.isinf(out).any(axis=1)
        darts *= 2
    return out


def _throw(units: np.ndarray, text: np.ndarray, limit: np.ndarray, out: np.ndarray) -> None:
    """Throw the darts of all units whose rank is below the limit of their text."""
    fine = np.searchsorted(_FINE, limit)  # cells that begin below the limit
    cells = np.where(limit > 1, len(_FINE) + np.ceil(limit).astype(np.int64) - 1, fine)
    for part in np.array_split(np.arange(len(units)), max(1, int(cells[text].sum()) >> 18)):
        count = cells[text[part]]
        unit = np.repeat(part, count)
        cell = flat.spans(np.zeros(len(part), np.int64), count)
        low = np.where(cell < len(_FINE), _FINE[np.minimum(cell, len(_FINE) - 1)], cell - len(_FINE) + 1.0)
        length = np.where(cell == 0, _FINE[1], np.minimum(np.maximum(low, _FINE[1]), 1.0))
        seed = flat.mixed(units[unit] + (cell + 1).astype(np.uint64) * _STEP)
        # number of darts in the cell: Poisson with its length as mean, read off one uniform number
        left = _uniform(seed)
        chance = np.exp(-length)
        hit = np.flatnonzero(left >= chance)
        left, chance, length_ = left[hit], chance[hit], length[hit]
        n = 0
        while len(hit):
            n += 1
            dart = flat.mixed(seed[hit] + np.array([n], np.uint64) * _STEP)
            rank = low[hit] + length_ * _uniform(dart)
            owner = text[unit[hit]]
            near = rank < limit[owner]
            coordinate = (flat.mixed(dart[near]) % np.uint64(COORDINATES)).astype(np.int64)
            np.minimum.at(out.reshape(-1), owner[near] * COORDINATES + coordinate, rank[near])
            left = left - chance
            chance = chance * length_ / n
            more = left >= chance
            hit, left, chance, length_ = hit[more], left[more], chance[more], length_[more]


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, k1, k2, bands): size, identity of the multiset, and a key per band."""

    def sketch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = []
        for _, data, offsets in flat.slices(batch.column(1)):
            units, text = runs(data, offsets)
            texts = len(offsets) - 1
            first = np.searchsorted(text, np.arange(texts + 1))
            earliest = signatures(units, text, texts).view(np.uint64).reshape(texts, BANDS, ROWS)
            key = np.tile(np.arange(BANDS, dtype=np.uint64), (texts, 1))
            for k in range(ROWS):
                key = flat.mixed(key + earliest[:, :, k])
            sums = [_sums(flat.mixed(units + np.uint64(k)), first) for k in (1, 2)]
            parts.append((np.diff(first), *sums, key.view(np.int64)))
        size, k1, k2, keys = (np.concatenate(p) for p in zip(*parts, strict=True))
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1)))
        columns = [batch.column(0).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(k1), pa.array(k2), bands]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "k1", "k2", "bands"])

    return map_texts(docs, sketch, SCHEMA, "doc_id", "text")


def _sums(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes, out=total[1:])
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def run_lists(docs: DataFrame) -> DataFrame:
    """(doc_id, units): hashes of the runs of every document."""

    def collect(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = []
        for _, data, offsets in flat.slices(batch.column(1)):
            units, text = runs(data, offsets)
            limits = np.searchsorted(text, np.arange(len(offsets)))
            lists.append(pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(units.view(np.int64))))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.concat_arrays(lists)], ["doc_id", "units"])

    return map_texts(docs, collect, "doc_id long, units array<long>", "doc_id", "text")


def _verified(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents are similar enough, compared exactly."""
    left = lists.select(F.col("doc_id").alias("a"), F.col("units").alias("ua"))
    right = lists.select(F.col("doc_id").alias("b"), F.col("units").alias("ub"))
    shared = F.size(F.array_intersect("ua", "ub"))
    every = F.size("ua") + F.size("ub") - shared
    return pairs.join(left, "a").join(right, "b").filter(SIMILAR[1] * shared >= SIMILAR[0] * every).select("a", "b")


def _size_fits(n: Column, m: Column) -> Column:
    return SIMILAR[1] * F.least(n, m) >= SIMILAR[0] * F.greatest(n, m)


def _across(members: DataFrame, lists: DataFrame) -> DataFrame:
    """Links (a, b) between documents of a bucket (bucket, doc, docs, component) in different components.

    A bucket's documents are dealt to blocks, and every two blocks meet in a task of their own.
    """
    blocks = F.ceil(F.col("docs") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("doc"), blocks).cast("int")
    spread = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    keyed = spread.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "doc", "component"
    )
    full = keyed.join(lists.select(F.col("doc_id").alias("doc"), "units"), "doc")
    return full.groupBy("bucket", "low", "high").applyInArrow(_linked, "a long, b long")


def _linked(group: pa.Table) -> pa.Table:
    """(document, the smallest one it is linked to within the group) across components."""
    ids, component = group.column("doc").to_numpy(), group.column("component").to_numpy()
    units = group.column("units").combine_chunks()
    size = np.diff(units.offsets.to_numpy())
    row = np.repeat(np.arange(len(ids)), size)
    _, column, times = np.unique(units.flatten().to_numpy(), return_inverse=True, return_counts=True)
    # only runs that several documents have can be shared
    several = times > 1
    renumbered = np.cumsum(several) - 1
    keep = several[column]
    row, column = row[keep], renumbered[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(ids), len(ids)), np.float32)
    for begin in range(0, int(several.sum()), COLUMNS):
        low, high = np.searchsorted(column, (begin, begin + COLUMNS))
        part = np.zeros((len(ids), COLUMNS), np.float32)
        part[row[low:high], column[low:high] - begin] = 1
        shared += part @ part.T
    every = size[:, None] + size[None, :] - shared
    linked = (SIMILAR[1] * shared >= SIMILAR[0] * every) & (component[:, None] != component[None, :])
    i, j = np.nonzero(linked)
    some = np.unique(i)
    return pa.table({"a": ids[some], "b": local_roots(ids, i, j)[some]})


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, copy_of, component_id), one row per id that is not null.

    copy_of is the smallest id with the same multiset of runs, component_id the smallest one that
    can be reached by links.
    """
    sketched = stage(
        sketches(docs.filter(F.col("doc_id").isNotNull()))
        .groupBy("doc_id")
        .agg(F.min(F.struct("k1", "k2", "runs", "bands")).alias("s"))
        .select("doc_id", "s.*")
    )
    same = sketched.filter(F.col("runs") > 0).groupBy("k1", "k2", "runs").agg(F.min("doc_id").alias("copy_of"))
    named = stage(
        sketched.drop("bands").join(same, ["k1", "k2", "runs"], "left")
        .select("doc_id", "runs", F.coalesce("copy_of", "doc_id").alias("copy_of"))
    )
    first_ones = named.filter((F.col("doc_id") == F.col("copy_of")) & (F.col("runs") > 0)).select("doc_id")
    keys = sketched.join(first_ones, "doc_id", "left_semi").select(
        F.col("doc_id").alias("doc"), "runs", F.explode("bands").alias("bucket")
    )
    crowded = keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > 1)
    members = stage(keys.join(crowded, "bucket"))
    # in each bucket, the document with most company over all its buckets is the one to compare with
    company = members.groupBy("doc").agg(F.sum("docs").alias("company"))
    ranked = stage(members.join(company, "doc").select("doc", "runs", "bucket", "docs", "company"))
    hubs = ranked.groupBy("bucket").agg(F.max(F.struct("company", -F.col("doc"), "runs")).alias("hub")).select(
        "bucket", (-F.col("hub.col2")).alias("hub"), F.col("hub.runs").alias("hub_runs")
    )
    stars = stage(
        ranked.join(hubs, "bucket")
        .filter((F.col("doc") != F.col("hub")) & _size_fits(F.col("runs"), F.col("hub_runs")))
        .select(F.col("hub").alias("a"), F.col("doc").alias("b"))
        .distinct()
    )
    needed = ranked.select(F.col("doc").alias("doc_id")).distinct()
    # the ids grow with the data: never broadcast, so that the plan is the same at every size
    wanted = docs.select("doc_id", "text").join(needed.hint("merge"), "doc_id", "left_semi")
    lists = stage(run_lists(wanted).groupBy("doc_id").agg(F.min("units").alias("units")))
    links = stage(_verified(stars, lists))
    grouped = components(links)
    # where the others of a bucket are still in several components, compare across components
    others = ranked.join(hubs.select("bucket", "hub"), "bucket").filter(F.col("doc") != F.col("hub"))
    placed = stage(
        others.join(grouped, others["doc"] == grouped["id"], "left")
        .select("bucket", "doc", "docs", F.coalesce("component", "doc").alias("component"))
    )
    sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("kinds")).filter(F.col("kinds") > 1)
    more = _across(placed.join(mixed.select("bucket"), "bucket"), lists)
    final = components(links.unionByName(more))
    return named.join(final, named["copy_of"] == final["id"], "left").select(
        "doc_id", "runs", "copy_of", F.coalesce("component", "copy_of").alias("component_id")
    )


def near_copies(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, component_id, kept, copy_of, runs; a null id is a class of its own."""
    found = classes(docs)
    out = found.select("doc_id", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"), "copy_of", "runs")
    none = F.lit(None).cast("long")
    nameless = docs.filter(F.col("doc_id").isNull()).select(
        none.alias("doc_id"), none.alias("component_id"), F.lit(True).alias("kept"), none.alias("copy_of"), none.alias("runs")
    )
    return out.unionByName(nameless)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class."""
    kept = classes(docs).filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_kept"))
    packed = docs.select("doc_id", F.struct(*docs.columns).alias("_row"))
    named = packed.filter(F.col("doc_id").isNotNull())
    stay = named.join(kept, named["doc_id"] == kept["_kept"], "left_semi").dropDuplicates(["doc_id"])
    return stay.unionByName(packed.filter(F.col("doc_id").isNull())).select("_row.*")
