"""Hard-negative mining: for anchors and their positives, the best rows of other labels within a window of scores.

Scores are integer inner products of quantised vectors. All rows are cut into blocks and all anchors into
groups; every (group, block) meets in one task. There a threshold join with an inverted index
finds what scores at least a threshold per anchor:

* Dimensions are ordered by their energy in the block. Of each row the index leaves out the leading
  dimensions, as long as the norm of what is left out is below the least threshold divided by the anchor's
  norm; a row that shares nothing with the index cannot reach the threshold.
* Partial scores are accumulated over the postings of a few dimensions at a time. After each step a
  row stays for an anchor only if its partial score plus the product of the remaining norms reaches the threshold.
* The rest is scored exactly. Thresholds are lowered until each anchor's window is full in this block, or
  the end of its window is reached.

So a block returns at most a few rows per anchor and window, and these are merged by rank. The first join
finds the positives, the second the negatives below each of them.

Edge cases: rows with a null id, label or vector, a null or non-finite component, or a quantised length of
2**31 or more (its scores would not fit 64 bits) take no part; shorter vectors count as filled up with
zeros; rows with the same vec_id are one row, the one with the smallest label and then vector; ties go
by vec_id; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats.sources.staging import stage

#: rows of a block, anchors of a group, fewer if they are wide, and anchors scored at a time
BLOCK, GROUP, CHUNK = 8_192, 32_768, 64
#: values of a block, and of a group
BLOCK_VALUES, GROUP_VALUES = 1 << 20, 1 << 21
#: tasks of a join; beyond, a task takes several pairs of block and group, one after another
TASKS = 20_000
#: dimensions accumulated between two prunings, and the share of rows below which the others are dropped at once
STEP, KEPT = 16, 0.7
#: thresholds for positives, as shares of the greatest possible score, and for negatives, as places in the window
POSITIVE_STEPS = (0.9, 0.7, 0.5, 0.3, 0.1)
NEGATIVE_STEPS = (0.75, 0.5, 0.25, 0.0)
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: least and greatest share of a positive's score that a negative may have, in hundredths
LEAST, MOST = 50, 95
#: share by which bounds are raised against the rounding of norms
SLACK = 1e-9
_NOTHING = -(1 << 62)
PREPARED = "vec_id long, label long, vector binary"
MEMBERS = "block int, group int, vec_id long, label long, vector binary, limits array<long>, anchor boolean"
FOUND = "anchor_id long, limit long, other_id long, score long"


def _quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector as 32-bit integers) of the rows that take part, one per vec_id."""

    def quantise(batches):
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            values = np.floor(SCALE * flat.to_numpy(zero_copy_only=False).astype(np.float64))
            row = np.repeat(np.arange(len(lists)), sizes)
            values = np.where(np.abs(values) < 2.0**31, values, np.inf)
            length = np.sqrt(np.bincount(row, values * values, minlength=len(lists)))
            good = np.flatnonzero(length < 2.0**31)
            ends = np.cumsum(sizes)
            whole = np.where(np.isfinite(values), values, 0).astype("<i4").tobytes()
            blobs = [whole[4 * (ends[k] - sizes[k]) : 4 * ends[k]] for k in good.tolist()]
            taken = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken).cast(pa.int64()), batch.column(1).take(taken).cast(pa.int64()), pa.array(blobs, pa.binary())],
                ["vec_id", "label", "vector"],
            )

    known = (
        rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
        .filter(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    )
    one = F.min(F.struct("label", "vector")).alias("one")
    return known.mapInArrow(quantise, PREPARED).groupBy("vec_id").agg(one).select("vec_id", "one.label", "one.vector")


def _matrix(blobs: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(blobs), width))
    for k, blob in enumerate(blobs):
        values = np.frombuffer(blob, "<i4")
        out[k, : len(values)] = values
    return out


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row by row inner products as 64-bit integers."""
    if not len(left):
        return np.zeros(0, np.int64)
    if np.linalg.norm(left, axis=1).max() * np.linalg.norm(right, axis=1).max() < 2.0**52:  # all sums are whole in a double
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    return (left.astype(np.int64) * right.astype(np.int64)).sum(axis=1)


class Index:
    """Inverted index of a block of rows for thresholds on inner products."""

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort((rows * rows).sum(axis=0), kind="stable")  # little energy first
        self.rows = rows[:, self.order]
        self.norms = np.sqrt(np.cumsum(np.pad(self.rows * self.rows, ((0, 0), (1, 0))), axis=1))  # of the first k dimensions
        self.greatest = float(self.norms[:, -1].max(initial=0.0))

    def reaching(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs whose score is at least the anchor's threshold."""
        anchors = anchors[:, self.order]
        heads = np.sqrt(np.cumsum(np.pad(anchors * anchors, ((0, 0), (1, 0))), axis=1))
        raised = 1 + SLACK
        share = (least / np.maximum(heads[:, -1], 1e-300)).min()
        below = _below(least)[:, None]
        # dimensions of each row that the index leaves out, in whole steps
        out = np.maximum((self.norms * raised < share).sum(axis=1) - 1, 0) // STEP * STEP if share > 0 else np.zeros(len(self.rows), np.int64)
        by = np.argsort(out, kind="stable")
        out, rows, norms = out[by], self.rows[by], self.norms[by]
        partial = np.zeros((len(anchors), len(rows)))
        for low in range((rows.shape[1] - 1) // STEP * STEP, -1, -STEP):
            n = int(np.searchsorted(out, low, "right"))  # rows with postings among these dimensions
            partial[:, :n] += anchors[:, low : low + STEP] @ rows[:n, low : low + STEP].T
            alive = (partial[:, :n] + np.outer(heads[:, low], norms[:n, low] * raised) >= below).any(axis=0)
            if alive.sum() < KEPT * n:  # moving the rest pays
                kept = np.append(np.flatnonzero(alive), np.arange(n, len(rows)))
                out, rows, norms, by, partial = out[kept], rows[kept], norms[kept], by[kept], partial[:, kept]
        pairs = []
        for low in np.unique(out).tolist():
            first, last = np.searchsorted(out, [low, low + 1])
            a, r = np.nonzero(partial[:, first:last] + np.outer(heads[:, low], norms[first:last, low] * raised) >= below)
            pairs.append(np.stack([a, by[first + r]]))
        a, r = np.concatenate([np.zeros((2, 0), np.int64), *pairs], axis=1)
        score = np.concatenate([np.zeros(0, np.int64), *(_exact(anchors[a[k : k + BLOCK]], self.rows[r[k : k + BLOCK]]) for k in range(0, len(a), BLOCK))])
        kept = np.flatnonzero(score >= least[a])
        kept = kept[np.argsort(a[kept], kind="stable")]
        return a[kept], r[kept], score[kept]


def _below(least: np.ndarray) -> np.ndarray:
    """Thresholds lowered by what the rounding of partial sums may cost."""
    return least - np.abs(least) * 1e-9 - 0.5


def _first(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first rows of each owner: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, owner))
    begin = np.searchsorted(owner[order], owner[order])
    return order[np.arange(len(order)) - begin < most]


def _positives(ids, vectors, index_ids, rows) -> list[tuple[np.ndarray, ...]]:
    """First rows of one label for the anchors of that label, in one block."""
    index, found = Index(rows), []
    norms = np.linalg.norm(vectors, axis=1)
    open_ = np.arange(len(ids))
    for share in (*POSITIVE_STEPS, None):
        left = []
        for k in range(0, len(open_), CHUNK):
            part = open_[k : k + CHUNK]
            least = np.floor(share * norms[part] * index.greatest) if share is not None else np.full(len(part), float(_NOTHING))
            a, r, score = index.reaching(vectors[part], least)
            other = ids[part[a]] != index_ids[r]
            a, r, score = a[other], r[other], score[other]
            full = np.bincount(a, minlength=len(part)) >= POSITIVES
            full |= share is None
            top = _first(a, score, index_ids[r], POSITIVES)
            top = top[full[a[top]]]
            found.append((part[a[top]], r[top], score[top]))
            left.append(part[~full])
        open_ = np.concatenate(left) if left else open_
        if not len(open_):
            break
    return found


def _negatives(labels, limits, vectors, index_ids, index_labels, rows) -> list[tuple[np.ndarray, ...]]:
    """For each anchor and score of a positive the first rows of other labels in its window, in one block."""
    index, found = Index(rows), []
    low = np.array([_window(min(x))[0] for x in limits], float)
    high = np.array([_window(min(x))[1] for x in limits], float)
    open_ = np.arange(len(limits))
    for place in NEGATIVE_STEPS:
        left = []
        for k in range(0, len(open_), CHUNK):
            part = open_[k : k + CHUNK]
            least = np.ceil(low[part] + place * (high[part] - low[part]))
            a, r, score = index.reaching(vectors[part], least)
            other = labels[part[a]] != index_labels[r]
            a, r, score = a[other], r[other], score[other]
            begin = np.searchsorted(a, np.arange(len(part) + 1))
            for n, anchor in enumerate(part.tolist()):
                own = slice(begin[n], begin[n + 1])
                best = []
                for positive in limits[anchor]:
                    bottom, top = _window(positive)
                    inside = np.flatnonzero((score[own] <= top) & (score[own] >= bottom))
                    first = inside[np.lexsort((index_ids[r[own][inside]], -score[own][inside]))[:NEGATIVES]]
                    best.append((positive, first, len(first) == NEGATIVES or least[n] <= bottom))
                if all(done for *_, done in best):
                    for positive, first, _ in best:
                        found.append((np.full(len(first), anchor), r[own][first], score[own][first], np.full(len(first), positive)))
                else:
                    left.append(anchor)
        open_ = np.array(left, np.int64)
        if not len(open_):
            break
    return found


def _window(positive: int) -> tuple[int, int]:
    """Least and greatest score of a negative."""
    return -(-LEAST * positive // 100), MOST * positive // 100


def _met(members: pa.Table) -> pa.Table:
    """What one block has for one group of anchors."""
    anchor = members.column("anchor").to_numpy(zero_copy_only=False).astype(bool)
    ids, labels = members.column("vec_id").to_numpy(), members.column("label").to_numpy()
    blobs = members.column("vector").to_pylist()
    vectors = _matrix(blobs, max(max(map(len, blobs)) // 4, 1))
    a, b = np.flatnonzero(anchor), np.flatnonzero(~anchor)
    out = []
    if len(a) and len(b):
        limits = members.column("limits").take(pa.array(a)).to_pylist()
        if limits[0] is None:
            for label in np.unique(labels[a]):
                own, rows = a[labels[a] == label], b[labels[b] == label]
                if len(rows):
                    out += [(ids[own[x]], np.zeros(len(x), np.int64), ids[rows[y]], s) for x, y, s in _positives(ids[own], vectors[own], ids[rows], vectors[rows])]
        else:
            found = _negatives(labels[a], limits, vectors[a], ids[b], labels[b], vectors[b])
            out = [(ids[a[x]], p, ids[b[y]], s) for x, y, s, p in found]
    columns = [np.concatenate([np.zeros(0, np.int64), *(x[k] for x in out)]).astype(np.int64) for k in range(4)]
    return pa.table(columns, ["anchor_id", "limit", "other_id", "score"])


def _joined(anchors: DataFrame, rows: DataFrame, blocks: int, groups: int) -> DataFrame:
    """Every group of anchors with every block of rows."""

    def copies(count: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    def part(count: int, name: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int").alias(name)

    named = ("vec_id", "label", "vector")
    left = anchors.select(part(groups, "group"), *named, "limits", F.lit(True).alias("anchor"), copies(blocks, "block"))
    right = rows.select(part(blocks, "block"), *named, F.lit(None).cast("array<long>").alias("limits"), F.lit(False).alias("anchor"), copies(groups, "group"))
    together = left.unionByName(right).repartition(min(blocks * groups, TASKS), "block", "group")
    return together.groupBy("block", "group").applyInArrow(_met, FOUND)


def _ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first rows of each key over all blocks, numbered from 1."""
    order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mined(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Hard negatives of all rows for which ``is_anchor`` holds: anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and embedding; anchors are searched for among all of them.
    """
    all_rows = stage(_quantised(rows))
    anchors = all_rows.filter(is_anchor)
    sizes = all_rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors"), F.max(F.octet_length("vector")).alias("bytes")
    ).first()
    width = max((sizes["bytes"] or 0) // 4, 1)
    block, group = min(BLOCK, max(BLOCK_VALUES // width, 1)), min(GROUP, max(GROUP_VALUES // width, 1))
    blocks, groups = max(-(-sizes["rows"] // block), 1), max(-(-sizes["anchors"] // group), 1)
    unlimited = anchors.withColumn("limits", F.lit(None).cast("array<long>"))
    near = _ranked(_joined(unlimited, all_rows, blocks, groups), ["anchor_id"], POSITIVES)
    positives = stage(near.select("anchor_id", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # a negative score has no window; equal scores share one
    limits = positives.filter("positive_score >= 0").groupBy("anchor_id").agg(F.collect_set("positive_score").alias("limits"))
    limited = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    lower = _ranked(_joined(limited, all_rows, blocks, groups), ["anchor_id", "limit"], NEGATIVES)
    negatives = lower.select(
        "anchor_id", F.col("limit").alias("positive_score"), "rank",
        F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
    return positives.join(negatives, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
