"""Ranked lexical search: a K2-treap over the grid of terms and documents, descended best first per item.

Items are taken in blocks of bounded size. For a block, one pass over the documents counts the block's terms
in each of them; these counts are staged, and give the number of documents that hold a term. A second pass
builds, for every few thousand documents, a tree over the grid whose rows are the block's terms (frequent
ones first) and whose columns are the documents, by doc_id:

* A cell is split into four down to single places; only cells with postings are kept, level after level,
  each with the bits of its quarters that exist, the number of its first quarter, and the greatest impact in it.
* An item follows the paths of all its rows at once over ranges of documents. The sum of the maxima of its
  cells bounds the score of every document of the range. The ranges with the highest bounds are halved first,
  until no range can beat the item's last result; at a single document the bound is the score.

A task returns its best documents per item, and those are merged by rank. Impacts are whole numbers and
scores are exact.

Edge cases: a null text has no terms; an item without terms, or that is null, finds nothing; rows without
doc_id count in the statistics but cannot be found; rows with the same doc_id are documents of their own;
equal items are one, different texts under one item_id are ranked apart; equal scores go by doc_id; other
columns are ignored; an empty table finds nothing. Memory: one block of items, and the postings of one tree.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexstats.llm import flat
from hexstats.llm.common import map_texts
from hexstats.sources.staging import stage

#: results per item
MOST = 20
#: items, and bytes of their texts, that are searched together
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 8 << 20
#: documents and postings of a tree
DOCUMENTS, POSTINGS = 8_192, 1 << 20
#: ranges halved at a time, and open cells of an item from which the deepest ranges go first
AT_ONCE, OPEN = 32, 1 << 22
# Bytes of words, and the weights of the score.
WORD = flat.table(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
WEIGHT_SCALE, IMPACT_SCALE, TF_SCALE, LENGTH_SCALE = 1000, 1_000_000_000, 1000, 12
FLOOR_SHARE, LENGTH_SHARE = 75, 25
COUNTED = "doc_id long, n long, terms array<int>, times array<int>"
FOUND = "item int, doc_id long, score long"
#: by the bits of a cell's quarters and a quarter: whether it exists, and how many come before it
_THERE = np.array([bits >> q & 1 for bits in range(16) for q in range(4)], bool)
_BEFORE = np.array([(bits & ((1 << q) - 1)).bit_count() for bits in range(16) for q in range(4)], np.int32)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text)."""
    starts, ends, first = flat.words(data, offsets, WORD)
    return flat.span_hashes(data, starts, ends, lower=True), first


class Items:
    """A block of items: the different terms of all of them, and those of each with their numbers."""

    def __init__(self, texts: list[str]):
        _, data, offsets = next(flat.slices(pa.array(texts, pa.string()), 1 << 62))
        hashes, first = words(data, offsets)
        self.terms, term = np.unique(hashes, return_inverse=True)
        self.of = []
        for begin, end in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            self.of.append(np.unique(term[begin:end], return_counts=True))


def counted(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """Per document: doc_id, its number of words, and the given terms in it with their frequencies."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row, data, offsets in flat.slices(batch.column(1)):
            hashes, first = words(data, offsets)
            place = np.searchsorted(terms, hashes)
            place[place == len(terms)] = 0
            asked = np.flatnonzero(terms[place] == hashes)
            text = flat.owners(first, len(hashes))[asked]
            key, times = np.unique(text * len(terms) + place[asked], return_counts=True)
            limits = np.searchsorted(key, np.arange(len(first)) * len(terms))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(row, len(offsets) - 1).cast(pa.int64()),
                    pa.array(np.diff(first)),
                    pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(key % len(terms), pa.int32())),
                    pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(times, pa.int32())),
                ],
                ["doc_id", "n", "terms", "times"],
            )

    return map_texts(docs, count, COUNTED, "doc_id", "text")


class Treap:
    """Tree over the places (row, column) of a square grid with a value each, and the maxima of its cells.

    Cells are numbered level by level; number 0 stands for cells that are empty.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, levels: int):
        self.levels = levels
        code = np.zeros(len(row), np.int64)
        for bit in range(levels):
            code |= ((column >> bit & 1) << (2 * bit)) | ((row >> bit & 1) << (2 * bit + 1))
        order = np.argsort(code)
        code, best = code[order], value[order]
        stored = [(code, best, np.zeros(len(code), np.int8), None)]
        for _ in range(levels):
            parent = code >> 2
            begin = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            quarters = np.bitwise_or.reduceat(1 << (code & 3), begin).astype(np.int8)
            code, best = parent[begin], np.maximum.reduceat(best, begin)
            stored.append((code, best, quarters, begin))
        stored.reverse()
        sizes = [len(x[0]) for x in stored]
        numbers = np.append(1, 1 + np.cumsum(sizes))  # of the first cell of each level
        self.best = np.concatenate([[0], *(x[1] for x in stored)]).astype(np.int64)
        self.quarters = np.concatenate([[0], *(x[2] for x in stored)]).astype(np.int8)
        self.first = np.concatenate([[0], *(np.zeros(len(x[0]), np.int64) if x[3] is None else x[3] + numbers[k + 1] for k, x in enumerate(stored))]).astype(np.int32)

    def below(self, cells: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        """The given quarter of each cell, 0 where it is empty."""
        place = self.quarters[cells] * np.int8(4) + quarter
        return np.where(_THERE[place], self.first[cells] + _BEFORE[place], 0)


def best_documents(tree: Treap, rows: np.ndarray, times: np.ndarray, ids: np.ndarray, score: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best (scores, doc_ids) of an item, given the best so far; ``ids`` has the columns' doc_ids, rising."""
    shift, levels = tree.levels - 1, tree.levels
    held = np.ones((4 * AT_ONCE, len(rows)), np.int32)  # the cells of each open range, in its slot
    spare = list(range(len(held) - 1, 0, -1))
    slot, level, column = (np.zeros(1, np.int64) for _ in range(3))
    bound = np.array([(tree.best[held[0]] * times).sum()])
    while True:
        ahead = bound > (score[-1] if len(score) == MOST else 0)
        if len(score) == MOST:  # an equal score counts if its document comes first
            ahead |= (bound == score[-1]) & (ids[column << (levels - level)] < doc[-1])
        if not ahead.all():
            spare.extend(slot[~ahead].tolist())
            slot, level, column, bound = slot[ahead], level[ahead], column[ahead], bound[ahead]
        if not len(bound):
            return score, doc
        # the highest bounds first; the deepest ranges once many are open, which closes them
        first = bound if len(bound) * len(rows) < OPEN else level
        taken = np.argpartition(-first, AT_ONCE - 1)[:AT_ONCE] if len(bound) > AT_ONCE else np.arange(len(bound))
        single = taken[level[taken] == levels]
        if len(single):
            score = np.append(score, bound[single])
            doc = np.append(doc, ids[column[single]])
            order = np.lexsort((doc, -score))[:MOST]
            score, doc = score[order], doc[order]
            bound[single] = 0  # closed
        split = taken[level[taken] < levels]
        if not len(split):
            continue
        if len(spare) < len(split):
            spare.extend(range(2 * len(held) - 1, len(held) - 1, -1))
            held = np.concatenate([held, np.zeros_like(held)])
        other = np.array([spare.pop() for _ in range(len(split))])
        cells = held[slot[split]]
        quarter = (rows >> (shift - level[split])[:, None] & 1) * 2
        left, right = tree.below(cells, quarter), tree.below(cells, quarter + 1)
        held[slot[split]], held[other] = left, right
        level[split] += 1
        column[split] *= 2
        bound[split] = tree.best[left] @ times
        slot, level = np.append(slot, other), np.append(level, level[split])
        column, bound = np.append(column, column[split] + 1), np.append(bound, tree.best[right] @ times)


def _search(counts: DataFrame, items: Items, weights: np.ndarray, total: int, length: int) -> DataFrame:
    """The best documents per task and item."""
    by_weight = np.argsort(weights, kind="stable")  # frequent terms first
    row_of = np.empty(len(weights), np.int64)
    row_of[by_weight] = np.arange(len(weights))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(items.of)

        def search(batch: pa.RecordBatch) -> None:
            ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(ids, kind="stable")
            column = np.empty(len(ids), np.int64)
            column[order] = np.arange(len(ids))
            column = np.repeat(column, np.diff(batch.column(2).offsets.to_numpy()))
            term, tf = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (2, 3))
            if not len(term):
                return
            m = FLOOR_SHARE + LENGTH_SHARE * n * total // length
            m = np.repeat(m, np.diff(batch.column(2).offsets.to_numpy()))
            impact = weights[term] * (IMPACT_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m))
            levels = int(max(len(ids), len(weights)) - 1).bit_length()
            # places beyond the last document are never filled
            padded = np.append(ids[order], np.full((1 << levels) - len(ids) + 1, np.iinfo(np.int64).max))
            tree = Treap(row_of[term], column, impact, levels)
            for k, (terms, times) in enumerate(items.of):
                if len(terms):
                    best[k] = best_documents(tree, row_of[terms], times, padded, *best[k])

        held, documents, postings = [], 0, 0
        for batch in batches:
            begin = 0
            size = np.diff(batch.column(2).offsets.to_numpy())
            while begin < batch.num_rows:  # a tree's worth at a time
                most = np.searchsorted(np.cumsum(size[begin:]), POSTINGS - postings, "right")
                end = min(batch.num_rows, begin + DOCUMENTS - documents, begin + max(int(most), 0 if documents else 1))
                held.append(batch.slice(begin, end - begin))
                documents += end - begin
                postings += int(size[begin:end].sum())
                if documents and (end < batch.num_rows or documents == DOCUMENTS):
                    search(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, documents, postings = [], 0, 0
                begin = end
        if documents:
            search(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
        item = np.repeat(np.arange(len(best)), [len(x[0]) for x in best])
        if len(item):
            doc, score = np.concatenate([x[1] for x in best]), np.concatenate([x[0] for x in best])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc), pa.array(score)], ["item", "doc_id", "score"])

    trees = counts.filter(F.col("doc_id").isNotNull() & (F.size("terms") > 0))
    return trees.mapInArrow(over, FOUND)


def _blocks(items: DataFrame) -> Iterator[list[Row]]:
    """Items in blocks that fit the driver and every task."""
    block, size = [], 0
    for row in items.toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or size + len(row["text"]) > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["text"])
    if block:
        yield block


def ranked(docs: DataFrame, items: DataFrame, most: int = MOST) -> DataFrame:
    """The best documents of each item: item_id, rank, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text. Every block of items reads the
    documents once; a term's weight and a document's length count over all documents.
    """
    if most > MOST:
        raise ValueError(f"at most {MOST} results per item")
    spark = docs.sparkSession
    parts = []
    asked = items.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text")
    for block in _blocks(asked):
        wanted = Items([row["text"] for row in block])
        if not len(wanted.terms):
            continue
        counts = stage(counted(docs, wanted.terms))
        sizes = counts.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("words")).first()
        total, length = sizes["documents"], sizes["words"] or 0
        if not length:
            break
        held = np.zeros(len(wanted.terms), np.int64)
        for row in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
            held[row["term"]] = row["count"]
        weights = np.floor(WEIGHT_SCALE * np.log((2 * total + 2) / (2 * held + 1))).astype(np.int64)
        names = spark.createDataFrame([(k, row["item_id"]) for k, row in enumerate(block)], "item int, item_id long")
        parts.append(_search(counts, wanted, weights, total, length).join(names, "item"))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = W.partitionBy("item_id", "item").orderBy(F.col("score").desc(), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most).select("item_id", "rank", "doc_id", "score")
