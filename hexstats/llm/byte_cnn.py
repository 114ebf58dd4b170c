r"""Quality classifier: a byte-level convolutional network in numpy.

Learned filters slide over the bytes of a text. Within overlapping chunks that cover the whole text
each filter's strongest response counts; the chunks of a text are combined by their mean and maximum,
together with the text's length, into one probability. The network is fitted on a bounded sample of labelled documents and calibrated
on a part of it that was not fitted on.

Edge cases: a null or empty text has no response to any filter and gets the score of that; without
labels of both kinds every text scores the share of good labels (1 if there are none); rows are scored on
their own, so repeated rows score alike; an empty table stays empty; other columns are ignored. Memory: a
slice of a quarter of a megabyte of text, or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats.llm import flat
from hexstats.llm.common import map_texts, training_rows
from hexstats.llm.quality_rules import platt

#: bytes a filter sees (even), number of filters, bytes of half a chunk
WIDTH, FILTERS, HALF = 8, 16, 128
#: positions whose responses are held at a time
BLOCK = 128 * HALF
#: labelled documents of each kind that are fitted on, and the longest that are (bytes)
SAMPLE, LONGEST = 2000, 16_000
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.02, 7
#: one sample row in this many calibrates
CALIBRATION = 4
#: documents whose id has this crc32 remainder (of 4) are never learned from
HELD_OUT = 2
ACCEPT = 0.7


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


@dataclass
class Padded:
    """Texts one after another, each filled up with zero bytes to whole half-chunks."""

    pairs: np.ndarray  # neighbouring bytes as one number
    first: np.ndarray  # first half-chunk of each text
    size: np.ndarray  # bytes of each text
    blank: np.ndarray  # positions beyond the end of a text


def padded(data: np.ndarray, offsets: np.ndarray) -> Padded:
    size = np.diff(offsets)
    halves = -(-(size + WIDTH - 1) // HALF)
    first = np.append(0, np.cumsum(halves))
    out = np.zeros(first[-1] * HALF + WIDTH, np.uint8)
    begin = first[:-1] * HALF
    out[flat.spans(begin, size)] = data
    pairs = out[:-1].astype(np.uint16) << 8 | out[1:]
    return Padded(pairs, first, size, flat.spans(begin + size, halves * HALF - size))


@dataclass
class Network:
    """``filters`` has a value for each place, byte and filter; byte 0 is padding and counts 0."""

    filters: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    head: np.ndarray  # (2 * FILTERS + 2,): weights of mean, maximum and length, constant
    scale: float = 1.0
    shift: float = 0.0

    def tables(self) -> np.ndarray:
        """Responses to pairs of bytes, so that a filter needs half as many look-ups."""
        left, right = self.filters[0::2], self.filters[1::2]
        return (left[:, :, None, :] + right[:, None, :, :]).reshape(WIDTH // 2, 65536, -1).astype(np.float32)


def responses(tables: np.ndarray, bias: np.ndarray, text: Padded, places: bool = False):
    """Strongest response per half-chunk and filter, and where it is if ``places``."""
    halves = int(text.first[-1])
    best = np.zeros((halves, len(bias)), np.float32)
    where = np.zeros((halves, len(bias)), np.int64) if places else None
    for begin in range(0, halves * HALF, BLOCK):
        end = min(begin + BLOCK, halves * HALF)
        found = tables[0][text.pairs[begin:end]]
        for k in range(1, WIDTH // 2):
            found += tables[k][text.pairs[begin + 2 * k : end + 2 * k]]
        low, high = np.searchsorted(text.blank, (begin, end))
        found[text.blank[low:high] - begin] = -np.inf
        found = found.reshape(-1, HALF, len(bias))
        rows = slice(begin // HALF, end // HALF)
        if places:
            where[rows] = found.argmax(axis=1)
            best[rows] = np.take_along_axis(found, where[rows][:, None, :], 1)[:, 0]
        else:
            best[rows] = found.max(axis=1)
    return np.maximum(best + bias.astype(np.float32), 0), where


def pooled(best: np.ndarray, text: Padded) -> tuple[np.ndarray, np.ndarray]:
    """(chunks, features): a chunk is two neighbouring halves; mean and maximum over a text's chunks, length.

    The last half-chunk of a text stands alone, so every text has at least one chunk.
    """
    first = text.first
    last = np.zeros(len(best), bool)
    last[first[1:] - 1] = True
    chunks = np.maximum(best, np.where(last[:, None], best, np.roll(best, -1, 0)))
    mean = np.add.reduceat(chunks.astype(np.float64), first[:-1]) / np.diff(first)[:, None]
    return chunks, np.hstack([mean, np.maximum.reduceat(chunks, first[:-1]), np.log1p(text.size)[:, None] / 10])


def log_odds(network: Network, tables: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    text = padded(data, offsets)
    _, features = pooled(responses(tables, network.bias, text)[0], text)
    return features @ network.head[:-1] + network.head[-1]


def _gradients(network: Network, text: Padded, good: np.ndarray, weight: np.ndarray) -> tuple:
    """Slopes of the weighted logistic loss in filters, bias and head."""
    best, where = responses(network.tables(), network.bias, text, places=True)
    chunks, features = pooled(best, text)
    n, texts = FILTERS, len(good)
    z = features @ network.head[:-1] + network.head[-1]
    error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good)
    head = np.append(features.T @ error, error.sum())
    owner = np.repeat(np.arange(texts), np.diff(text.first))
    through = (error / np.diff(text.first))[owner, None] * network.head[:n]
    top = chunks == features[owner, n : 2 * n]
    ties = np.maximum(np.add.reduceat(top.astype(float), text.first[:-1]), 1)
    through = through + top / ties[owner] * (error[owner, None] * network.head[n : 2 * n])
    # a chunk's response came from the stronger of its halves
    second = (chunks > best)
    half = np.where(second, 0, through)
    half[1:] += np.where(second, through, 0)[:-1]
    half = half * (best > 0)
    bias = half.sum(axis=0)
    row, column = np.nonzero(half)
    at, value = row * HALF + where[row, column], half[row, column]
    filters = np.zeros((WIDTH, 256, n))
    for k in range(WIDTH):
        byte = text.pairs[at + k] >> 8
        filters[k] = np.bincount(byte.astype(np.int64) * n + column, value, 256 * n).reshape(256, n)
    filters[:, 0] = 0
    return filters, bias, head


def fit(texts: list[str], good: np.ndarray, share_good: float) -> Network:
    """Fit on labelled texts; ``share_good`` is the share of good ones among all labels."""
    rng = np.random.default_rng(SEED)
    network = Network(
        rng.normal(0, 0.3, (WIDTH, 256, FILTERS)), np.zeros(FILTERS), np.append(rng.normal(0, 0.1, 2 * FILTERS), [0, 0])
    )
    network.filters[:, 0] = 0
    if not (good.any() and (~good).any()):
        share = min(max(share_good, 1e-3), 1 - 1e-3)
        network.head[:], network.shift = 0, float(np.log(share / (1 - share)))
        return network
    calibrating = np.arange(len(texts)) % CALIBRATION == 0
    weight = 0.5 / np.where(good, good.mean(), (~good).mean())
    parts = [network.filters, network.bias, network.head]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    step, fitting = 0, np.flatnonzero(~calibrating)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(fitting), -(-len(fitting) // BATCH)):
            if not len(rows):
                continue
            step += 1
            batch = pa.array([texts[r] for r in rows], pa.string())
            for _, data, offsets in flat.slices(batch, 1 << 40):
                slopes = _gradients(network, padded(data, offsets), good[rows], weight[rows] / len(rows))
            for part, slope, (m, v) in zip(parts, slopes, moments, strict=True):
                m += 0.1 * (slope - m)
                v += 0.01 * (slope * slope - v)
                part -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    network.filters[:, 0] = 0
    tables = network.tables()
    z = np.concatenate([log_odds(network, tables, d, o) for _, d, o in flat.slices(pa.array(texts, pa.string()))])
    use = calibrating if good[calibrating].any() and (~good[calibrating]).any() else ~calibrating
    natural = np.where(good, share_good / good[use].sum(), (1 - share_good) / (~good[use]).sum())[use] * use.sum()
    network.scale, network.shift = platt(z[use], good[use], natural)
    return network


def trained(docs: DataFrame, labels: DataFrame) -> Network:
    """The network for these labels; what reaches the driver is bounded by SAMPLE and LONGEST."""
    allowed = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    share = allowed.agg(F.avg("quality")).first()[0]
    rows = training_rows(docs, allowed, SAMPLE, LONGEST).toPandas()
    rows = rows.sort_values(["doc_id", "text"], ignore_index=True)
    return fit(rows["text"].tolist(), rows["quality"].to_numpy() == 1, 1.0 if share is None else float(share))


def scored(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ACCEPT) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # 300 kB, whatever the data

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        network, tables = shared.value, _tables(shared)
        z = [log_odds(network, tables, data, offsets) for _, data, offsets in flat.slices(batch.column(1))]
        odds = np.clip(network.scale * np.concatenate(z) + network.shift, -30, 30)
        columns = [batch.column(0).cast(pa.int64()), pa.array(1 / (1 + np.exp(-odds)))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score"])

    found = map_texts(docs, score, "doc_id long, score double", "doc_id", "text")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


_prepared: dict[int, np.ndarray] = {}


def _tables(shared) -> np.ndarray:
    """The tables of the broadcast network, made once per worker."""
    if id(shared.value) not in _prepared:
        _prepared.clear()
        _prepared[id(shared.value)] = shared.value.tables()
    return _prepared[id(shared.value)]


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those the classifier rejects; rows are kept or dropped as they are."""
    network = trained(docs, labels)
    columns = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(network)
    at = columns.index("text")

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            z = [log_odds(shared.value, _tables(shared), d, o) for _, d, o in flat.slices(batch.column(at))]
            odds = np.clip(shared.value.scale * np.concatenate(z) + shared.value.shift, -30, 30)
            yield batch.filter(pa.array(1 / (1 + np.exp(-odds)) >= ACCEPT))

    return docs.mapInArrow(keep, docs.schema)
