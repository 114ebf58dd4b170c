r"""Quality rules: counted signals with fixed limits, then a trained verdict.

The verdict is a logistic regression on hashed word and character n-grams, fitted on a bounded
sample of labelled documents and calibrated on another part of it. Every text is scored whole, in
Arrow batches: the score of a text is the mean weight of its n-grams of each kind.

Edge cases: a null or empty text has no words and fails the base rules; without labels of both
kinds the verdict is the share of good labels (keep, if there are none); rows are judged on their
own, so repeated rows and ties are judged alike; an empty table stays empty; other columns are
ignored. Memory is bounded by a slice of a quarter of a megabyte of text, or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats.llm import flat
from hexstats.llm.common import map_texts, training_rows

MIN_WORDS = 50
#: per cent of the words that may stand in windows found more than once
MAX_REPEATED = 50
WINDOW = 3
SYMBOLS = flat.table("#*$%&|<>")
#: slots of the hashed n-grams
SLOTS = 1 << 17
#: probability of good quality from which a document is kept
KEEP = 0.5
#: labelled documents of each kind that are fitted on, and the longest that are (bytes)
SAMPLE, LONGEST = 1500, 32_000
#: share of the sample that calibrates
CALIBRATION = 0.25
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, " + ", ".join(f"{s} long" for s in SIGNALS) + ", probability double"


def signals(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counted signals of each text of a slice."""
    starts, ends, first = flat.words(data, offsets, flat.NOT_SPACE)
    hashes = flat.span_hashes(data, starts, ends)
    texts = len(offsets) - 1
    begins = np.zeros(len(data) + 1, np.int64)  # code points before each byte
    np.cumsum((data & 0xC0) != 0x80, out=begins[1:])
    return {
        "n_words": np.diff(first),
        "word_chars": flat.per_text(begins[ends] - begins[starts], first),
        "n_symbols": flat.per_text(SYMBOLS[data], offsets),
        "n_dup_lines": _repeated_lines(data, offsets, starts),
        "n_repeat_words": _repeated_words(hashes, first, texts),
    }


def _keys(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts, so that one sort serves all texts of a slice."""
    return flat.mixed(hashes ^ flat.mixed(text.astype(np.uint64) + np.uint64(1)))


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> np.ndarray:
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(offsets[:-1], breaks + 1)
    starts = starts[starts < len(data)]
    line_end = np.append(breaks, len(data))[np.searchsorted(breaks, starts)]
    ends = np.minimum(line_end, offsets[np.searchsorted(offsets, starts, "right")])
    worded = np.searchsorted(words, ends) > np.searchsorted(words, starts)
    starts, ends = starts[worded], ends[worded]
    text = np.searchsorted(offsets, starts, "right") - 1
    keys = _keys(flat.span_hashes(data, starts, ends), text)
    _, at = np.unique(keys, return_index=True)
    texts = len(offsets) - 1
    return np.bincount(text, minlength=texts) - np.bincount(text[at], minlength=texts)


def _repeated_words(hashes: np.ndarray, first: np.ndarray, texts: int) -> np.ndarray:
    owner = flat.owners(first, len(hashes))
    count = len(hashes) - WINDOW + 1
    if count <= 0:
        return np.zeros(texts, np.int64)
    found, text = flat.windows(hashes, first, WINDOW)
    at = np.flatnonzero(owner[:count] == owner[WINDOW - 1 :])
    _, inverse, times = np.unique(_keys(found, text), return_inverse=True, return_counts=True)
    covered = np.zeros(len(hashes), bool)
    for k in range(WINDOW):
        covered[at[times[inverse] > 1] + k] = True
    return flat.per_text(covered, first)


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(slot of each n-gram, first n-gram of each text) per kind: words, word pairs, characters."""
    starts, ends, first = flat.words(data, offsets, flat.NOT_SPACE)
    hashes = flat.span_hashes(data, starts, ends)
    out = [(hashes, first)]
    pairs, text = flat.windows(hashes, first, 2)
    out.append((pairs, np.searchsorted(text, np.arange(len(offsets)))))
    chars, limits = flat.characters(data, offsets)
    for n in (2, 4):
        grams, text = flat.windows(chars.astype(np.uint64), limits, n)
        out.append((grams, np.searchsorted(text, np.arange(len(offsets)))))
    mask = np.uint64(SLOTS - 1)
    return [((grams + np.uint64(kind)) & mask, f) for kind, (grams, f) in enumerate(out)]


@dataclass
class Model:
    """Weights by kind of n-gram and slot; ``scale`` and ``shift`` turn a sum into a log-odds."""

    weights: np.ndarray
    scale: float
    shift: float

    def probability(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.zeros(len(offsets) - 1)
        if self.scale:
            for weights, (slots, first) in zip(self.weights, features(data, offsets), strict=True):
                total += flat.per_text(weights[slots].astype(np.float64), first) / np.maximum(np.diff(first), 1)
        return 1 / (1 + np.exp(-np.clip(self.scale * total + self.shift, -30, 30)))


def _log_odds(share: float) -> float:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def platt(scores: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(scale, shift) of the logistic curve through scored, weighted rows; Newton's method."""
    scale, shift = 1.0, 0.0
    # targets slightly inside 0 and 1 keep the curve finite for separable rows
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(scale * scores + shift, -30, 30)))
        d, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        hess = np.array([[(h * scores * scores).sum() + 1e-3, (h * scores).sum()], [(h * scores).sum(), h.sum() + 1e-3]])
        step = np.linalg.solve(hess, np.array([(d * scores).sum() + 1e-3 * scale, d.sum()]))
        scale, shift = scale - float(np.clip(step[0], -2, 2)), shift - float(np.clip(step[1], -2, 2))
    return max(scale, 1e-3), shift


def fit(texts: list[str], good: np.ndarray, share_good: float, rounds: int = 60) -> Model:
    """Fit on texts with their labels; ``share_good`` is that of all labels, for calibration."""
    none = np.zeros((4, SLOTS), np.float32)
    if not (good.any() and (~good).any()):
        return Model(none, 0.0, _log_odds(share_good))
    parts = [[] for _ in none]
    for first_row, data, offsets in flat.slices(pa.array(texts, pa.string())):
        for kind, (slots, first) in enumerate(features(data, offsets)):
            row = flat.owners(first, len(slots)) + first_row
            code, times = np.unique(row * SLOTS + slots.astype(np.int64), return_counts=True)
            value = times / np.maximum(np.diff(first), 1)[code // SLOTS - first_row]
            parts[kind].append((code // SLOTS, code % SLOTS, value))
    rows, slots, values = (
        [np.concatenate([p[k] for p in kind]) for kind in parts] for k in range(3)
    )
    calibrating = np.arange(len(texts)) % round(1 / CALIBRATION) == 0
    fitting = (~calibrating) / np.where(good, (good & ~calibrating).sum() or 1, (~good & ~calibrating).sum() or 1)
    weights, m, v, bias = none.astype(np.float64), none.astype(np.float64), none.astype(np.float64), 0.0

    def total() -> np.ndarray:
        return sum(
            np.bincount(r, w[s] * x, minlength=len(texts)) for w, r, s, x in zip(weights, rows, slots, values, strict=True)
        )

    for step in range(1, rounds + 1):
        error = fitting * (1 / (1 + np.exp(-np.clip(total() + bias, -30, 30))) - good)
        bias -= 0.5 * error.sum()
        for kind in range(len(weights)):
            slope = np.bincount(slots[kind], values[kind] * error[rows[kind]], minlength=SLOTS) + 1e-7 * weights[kind]
            m[kind] = 0.9 * m[kind] + 0.1 * slope
            v[kind] = 0.99 * v[kind] + 0.01 * slope * slope
            weights[kind] -= 0.3 * (m[kind] / (1 - 0.9**step)) / (np.sqrt(v[kind] / (1 - 0.99**step)) + 1e-8)
    scores = total() + bias
    use = calibrating if good[calibrating].any() and (~good[calibrating]).any() else ~calibrating
    natural = np.where(good, share_good / good[use].sum(), (1 - share_good) / (~good[use]).sum())[use]
    scale, shift = platt(scores[use], good[use], natural * use.sum())
    return Model(weights.astype(np.float32), scale, shift + scale * bias)


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of these labels; what reaches the driver is bounded by SAMPLE and LONGEST."""
    counts = labels.agg(F.avg(F.when(F.col("quality").isin(0, 1), F.col("quality"))).alias("share")).first()
    rows = training_rows(docs, labels, SAMPLE, LONGEST).toPandas()
    rows = rows.sort_values(["doc_id", "text"], ignore_index=True)
    share = 1.0 if counts["share"] is None else float(counts["share"])
    return fit(rows["text"].tolist(), rows["quality"].to_numpy() == 1, share)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the signals, and the calibrated probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the data

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = {name: [] for name in (*SIGNALS, "probability")}
        for _, data, offsets in flat.slices(batch.column(1)):
            for name, values in signals(data, offsets).items():
                found[name].append(values)
            found["probability"].append(shared.value.probability(data, offsets))
        columns = [pa.array(np.concatenate(v).astype(float if k == "probability" else np.int64)) for k, v in found.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], ["doc_id", *found])

    return map_texts(docs, score, SCHEMA, "doc_id", "text")


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """Signals, base_failed, probability and kept of every document."""
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n)
    return scored(docs, model).withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("probability") >= KEEP)
    )
