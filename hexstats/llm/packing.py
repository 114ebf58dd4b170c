"""Packing documents into sequences of bounded length, in order, with little padding.

Documents are encoded and laid end to end in the order of their rows. Windows are cut so that the sum of
costs is least: the padding of each window, a price per window, and a penalty for where it ends, none at
the end of a document, little at the end of a sentence, more anywhere else (every few tokens). A window is
padded to the full length unless it ends a document at a length that is a power of two. The cheapest cuts
come from a dynamic programme over the places where a cut may be; the best start of a window that is not
too long is the head of a monotone queue.

Rows stay where they are: each task packs its own documents, about a million tokens at a time, so nothing
is shuffled and a lost task is repeated alike.

Edge cases: a null or empty text has only the end id; a longer text than a window is cut; rows with equal
or null doc_id are documents of their own; other columns are ignored; an empty table stays empty. Memory:
a million tokens, or the longest text.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hexstats.llm import flat

WINDOW = 2048
END_ID = 1
#: tokens a window costs, a cut after a sentence, and a cut elsewhere, which is possible every STEP tokens
WINDOW_COST, SENTENCE_COST, TOKEN_COST, STEP = 64, 4, 24, 16
#: tokens that are packed together
CHUNK = 1 << 20
SLICE_BYTES = 1 << 19
#: words whose ids a worker remembers
REMEMBERED = 1 << 20
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ends string, ids binary"

# Fixed value: the split pattern for which texts may be cut as below.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_OTHER, _LETTER, _DIGIT, _SYMBOL, _QUOTE = range(5)
_KIND = np.zeros(256, np.int8)
_KIND[33:127] = _SYMBOL
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[ord("|")] = _OTHER  # inside the names of special tokens
_KIND[ord("'")] = _QUOTE
#: whether two neighbouring bytes of these kinds always belong to different words of the pattern
_APART = np.zeros((5, 5), bool)
_APART[_LETTER, [_DIGIT, _SYMBOL, _QUOTE]] = True
_APART[_DIGIT, [_LETTER, _DIGIT, _SYMBOL, _QUOTE]] = True
_APART[_SYMBOL, [_LETTER, _DIGIT]] = True
_APART[_QUOTE, _DIGIT] = True


class Encoder:
    """Ids of texts by a tokenizer file; each different word is encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        self.whole = Tokenizer.from_file(path)
        names = self.whole.get_vocab()
        self.ends_word = np.zeros(max(names.values()) + 1, bool)
        self.ends_sentence = np.zeros(max(names.values()) + 1, bool)
        suffix = layout["model"].get("end_of_word_suffix") or ""
        for name, at in names.items():
            self.ends_word[at] = bool(suffix) and name.endswith(suffix)
            bare = name.removesuffix(suffix) if suffix else name
            self.ends_sentence[at] = bool(bare.rstrip("\"')]}")) and bare.rstrip("\"')]}")[-1] in ".!?"
        split = layout.get("pre_tokenizer") or {}
        parts = split.get("pretokenizers", [])
        #: whether texts may be encoded word by word
        self.by_word = bool(suffix) and bool(parts) and parts[0].get("pattern") == {"Regex": PATTERN} and parts[0].get("invert") is True
        # for runs of letters nothing has to be split but the spaces between them
        spaced = {**split, "pretokenizers": [{"type": "WhitespaceSplit"}, *parts[1:]]}
        self.letters = Tokenizer.from_str(json.dumps({**layout, "pre_tokenizer": spaced, "added_tokens": []})) if self.by_word else None
        self._forget()

    def _forget(self) -> None:
        self.known, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts back to back, limits of each), an end id after each text."""
        ids, limits = self._by_word(data, offsets) if self.by_word else self._each(_texts(data, offsets[:-1], offsets[1:]))
        return np.insert(ids, limits[1:], END_ID).astype(np.int32), limits + np.arange(len(limits))

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, np.int32) for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *found]), np.append(0, np.cumsum([len(x) for x in found])).astype(np.int64)

    def _by_word(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _KIND[data]
        # letters of two bytes that begin with C3, all but the signs for times and divided by
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)) + 1
        kind[second] = kind[second - 1] = _LETTER
        starts, ends, _ = flat.words(data, offsets, flat.NOT_SPACE)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = _APART[kind[:-1], kind[1:]]
        cut[offsets] = False
        extra = np.flatnonzero(cut)
        starts, ends = (np.sort(np.concatenate([x, extra])) for x in (starts, ends))
        raw = data.tobytes()
        # names of special tokens differ by case, other words don't
        hashes = flat.span_hashes(data, starts, ends, lower=b"<|" not in raw)
        which, different = pd.factorize(hashes)
        sample = np.zeros(len(different), np.int64)
        sample[which] = np.arange(len(which))
        if len(self.known) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.known, different)
        new = np.ones(len(different), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != different[inside]
        if new.any():
            rows = sample[new]
            odd = np.append(0, np.cumsum(kind != _LETTER))
            plain = odd[starts[rows]] == odd[ends[rows]]
            self._learn(different[new][plain], _words(raw, starts, ends, rows[plain]), letters=True)
            self._learn(different[new][~plain], _words(raw, starts, ends, rows[~plain]), letters=False)
            at = np.searchsorted(self.known, different)
        size = self.size[at][which] if len(different) else np.zeros(0, np.int64)
        begin = self.begin[at][which] if len(different) else size
        limits = np.append(0, np.cumsum(size))[np.searchsorted(starts, offsets)]
        return self.ids[flat.spans(begin, size)], limits

    def _learn(self, hashes: np.ndarray, words: list[str], letters: bool) -> None:
        if not words:
            return
        ids, limits = self._spaced(words) if letters else self._each(words)
        begin, size = limits[:-1] + len(self.ids), np.diff(limits)
        self.ids = np.concatenate([self.ids, ids])
        order = np.argsort(hashes)
        place = np.searchsorted(self.known, hashes[order])
        self.known = np.insert(self.known, place, hashes[order])
        self.begin = np.insert(self.begin, place, begin[order])
        self.size = np.insert(self.size, place, size[order])

    def _spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of letters, encoded many at a time: each ends with the one id that ends a word."""
        lines = [" ".join(words[k : k + 500]) for k in range(0, len(words), 500)]
        ids, _ = _flat_ids(self.letters.encode_batch_fast(lines, add_special_tokens=False))
        last = np.flatnonzero(self.ends_word[ids]) + 1
        if len(last) != len(words):  # a vocabulary with another notion of words
            return self._each(words)
        return ids, np.append(0, last)


def _flat_ids(found: list) -> tuple[np.ndarray, np.ndarray]:
    rows = [np.array(e.ids, np.int32) for e in found]
    return np.concatenate(rows), np.append(0, np.cumsum([len(x) for x in rows]))


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _words(raw: bytes, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> list[str]:
    return [raw[a:b].decode() for a, b in zip(starts[rows].tolist(), ends[rows].tolist(), strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def places(ids: np.ndarray, limits: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions where a cut may be, penalty of each) of documents laid end to end."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    begin = np.repeat(limits[:-1], np.diff(limits))
    penalty[:-1][(np.arange(len(ids)) - begin) % STEP == 0] = TOKEN_COST
    penalty[1:][ends_sentence[ids]] = SENTENCE_COST
    penalty[limits] = 0
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def cheapest_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Indices into ``at`` of the ends of the windows with the least total cost.

    The cost of a window is its padding, ``WINDOW_COST`` and the penalty of its end. A start i of a
    window that ends at j costs f(i) + window - (at[j] - at[i]), so the best start is the one
    with the least f(i) + at[i] among those not too far back: the head of a queue whose values
    rise, in which a start drops out when a later one is no dearer.
    """
    place, price = at.tolist(), penalty.tolist()
    # windows without padding that end a document
    shorter: dict[int, list[int]] = {}
    free = np.flatnonzero(penalty == 0)
    for k in range((window - 1).bit_length()):
        before = at[free] - (1 << k)
        i = np.searchsorted(at, before)
        there = (before >= 0) & (at[np.minimum(i, len(at) - 1)] == before)
        for j, start in zip(free[there].tolist(), i[there].tolist(), strict=True):
            shorter.setdefault(j, []).append(start)
    cost, value, come = [0] * len(place), [0] * len(place), [0] * len(place)
    value[0] = place[0]
    queue = deque([0])
    for j in range(1, len(place)):
        here = place[j]
        while place[queue[0]] < here - window:
            queue.popleft()
        best = queue[0]
        least = value[best] + window - here
        if j in shorter:
            for i in shorter[j]:
                if cost[i] < least:
                    best, least = i, cost[i]
        least += price[j] + WINDOW_COST
        cost[j], come[j] = least, best
        value[j] = own = least + here
        while queue and value[queue[-1]] >= own:
            queue.pop()
        queue.append(j)
    cuts, j = [], len(place) - 1
    while j > 0:
        cuts.append(j)
        j = come[j]
    return np.array(cuts[::-1], np.int64)


def _pieces(doc_ids: pa.Array, ids: np.ndarray, limits: np.ndarray, ends_sentence: np.ndarray, first: int) -> tuple[pa.RecordBatch, int]:
    """Pieces of documents laid end to end, and how many sequences they fill."""
    at, penalty = places(ids, limits, ends_sentence)
    cuts = cheapest_cuts(at, penalty)
    windows = np.append(0, at[cuts])
    edges = np.union1d(windows, limits)
    begin, end = edges[:-1], edges[1:]
    doc = np.searchsorted(limits, begin, "right") - 1
    window = np.searchsorted(windows, begin, "right") - 1
    kinds = np.array(["token", "sentence", "document"])
    how = np.where(limits[doc + 1] == end, 2, ends_sentence[ids[end - 1]].astype(int))
    size = pa.array(np.append(0, edges[1:] * 4), pa.int32())
    blobs = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, size.buffers()[1], pa.py_buffer(ids.astype("<u4").tobytes())])
    return pa.RecordBatch.from_arrays(
        [
            doc_ids.take(pa.array(doc)).cast(pa.int64()), pa.array(begin - limits[doc]), pa.array(end - begin),
            pa.array(np.diff(limits)[doc]), pa.array(first + window), pa.array(begin - windows[window]),
            pa.array(kinds[how], pa.string()), blobs,
        ],
        ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ends", "ids"],
    ), len(windows) - 1


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset in the
    sequence, how the piece ends (document, sentence or token), and its ids as little-endian
    32-bit numbers.

    ``tokenizer`` is the path of a tokenizer file that all executors have.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        first = TaskContext.get().partitionId() << 36
        names, held, sizes, tokens = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal first, tokens
            if names:
                limits = np.append(0, np.cumsum(np.concatenate(sizes)))
                batch, used = _pieces(pa.concat_arrays(names), np.concatenate(held), limits, code.ends_sentence, first)
                yield batch
                first += used
                names.clear(), held.clear(), sizes.clear()
                tokens = 0

        for batch in batches:
            for row, data, offsets in flat.slices(batch.column(1), SLICE_BYTES):
                ids, limits = code.encode(data, offsets)
                names.append(batch.column(0).slice(row, len(limits) - 1))
                held.append(ids)
                sizes.append(np.diff(limits))
                tokens += len(ids)
                if tokens >= CHUNK:
                    yield from flush()
        yield from flush()

    return docs.select("doc_id", "text").mapInArrow(over, SCHEMA)
