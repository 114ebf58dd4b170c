r"""SentencePiece BPE encoding and decoding with vectorised merges.

Texts are cut between neighbours that stand together in no piece; each different part of a slice is
encoded once. All parts of a batch lie in one flat array of symbols. In every round each part finds
the best pair that forms a piece and merges its occurrences from left to right, as long as no merge
makes a still better pair; the array is then compacted. The result is the one that merging one pair at
a time, best first, leftmost first, gives.

Edge cases: a null or empty text has only the end id; characters without a piece become bytes; bytes
that are no valid UTF-8 decode to U+FFFD; other columns are ignored, repeated rows are coded alike, an
empty table stays empty. Memory: a slice of half a megabyte of text, or the longest text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from hexstats.llm import flat
from hexstats.llm.common import map_texts

SPACE = "▁"
SCHEMA = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string, decoded string"
SLICE_BYTES = 1 << 19
_NONE = np.iinfo(np.int64).max
_CODE_POINTS = 0x110000


class PairTable:
    """Rank of each pair of pieces that forms a piece: a hash table for whole arrays of pairs."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray, bits: int = 19):
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int64)
        self.probes = 0
        at = self._slot(keys)
        while len(keys):
            self.probes += 1
            free = np.flatnonzero(self.keys[at] < 0)
            _, one = np.unique(at[free], return_index=True)  # one key per free slot
            placed = free[one]
            self.keys[at[placed]], self.ranks[at[placed]] = keys[placed], ranks[placed]
            left = np.ones(len(keys), bool)
            left[placed] = False
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & ((1 << bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], _NONE)
        open_ = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            here = self.keys[at[open_]]
            hit = here == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
        return out


class Vocabulary:
    """Pieces of a model file, which pairs of them form a third, and where texts can be cut."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = model.get_piece_size()
        self.end = model.eos_id()
        text = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        by_text = {text[i]: i for i in plain}
        # better pieces first: the rank of a pair is that of the piece it forms
        order = sorted(plain, key=lambda i: (-model.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        self.piece_of_rank = np.array(order, np.int64)
        pairs = {
            (by_text[piece[:k]] * n + by_text[piece[k:]]): rank[i]
            for piece, i in by_text.items()
            for k in range(1, len(piece))
            if piece[:k] in by_text and piece[k:] in by_text
        }
        self.pairs = PairTable(np.array([*pairs], np.int64), np.array([*pairs.values()], np.int64))
        # a character that is no piece is a symbol beyond the pieces and never merges
        self.symbol = n + np.arange(_CODE_POINTS, dtype=np.int64)
        for piece, i in by_text.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        # neighbours that stand together in no piece can never end up in one
        inner = sorted({c for piece in by_text if len(piece) > 1 for c in piece})
        self.letter = np.zeros(_CODE_POINTS, np.int32)
        self.letter[[ord(c) for c in inner]] = np.arange(1, len(inner) + 1)
        self.letters = len(inner) + 1
        joined = np.zeros(self.letters**2, bool)
        for piece in by_text:
            at = self.letter[[ord(c) for c in piece]].astype(np.int64)
            joined[at[:-1] * self.letters + at[1:]] = True
        self.joined = np.packbits(joined, bitorder="little")

        self.byte_ids = np.zeros(256, np.int64)
        decoded = []
        for i in range(n):
            if model.is_byte(i):
                value = int(text[i][1:-1], 16)
                self.byte_ids[value] = i
                decoded.append(bytes([value]))
            elif model.is_control(i):
                decoded.append(b"")
            else:
                decoded.append(" ⁇ ".encode() if model.is_unknown(i) else text[i].replace(SPACE, " ").encode())
        self.decoded = np.frombuffer(b"".join(decoded), np.uint8)
        self.decoded_length = np.array([len(d) for d in decoded], np.int64)
        self.decoded_start = np.cumsum(self.decoded_length) - self.decoded_length
        self.spaced = np.array([t.startswith(SPACE) for t in text])
        self.decimal = np.array([str(i).encode() for i in range(n)], object)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece each pair forms; a large number if none."""
        found = self.pairs.find(left * self.size + right)
        return np.where((left < self.size) & (right < self.size), found, _NONE)

    def cuts(self, codes: np.ndarray) -> np.ndarray:
        """Whether a text can be cut before each character."""
        letter = self.letter[codes].astype(np.int64)
        key = letter[:-1] * self.letters + letter[1:]
        out = np.ones(len(codes), bool)
        out[1:] = (self.joined[key >> 3] >> (key & 7).astype(np.uint8)) & 1 == 0
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _merge_all(vocab: Vocabulary, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge until no pair of neighbours in the same part forms a piece; (symbols, part)."""
    finished: list[tuple[np.ndarray, np.ndarray]] = []
    while len(symbols):
        together = part[1:] == part[:-1]
        ranks = np.where(together, vocab.ranks(symbols[:-1], symbols[1:]), _NONE)
        firsts = np.flatnonzero(np.concatenate([[True], ~together]))
        best = np.minimum.reduceat(np.append(ranks, _NONE), firsts)
        lengths = np.diff(np.append(firsts, len(symbols)))
        open_ = np.repeat(best < _NONE, lengths)
        if not open_.all():
            finished.append((symbols[~open_], part[~open_]))
            keep = open_
            symbols, part, ranks = symbols[keep], part[keep], np.append(ranks, _NONE)[keep][:-1]
            if not len(symbols):
                break
            ranks = np.where(part[1:] == part[:-1], ranks, _NONE)
            best, lengths = best[best < _NONE], lengths[best < _NONE]
        goal = np.repeat(best, lengths)
        at = np.flatnonzero(ranks == goal[:-1])
        # of overlapping occurrences (aaa) every second one, counted from the left
        run = np.cumsum(np.concatenate([[True], np.diff(at) > 1]))
        begin = at[np.searchsorted(run, run)]
        at = at[(at - begin) % 2 == 0]
        made = vocab.piece_of_rank[goal[at]]
        # neighbours as they are when this occurrence is merged: those to the left are merged already
        size = len(symbols)
        left_merged = np.zeros(len(at), bool)
        left_merged[1:] = (np.diff(at) == 2) & (part[at[1:]] == part[at[:-1]])
        left = np.where(left_merged, np.concatenate([[0], made[:-1]]), symbols[np.maximum(at - 1, 0)])
        has_left = (at > 0) & (part[np.maximum(at - 1, 0)] == part[at])
        after = np.minimum(at + 2, size - 1)
        has_right = (at + 2 < size) & (part[after] == part[at])
        new = np.minimum(
            np.where(has_left, vocab.ranks(left, made), _NONE), np.where(has_right, vocab.ranks(made, symbols[after]), _NONE)
        )
        # a better pair comes first: later occurrences in this part wait for the next round
        better = new < goal[at]
        if better.any():
            owner = part[at]
            group = np.searchsorted(owner, owner)  # first occurrence of the same part
            seen = np.cumsum(better) - better
            at, made = (x[seen - seen[group] == 0] for x in (at, made))
        symbols[at] = made
        keep = np.ones(size, bool)
        keep[at + 1] = False
        symbols, part = symbols[keep], part[keep]
    if not finished:
        return symbols, part
    symbols, part = (np.concatenate(x) for x in zip(*finished, strict=True))
    order = np.argsort(part, kind="stable")
    return symbols[order], part[order]


def _with_bytes(vocab: Vocabulary, symbols: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replace characters without a piece by their bytes."""
    loose = np.flatnonzero(symbols >= vocab.size)
    if not len(loose):
        return symbols, part
    as_bytes = [vocab.byte_ids[list(chr(c).encode())] for c in (symbols[loose] - vocab.size).tolist()]
    times = np.ones(len(symbols), np.int64)
    times[loose] = [len(b) for b in as_bytes]
    spread = np.repeat(symbols, times)
    spread[spread >= vocab.size] = np.concatenate(as_bytes)
    return spread, np.repeat(part, times)


def encode(vocab: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts back to back, limits of each), an end id after each text."""
    codes, limits = flat.characters(data, offsets)
    filled = np.flatnonzero(np.diff(limits))
    codes = np.insert(codes, limits[filled], 32)  # a space goes in front of each text
    limits = limits + np.searchsorted(filled, np.arange(len(limits)))
    codes[codes == 32] = ord(SPACE)
    cut = vocab.cuts(codes)
    cut[limits[:-1][limits[:-1] < len(codes)]] = True
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.append(starts, len(codes)))
    # each different part is encoded once
    which, different = pd.factorize(flat.sequence_hashes(flat.mixed(codes.astype(np.uint64)), starts, starts + lengths))
    sample = np.zeros(len(different), np.int64)
    sample[which] = np.arange(len(which))
    symbols = vocab.symbol[codes[flat.spans(starts[sample], lengths[sample])]]
    merged = _merge_all(vocab, symbols, np.repeat(np.arange(len(sample)), lengths[sample]))
    symbols, part = _with_bytes(vocab, *merged)
    begin = np.searchsorted(part, np.arange(len(sample) + 1))
    size = np.diff(begin)[which]
    ids = symbols[flat.spans(begin[which], size)]
    ends = np.append(0, np.cumsum(size))[np.searchsorted(starts, limits)]
    return np.insert(ids, ends[1:], vocab.end).astype(np.int32), ends + np.arange(len(ends))


def decode(vocab: Vocabulary, ids: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts back to back, limits of each) of lists of ids."""
    lengths = vocab.decoded_length[ids].copy()
    starts = vocab.decoded_start[ids].copy()
    # the space that encoding puts in front goes again
    first = limits[:-1][np.diff(limits) > 0]
    first = first[vocab.spaced[ids[first]]]
    starts[first] += 1
    lengths[first] -= 1
    return vocab.decoded[flat.spans(starts, lengths)], np.append(0, np.cumsum(lengths))[limits]


def coded(docs: DataFrame, model: str, texts: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, the ids and, if ``texts``, the decoded text.

    ``model`` is the path of a model file that all executors have.
    """

    def code(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for first, data, offsets in flat.slices(batch.column(1), SLICE_BYTES):
            ids, limits = encode(vocab, data, offsets)
            words = vocab.decimal[ids].tolist()
            hashes = [hashlib.sha256(b" ".join(words[begin:end])).hexdigest() for begin, end in pairwise(limits.tolist())]
            content, at = decode(vocab, ids, limits)
            decoded = [content[begin:end].tobytes().decode("utf-8", "replace") for begin, end in pairwise(at.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(offsets) - 1).cast(pa.int64()),
                    pa.array(np.diff(limits), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array(hashes, pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                    pa.array(decoded if texts else [None] * len(decoded), pa.string()),
                ],
                ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "decoded"],
            )

    return map_texts(docs, code, SCHEMA, "doc_id", "text")
