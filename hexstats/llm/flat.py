"""Texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.

All functions work on a slice of a batch: ``data`` holds the UTF-8 bytes of some texts back to back
and ``offsets`` their limits. Slices hold a quarter of a megabyte, so the temporary arrays of a task stay
small whatever the batch; only a single longer text makes a longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
#: base of the polynomial hash; 3 mod 8, so that its powers differ in as many low bits as they can
_BASE = 0x9E3779B97F4A7C13
_MASK = (1 << 64) - 1
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, data, offsets) of runs of rows with at most ``most`` bytes; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, limits, content = texts.buffers()
    offsets = np.frombuffer(limits, np.int64)[texts.offset : texts.offset + len(texts) + 1] if limits else np.zeros(1, np.int64)
    data = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1, first + 1)
        last = min(last, len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def table(inside: str | bytes | list[int]) -> np.ndarray:
    """Truth for each byte value."""
    out = np.zeros(256, bool)
    out[list(inside.encode() if isinstance(inside, str) else inside)] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: bytes of words in the sense of [^\x20\x09-\x0D]+
NOT_SPACE = ~table(b" \t\n\x0b\x0c\r")
#: bytes of words in the sense of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z is lower-cased
LETTER_OR_DIGIT = table(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each text): maximal runs of bytes in ``inside``, not across texts."""
    own = inside[data]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = own[:-1]
    before[cuts] = False
    after = np.zeros(len(data), bool)
    after[:-1] = own[1:]
    after[cuts - 1] = False
    starts = np.flatnonzero(own & ~before)
    return starts, np.flatnonzero(own & ~after) + 1, np.searchsorted(starts, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64 bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUES_LOWER = _VALUES[LOWER]


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, SLICE_BYTES + 1)
        for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
            factors = np.full(n, base & _MASK, np.uint64)
            factors[0] = 1
            globals()[name] = np.cumprod(factors)


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of 64-bit values, the same for the same values wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _grow(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[: len(values)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each span of bytes; ``lower`` takes A-Z for a-z."""
    return sequence_hashes((_VALUES_LOWER if lower else _VALUES)[data], starts, ends)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all items of the given runs, run after run."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - lengths), lengths)


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, limits of each text among them)."""
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=before[1:])
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), before[offsets]


def word_hash(word: str) -> int:
    """The hash ``span_hashes`` gives to this word."""
    data = np.frombuffer(word.encode(), np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of each run of ``n`` consecutive words within a text.

    ``hashes`` belongs to the words in order, ``first`` has the first word of each text and, last,
    the number of words.
    """
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = mixed(out + hashes[k : k + count] + np.uint64(k + 1))
    text = owners(first, len(hashes))
    whole = text[:count] == text[n - 1 :]
    return out[whole], text[:count][whole]


def owners(first: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` items the text it belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over the items of each text."""
    sums = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
