r"""Suffix-array dedup: bytes covered by 50-byte strings that a document with a smaller id has too.

A suffix array of all bytes would mean sorting every position. As in the difference-cover algorithm only
sampled positions are sorted, and all others are placed by the bytes up to their next sample and that
sample's name. The sample is a cover chosen by content: of every 50-byte window the 20-byte gram with the
smallest hash is its anchor. Equal windows have equal anchors at equal distance, so one class of samples
is enough to compare any two of them.

1. Grams of anchors are exchanged as packed arrays; only anchors whose gram occurs in two documents go on.
2. Around each of these, the bytes before and after the anchor are exchanged. The suffixes at the anchors are
   sorted as tuples of words and named; since adjacent ones know their common prefix, a name exists for
   every length. The reversed prefixes are named likewise.
3. The remaining window starts are merged in: a window is the pair of the name of what stands before its
   anchor and the name of what follows, so equal pairs are equal windows. The smallest id of each wins.

Every step first combines what a task has: a gram, window or passage that fills a third of all documents is
sent on once per task. Exact copies of a whole text are one document from the start.

Edge cases: a null or empty text has no bytes; texts shorter than a window lose nothing; rows with equal
ids are not smaller than each other; a row without id neither removes nor loses; an empty table stays
empty; columns other than doc_id and text are ignored. Memory: some packed megabytes per group, or the
longest text.
"""

from __future__ import annotations

import hashlib
import uuid
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexstats.llm import flat
from hexstats.llm.common import free_shuffles
from hexstats.sources.staging import shared_folder

LENGTH, GRAM = 50, 20
#: grams of a window; of a window's bytes, those before its anchor are at most one fewer
GRAMS = LENGTH - GRAM + 1
#: windows with less than this before the anchor are compared apart from the others
NEAR = 16
#: (bytes before the anchor, bytes from it) of either kind, and where in them the bytes lie that all windows share
KINDS = ((NEAR - 1, LENGTH, NEAR - 1, NEAR - 1 + LENGTH - NEAR + 1), (GRAMS - 1, LENGTH - NEAR, GRAMS - 1 - NEAR, GRAMS - 1 + GRAM))
WIDTH = max(before + after for before, after, _, _ in KINDS)
#: bytes of text that a task combines before it sends
COMBINED = 16 << 20
#: bytes of text per exchanged group of grams, and groups of bytes around anchors for each of those
PER_GROUP, FINER = 32 << 20, 8
BUCKET = 64 << 20

PACKED = "key int, docs binary, owner binary, content binary, start binary, mask binary"


def anchors(data: np.ndarray, offsets: np.ndarray):
    """(place, gram, first window, last window, text) of the anchors of all texts of a slice."""
    size = np.diff(offsets)
    none = np.zeros(0, np.int64)
    if not (size >= LENGTH).any():
        return none, none.astype(np.uint64), none, none, none
    sums = np.zeros(len(data) + 1, np.uint64)
    flat._grow(len(data) + 1)
    np.cumsum(flat._VALUES[data] * flat._powers[: len(data)], out=sums[1:])
    gram = flat.mixed((sums[GRAM:] - sums[:-GRAM]) * flat._inverses[: len(data) - GRAM + 1])
    bits = np.uint64(max(24, int(len(data)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    # the smallest hash, leftmost on ties, together with its place
    best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while 2 * width <= GRAMS:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    best = np.minimum(best[: len(best) - (GRAMS - width)], best[GRAMS - width :])
    count = np.maximum(size - LENGTH + 1, 0)
    windows = flat.spans(offsets[:-1], count)
    text = np.repeat(np.arange(len(size)), count)
    place = (best[windows] & low).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(windows)) - 1
    return place[begin], gram[place[begin]], windows[begin], windows[last], text[begin]


def _packed(key: int, docs, owner, content, start=b"", mask=b"") -> dict:
    raw = lambda x: x if isinstance(x, bytes) else np.ascontiguousarray(x).tobytes()
    return dict(key=key, docs=raw(docs), owner=raw(owner), content=raw(content), start=raw(start), mask=raw(mask))


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("key", pa.int32())] + [(n, pa.binary()) for n in ("docs", "owner", "content", "start", "mask")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in kinds], [n for n, _ in kinds])


def _owner_type(docs: int) -> type:
    return np.uint16 if docs < 1 << 16 else np.uint32


def _owners(docs: bytes, owner: bytes, width: int) -> np.ndarray:
    """The document (``width`` numbers) of each packed item."""
    table = np.frombuffer(docs, np.int64).reshape(-1, width)
    return table[np.frombuffer(owner, _owner_type(len(table)))]


def _tag(gram: np.ndarray) -> np.ndarray:
    return (gram >> np.uint64(32)).astype(np.uint32)


def _send_grams(groups: int):
    """Pack (gram, document) by the gram's hash; those found twice in one task are reported at once.

    The low bits of a hash choose the group, the high 32 stand for the gram within it. Two grams that are
    alike in both only make a few anchors too many candidates.
    """

    def flush(ids: np.ndarray, gram: np.ndarray, doc: np.ndarray, salt: int):
        order = np.lexsort((doc, gram))
        gram, doc = gram[order], doc[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (ids[doc[1:]] != ids[doc[:-1]])
        gram, doc = gram[new], doc[new]
        first = np.ones(len(gram), bool)
        first[1:] = gram[1:] != gram[:-1]
        begin = np.flatnonzero(first)
        often = np.repeat(np.diff(np.append(begin, len(gram))) > 1, np.diff(np.append(begin, len(gram))))
        if often.any():
            yield _packed(-1 - salt % groups, ids[doc[often]], b"", _tag(gram[often]))
        # one document tells the others; a second one if the gram is known to be shared
        second = np.zeros(len(gram), bool)
        second[1:] = first[:-1] & ~first[1:]
        gram, doc = gram[first | second], doc[first | second]
        key = (gram & np.uint64(groups - 1)).astype(np.int64)
        order = np.argsort(key, kind="stable")
        gram, doc, key = gram[order], doc[order], key[order]
        limits = np.searchsorted(key, np.arange(groups + 1))
        for k in range(groups):
            part = slice(limits[k], limits[k + 1])
            if limits[k] < limits[k + 1]:
                used, owner = np.unique(doc[part], return_inverse=True)
                # ascending numbers byte by byte: their high bytes hardly change, and compress
                planes = _tag(gram[part]).view(np.uint8).reshape(-1, 4).T
                yield _packed(k, ids[used], owner.astype(_owner_type(len(used))), planes)

    def send(batches):
        held, size = [], 0
        for batch in _then_none(batches):
            if batch is not None and batch.num_rows:
                ids = batch.column(0).to_numpy(zero_copy_only=False)
                for row, data, offsets in flat.slices(batch.column(1)):
                    _, gram, _, _, text = anchors(data, offsets)
                    held.append((ids[row : row + len(offsets) - 1], gram, text))
                    size += len(data)
            if held and (batch is None or size >= COMBINED):
                before = np.cumsum([0, *(len(i) for i, _, _ in held)])
                ids = np.concatenate([i for i, _, _ in held]).astype(np.int64)
                salt = int(ids[0]) & 0xFFFF
                gram = np.concatenate([g for _, g, _ in held])
                doc = np.concatenate([t + b for (_, _, t), b in zip(held, before, strict=False)])
                rows = list(flush(ids, gram, doc, salt))
                if rows:
                    yield _batch(rows)
                held, size = [], 0

    return send


def _then_none(batches):
    yield from batches
    yield None


def _shared_grams(group: pa.Table) -> pa.Table:
    """(doc_id, gram) of the grams of one group that several documents have."""
    docs, grams = [], []
    reported = group.column("key")[0].as_py() < 0
    for row in group.select(["docs", "owner", "content"]).to_pylist():
        if reported:
            docs.append(np.frombuffer(row["docs"], np.int64))
            grams.append(np.frombuffer(row["content"], np.uint32))
            continue
        docs.append(_owners(row["docs"], row["owner"], 1)[:, 0])
        planes = np.frombuffer(row["content"], np.uint8).reshape(4, -1)
        grams.append(np.ascontiguousarray(planes.T).view(np.uint32)[:, 0])
    doc, gram = np.concatenate(docs), np.concatenate(grams)
    if not reported:
        order = np.argsort(gram)
        doc, gram = doc[order], gram[order]
        begin = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
        several = np.minimum.reduceat(doc, begin) != np.maximum.reduceat(doc, begin)
        several = np.repeat(several, np.diff(np.append(begin, len(gram))))
        doc, gram = doc[several], gram[several]
    return pa.table({"doc_id": doc, "gram": gram.view(np.int32)})


def _names(content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): rows in lexicographic order, and the bytes each shares with the row before."""
    words = np.zeros((len(content), -(-content.shape[1] // 8) * 8), np.uint8)
    words[:, : content.shape[1]] = content
    words = words.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    differs = content[order[1:]] != content[order[:-1]]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), content.shape[1])
    return order, np.append(-1, common)


def _named(order: np.ndarray, common: np.ndarray, length: int) -> np.ndarray:
    """Number of each row's first ``length`` bytes among all different ones."""
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(common < length)
    return out


def lost(kind: int, doc: np.ndarray, content: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Which windows (bits of ``mask``) a document with a smaller id has too.

    Row r holds the bytes around an anchor of document ``doc[r]``; bit q stands for the window that
    begins at its q-th byte.
    """
    before, after, _, _ = KINDS[kind]
    follow = _names(content[:, before : before + after])
    lead = _names(content[:, :before][:, ::-1])
    out = np.zeros_like(mask)
    for q in range(before + after - LENGTH + 1):
        rows = np.flatnonzero(mask >> q & 1)
        if len(rows) < 2:
            continue
        ahead = before - q  # bytes of the window before the anchor
        pair = _named(*follow, LENGTH - ahead)[rows] * (len(mask) + 1) + _named(*lead, ahead)[rows]
        order = np.argsort(pair)
        begin = np.flatnonzero(np.append(True, np.diff(pair[order]) != 0))
        lowest = np.minimum.reduceat(doc[rows][order], begin)
        lowest = np.repeat(lowest, np.diff(np.append(begin, len(order))))
        out[rows[order][doc[rows][order] > lowest]] |= mask.dtype.type(1 << q)
    return out


def _around(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, wanted_text: np.ndarray):
    """Per kind (text, start, bytes, mask) around the anchors whose gram is wanted in their text."""
    place, gram, first, last, text = anchors(data, offsets)
    asked = np.unique(wanted_text.astype(np.uint64) << np.uint64(32) | wanted.view(np.uint32))
    own = text.astype(np.uint64) << np.uint64(32) | _tag(gram)
    at = np.minimum(np.searchsorted(asked, own), max(len(asked) - 1, 0))
    keep = asked[at] == own if len(asked) else np.zeros(len(own), bool)
    place, first, last, text = place[keep], first[keep], last[keep], text[keep]
    padded = np.concatenate([np.zeros(GRAMS, np.uint8), data, np.zeros(WIDTH, np.uint8)])
    for kind, (before, after, _, _) in enumerate(KINDS):
        # windows of this kind start at least ``least`` and at most ``before`` bytes ahead of the anchor
        least = 0 if kind == 0 else NEAR
        low, high = np.maximum(first, place - before), np.minimum(last, place - least)
        some = np.flatnonzero(low <= high)
        start = place[some] - before
        shift = (low[some] - start).astype(np.uint64)
        mask = ((np.uint64(1) << (high - low + 1)[some].astype(np.uint64)) - np.uint64(1) << shift).astype(np.uint16)
        content = np.zeros((len(some), WIDTH), np.uint8)
        content[:, : before + after] = padded[start[:, None] + GRAMS + np.arange(before + after)]
        yield kind, text[some], start - offsets[text[some]], content, mask


def _send_around(groups: int):
    """Pack the bytes around shared anchors by what all their windows have in common."""

    def flush(held: list, rows: np.ndarray):
        for kind, (_, _, begin, end) in enumerate(KINDS):
            doc, start, content, mask = (np.concatenate(x) for x in zip(*held[kind], strict=True))
            gone = lost(kind, rows[doc, 0], content, mask)
            yield from _report(rows, doc, start, gone, -1 - int(rows[0, 0] & 0xFFFF) % groups)
            mask = mask & ~gone
            left = mask > 0
            doc, start, content, mask = doc[left], start[left], content[left], mask[left]
            sums = flat._VALUES[content[:, begin:end]] * flat._powers[: end - begin]
            key = (flat.mixed(sums.sum(axis=1, dtype=np.uint64)) % np.uint64(groups)).astype(np.int64)
            order = np.argsort(key, kind="stable")
            limits = np.searchsorted(key[order], np.arange(groups + 1))
            for k in np.flatnonzero(np.diff(limits)).tolist():
                part = order[limits[k] : limits[k + 1]]
                used, owner = np.unique(doc[part], return_inverse=True)
                yield _packed(
                    2 * k + kind, rows[used], owner.astype(_owner_type(len(used))), content[part], start[part], mask[part]
                )

    def send(batches):
        flat._grow(WIDTH)
        held, rows, size = ([], []), [], 0
        for batch in _then_none(batches):
            if batch is not None and batch.num_rows:
                keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1).astype(np.int64)
                for row, data, offsets in flat.slices(batch.column(2)):
                    count = len(offsets) - 1
                    grams = batch.column(3).slice(row, count)
                    asked = grams.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                    owner = np.repeat(np.arange(count), np.diff(grams.offsets.to_numpy()))
                    base = sum(map(len, rows))
                    for kind, text, *more in _around(data, offsets, asked, owner):
                        held[kind].append((text + base, *more))
                    rows.append(keys[row : row + count])
                    size += len(data)
            if rows and (batch is None or size >= COMBINED):
                out = list(flush(held, np.concatenate(rows)))
                if out:
                    yield _batch(out)
                held, rows, size = ([], []), [], 0

    return send


def _report(rows: np.ndarray, doc: np.ndarray, start: np.ndarray, gone: np.ndarray, key: int):
    some = gone > 0
    if some.any():
        yield _packed(key, rows[doc[some]], b"", b"", start[some], gone[some])


def _lost_windows(group: pa.Table) -> pa.Table:
    """(doc_id, version, start, mask) of the windows of one group that a smaller id has too."""
    key = group.column("key")[0].as_py()
    rows, contents, starts, masks = [], [], [], []
    for row in group.to_pylist():
        starts.append(np.frombuffer(row["start"], np.int64))
        masks.append(np.frombuffer(row["mask"], np.uint16))
        if key < 0:
            rows.append(np.frombuffer(row["docs"], np.int64).reshape(-1, 2))
        else:
            rows.append(_owners(row["docs"], row["owner"], 2))
            contents.append(np.frombuffer(row["content"], np.uint8).reshape(-1, WIDTH))
    rows, start, mask = np.concatenate(rows), np.concatenate(starts), np.concatenate(masks)
    if key >= 0:
        mask = lost(key % 2, rows[:, 0], np.concatenate(contents), mask)
    some = mask > 0
    return pa.table(
        {"doc_id": rows[some, 0], "version": rows[some, 1], "start": start[some], "mask": mask[some].astype(np.int32)}
    )


def _by_document(docs: DataFrame) -> tuple[DataFrame, int]:
    """The texts as a table bucketed by doc_id, so that they are moved once for all joins; their bytes."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    name = f"texts_{uuid.uuid4().hex}"
    rows = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.sha2("text", 256).alias("digest"), "text"
    )
    # with fewer buckets than shuffle partitions Spark would move the texts again for the joins
    buckets = max(ceil(total / BUCKET), int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        rows.repartition(buckets, "doc_id")
        .write.bucketBy(buckets, "doc_id")
        .option("path", f"{shared_folder(spark).rstrip('/')}/{name}")
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    free_shuffles(spark)
    return spark.table(name), total


def _same_row(other: str) -> Column:
    """Equality of id and version in which only the id is a join key: the texts are bucketed by it
    alone, and are joined where they lie only if it is the whole key."""
    return (F.col("doc_id") == F.col(f"{other}_id")) & (F.col("version").bitwiseXOR(F.col(f"{other}_version")) == 0)


def removed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes."""
    texts, total = _by_document(docs)
    groups = 1 << max(0, ceil(total / PER_GROUP) - 1).bit_length()
    same = texts.groupBy("digest").agg(F.min("doc_id").alias("lowest"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    copies = (
        texts.select("doc_id", "version", "digest").join(same, "digest").filter(F.col("doc_id") > F.col("lowest"))
        .select("doc_id", "version").distinct()
    )
    copies = copies.select(F.col("doc_id").alias("copy_id"), F.col("version").alias("copy_version"))
    single = texts.join(copies, _same_row("copy"), "left_anti")
    grams = (
        single.select("doc_id", "text").mapInArrow(_send_grams(groups), PACKED).groupBy("key")
        .applyInArrow(_shared_grams, "doc_id long, gram int").groupBy("doc_id").agg(F.collect_list("gram").alias("grams"))
    )
    asked = single.join(grams, "doc_id").select("doc_id", "version", "text", "grams")
    windows = (
        asked.mapInArrow(_send_around(groups * FINER), PACKED).groupBy("key")
        .applyInArrow(_lost_windows, "doc_id long, version long, start long, mask int")
        .groupBy("doc_id", "version").agg(F.collect_list(F.struct(F.col("start"), F.col("mask"))).alias("lost"))
    )
    windows = windows.select(F.col("doc_id").alias("lost_id"), F.col("version").alias("lost_version"), "lost")
    marked = (
        texts.join(windows, _same_row("lost"), "left").join(copies, _same_row("copy"), "left")
        .select("doc_id", "text", F.col("copy_id").isNotNull().alias("copy"), "lost.start", "lost.mask")
    )
    nameless = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), "text", F.lit(False).alias("copy"),
        F.lit(None).cast("array<long>").alias("start"), F.lit(None).cast("array<int>").alias("mask"),
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return marked.unionByName(nameless).mapInArrow(_cut, schema)


def _cut(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        out = [[], [], [], [], []]
        for row, data, offsets in flat.slices(batch.column(1)):
            count = len(offsets) - 1
            start, mask = (batch.column(k).slice(row, count) for k in (3, 4))
            sizes = np.array([0 if s is None else s for s in pc.list_value_length(start).to_pylist()], np.int64)
            at = start.flatten().to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(offsets[:-1], sizes)
            bits = mask.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            cover = np.zeros(len(data) + 1, np.int64)
            for q in range(NEAR):
                begin = at[bits >> q & 1 > 0] + q
                np.add.at(cover, begin, 1)
                np.add.at(cover, begin + LENGTH, -1)
            size = np.diff(offsets)
            whole = np.flatnonzero(np.array(batch.column(2).slice(row, count).to_pylist(), bool) & (size >= LENGTH))
            np.add.at(cover, offsets[whole], 1)
            np.add.at(cover, offsets[whole] + size[whole], -1)
            gone = np.cumsum(cover)[:-1] > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            inner = offsets[:-1][offsets[:-1] < len(data)]
            opens[inner] = gone[inner]
            out[0].append(size)
            out[1].append(flat.per_text(gone, offsets))
            out[2].append(flat.per_text(opens, offsets))
            kept = data[~gone].tobytes()
            limits = np.append(0, np.cumsum(size - out[1][-1])).tolist()
            for begin, end in zip(limits[:-1], limits[1:], strict=True):
                out[3].append(hashlib.sha256(kept[begin:end]).hexdigest())
                out[4].append(kept[begin:end])
        numbers = [pa.array(np.concatenate(x).astype(np.int64)) for x in out[:3]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *numbers, pa.array(out[3], pa.string()), pa.array(out[4], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )
