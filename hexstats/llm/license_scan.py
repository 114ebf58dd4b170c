r"""License scans: fixed phrases, and licence texts found by a positional index of rare words.

A first pass counts in how many documents each word of the licence texts occurs. Each licence text is
then indexed by the places of its rarest words, just so many that one of them must stand in its place
wherever enough words agree. In the second pass the words of a document that are in the index look up
their postings; hits whose places in text and document differ by the same amount are one alignment of
that text. Alignments are compared word by word, and the label is given when enough words agree and
the text's mandatory phrases stand within the aligned stretch. No candidate is left out.

Edge cases: a null or empty text has no words, labels or places, and score 0; a document takes
the best agreement of all alignments; repeated rows are scanned alike; an empty table stays empty; other
columns are ignored. The index and the counts are as large as the licence texts, whatever the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexstats.llm import flat
from hexstats.llm.common import map_texts

#: fixed values: phrases and the labels they give wherever their words stand consecutively
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: fixed values: wording of public licences and notices, with the phrases that must occur
TEMPLATES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http "
        "www apache org licenses license 2 0",
        ("apache org licenses license 2",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    (
        "cc-by-nc",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        ("creative commons attribution noncommercial",),
    ),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4",),
    ),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    (
        "cc0",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
        "this work",
        ("waived all copyright",),
    ),
    ("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation",
        ("gnu general public license", "free software foundation"),
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("source and binary forms", "with or without modification"),
    ),
    (
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)

#: share of a text's words that must stand at their places
AGREEMENT = 0.75

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def split_words(text: str) -> list[str]:
    return re.findall(WORD, re.sub("[A-Z]+", lambda m: m[0].lower(), text))


@dataclass
class Index:
    """Words, postings and phrases of the licence texts; words are known by their hashes."""

    vocabulary: np.ndarray  # sorted hashes
    texts: list[np.ndarray]  # word numbers
    labels: list[str]
    mandatory: list[list[np.ndarray]]
    phrases: list[tuple[np.ndarray, str]]


def build(templates=TEMPLATES, phrases: dict[str, str] = PHRASES) -> Index:
    """Index of licence texts (label, wording, mandatory phrases) and base phrases."""
    worded = [split_words(text) for _, text, _ in templates]
    needed = [[split_words(p) for p in musts] for _, _, musts in templates]
    base = [split_words(p) for p in phrases]
    hashes = {w: flat.word_hash(w) for words in [*worded, *(p for m in needed for p in m), *base] for w in words}
    vocabulary = np.array(sorted(hashes.values()), np.uint64)
    number = {w: int(np.searchsorted(vocabulary, np.uint64(h))) for w, h in hashes.items()}
    numbers = lambda words: np.array([number[w] for w in words], np.int64)
    return Index(
        vocabulary,
        [numbers(w) for w in worded],
        [label for label, _, _ in templates],
        [[numbers(p) for p in musts] for musts in needed],
        [(numbers(p), label) for p, label in zip(base, phrases.values(), strict=True)],
    )


@dataclass
class Postings:
    """Places of the rarest words of the licence texts, sorted by word."""

    word: np.ndarray
    text: np.ndarray
    place: np.ndarray


def rare_postings(index: Index, counts: np.ndarray) -> Postings:
    """``counts`` has the number of documents, then of those with each word."""
    rarity = np.log((1 + counts[0]) / (1 + counts[1:]))
    rows = []
    for t, words in enumerate(index.texts):
        enough = int(len(words) * (1 - AGREEMENT)) + 1
        rarest = np.lexsort((np.arange(len(words)), -rarity[words]))[:enough]
        rows += [(int(words[k]), t, int(k)) for k in rarest]
    return Postings(*(np.array(x, np.int64) for x in zip(*sorted(rows), strict=True)))


def _known(index: Index, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number of each word or -1, first word of each text)."""
    starts, ends, first = flat.words(data, offsets, flat.LETTER_OR_DIGIT)
    hashes = flat.span_hashes(data, starts, ends, lower=True)
    at = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
    return np.where(index.vocabulary[at] == hashes, at, -1), first


def _places(words: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand consecutively."""
    count = len(words) - len(phrase) + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    found = np.flatnonzero(words[:count] == phrase[0])
    for k in range(1, len(phrase)):
        found = found[words[found + k] == phrase[k]]
    return found


def document_counts(docs: DataFrame, index: Index) -> np.ndarray:
    """Number of documents, then of documents with each licence word: one number per word."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(index.vocabulary) + 1, np.int64)
        for _, data, offsets in flat.slices(batch.column(0)):
            words, first = _known(index, data, offsets)
            at = np.flatnonzero(words >= 0)
            text = flat.owners(first, len(words))[at]
            once = np.unique(text * len(index.vocabulary) + words[at]) % len(index.vocabulary)
            seen[:-1] += np.bincount(once, minlength=len(index.vocabulary))
            seen[-1] += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(seen) - 1)), pa.array(np.roll(seen, 1))], ["word", "docs"])

    counted = map_texts(docs, count, "word long, docs long", "text").groupBy("word").agg(F.sum("docs").alias("docs"))
    out = np.zeros(len(index.vocabulary) + 1, np.int64)
    for row in counted.collect():  # as many rows as the licence texts have words
        out[row["word"] + 1] = row["docs"]
    return out


def _alignments(index: Index, postings: Postings, words: np.ndarray):
    """(licence text, places, agreements, whether the mandatory phrases stand there) of all alignments.

    ``words`` are those of many documents, with gaps between them.
    """
    at = np.flatnonzero(words >= 0)
    low = np.searchsorted(postings.word, words[at])
    size = np.searchsorted(postings.word, words[at], "right") - low
    hit = flat.spans(low, size)
    text, place = postings.text[hit], np.repeat(at, size) - postings.place[hit]
    for t in np.unique(text).tolist():
        wanted = index.texts[t]
        begin = np.unique(place[text == t])
        there = words[begin[:, None] + np.arange(len(wanted))]
        agreement = (there == wanted).mean(axis=1)
        complete = agreement >= AGREEMENT
        for k in np.flatnonzero(complete).tolist():
            complete[k] = all(len(_places(there[k], p)) for p in index.mandatory[t])
        yield t, begin, agreement, complete


def scanned(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """Per document: places of base phrases, base labels, all labels, and a score between 0 and 1."""
    index = index or build()
    postings = rare_postings(index, document_counts(docs, index))
    gap = max(len(p) for p in [*index.texts, *(p for p, _ in index.phrases)])

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for _, data, offsets in flat.slices(batch.column(1)):
            words, first = _known(index, data, offsets)
            # phrases must not reach across texts: gaps of foreign words are put around them
            count = np.diff(first)
            moved = first[:-1] + gap * np.arange(1, len(count) + 1)
            apart = np.full(len(words) + gap * (len(count) + 2), -1)
            apart[flat.spans(moved, count)] = words
            owner = lambda place: np.maximum(np.searchsorted(moved - gap // 2, place, "right") - 1, 0)  # noqa: B023, E731
            n, high = np.zeros(len(count), np.int64), np.zeros(len(count), np.int64)
            low = np.full(len(count), len(apart))
            base = [set() for _ in count]
            for phrase, label in index.phrases:
                found = _places(apart, phrase)
                text = owner(found)
                np.add.at(n, text, 1)
                np.minimum.at(low, text, found - moved[text])
                np.maximum.at(high, text, found - moved[text])
                for t in np.unique(text).tolist():
                    base[t].add(label)
            labels, score = [set(b) for b in base], (n > 0).astype(float)
            for t, begin, agreement, complete in _alignments(index, postings, apart):
                text = owner(begin + len(index.texts[t]) // 2)
                np.maximum.at(score, text, agreement)
                for d in text[complete].tolist():
                    labels[d].add(index.labels[t])
            for d in range(len(count)):
                some = bool(n[d])
                rows.append((
                    int(count[d]), int(n[d]), int(low[d]) if some else None, int(high[d]) if some else None,
                    ",".join(sorted(base[d])), ",".join(sorted(labels[d])), float(score[d]),
                ))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], names)

    return map_texts(docs, scan, SCHEMA, "doc_id", "text")
