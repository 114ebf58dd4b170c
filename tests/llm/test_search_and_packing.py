"""Hard negatives, lexical search and packing: brute force, exact round trips, odd rows."""

import json
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import pairwise

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hexstats.llm import flat, hard_negatives, lexical_search, packing
from hexstats.llm.queries import QUERIES
from tests.llm.fixtures import documents, empty, texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


# --- hard negatives -------------------------------------------------------------------------


def mined_plainly(rows, anchors):
    """rows: vec_id to (label, whole numbers)."""
    found = []
    for a in anchors:
        label, vector = rows[a]
        score = {k: sum(x * y for x, y in zip(vector, v, strict=False)) for k, (_, v) in rows.items() if k != a}
        order = sorted(score, key=lambda k: (-score[k], k))
        for p in [k for k in order if rows[k][0] == label][:5]:
            fitting = [k for k in order if rows[k][0] != label and 50 * score[p] <= 100 * score[k] <= 95 * score[p]]
            found += [(a, p, rank, n, score[p], score[n]) for rank, n in enumerate(fitting[:3], 1)]
    return sorted(found)


def as_tuples(found):
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[n] for n in names) for r in found.collect())


@pytest.mark.parametrize("kind", ["clustered", "copies", "opposed"])
def test_hard_negatives(spark, monkeypatch, kind):
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "GROUP", 7)
    monkeypatch.setattr(hard_negatives, "CHUNK", 4)
    rng = np.random.default_rng(len(kind))
    centres = rng.normal(size=(4, 20))
    vectors = centres[rng.integers(0, 4, 240)] + rng.normal(scale=0.4, size=(240, 20))
    if kind == "copies":  # a third of all rows is one vector, with several labels
        vectors[::3] = vectors[0]
    if kind == "opposed":  # scores of every sign, and of zero
        vectors[::2] *= -1
        vectors[::5] = 0
    labels = rng.integers(0, 3, 240)
    table = spark.createDataFrame([(k, vectors[k].tolist(), int(labels[k])) for k in range(240)], "vec_id long, embedding array<double>, label int")
    rows = {k: (int(labels[k]), [int(x) for x in np.floor(256 * vectors[k])]) for k in range(240)}
    found = as_tuples(hard_negatives.mined(table, F.col("vec_id") % 10 == 0))
    assert found == mined_plainly(rows, range(0, 240, 10)) and found


def test_index_equals_full_products():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.normal(size=(300, 50)) * rng.exponential(size=50) * 100)
    anchors = rows[:9]
    index = hard_negatives.Index(rows)
    products = (anchors @ rows.T).astype(int)
    for share in (0.9, 0.5, 0.1, 0.0, -0.5):
        least = np.floor(share * np.linalg.norm(anchors, axis=1) * index.greatest)
        a, r, score = index.reaching(anchors, least)
        assert set(zip(a, r, strict=True)) == set(zip(*np.nonzero(products >= least[:, None]), strict=True))
        assert (score == products[a, r]).all()


def test_rows_that_take_no_part(spark):
    good = [(50 * k, [1.0, k / 10], k % 2) for k in range(12)]
    odd = [
        (1, None, 1), (2, [1.0, None], 1), (3, [1.0, float("nan")], 0), (4, [float("inf")], 1), (5, [1.0, 0.5], None), (None, [1.0, 0.5], 0),
        (6, [1e200, 1.0], 0),
    ]
    again = [(50, [1.0, 0.1], 1), (100, [9.0, 9.0], 7), (7, [1.0], 0), (8, [], 1)]
    columns = "vec_id long, embedding array<double>, label int, score long, rank int, block int"
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in good + odd + again], columns)
    rows = {k: (label, [int(np.floor(256 * x)) for x in v] + [0] * (2 - len(v))) for k, v, label in [*good, (7, [1.0], 0), (8, [], 1)]}
    found = as_tuples(hard_negatives.mined(table, F.col("vec_id") % 50 == 0))
    assert found == mined_plainly(rows, [k for k, _, _ in good])
    assert as_tuples(hard_negatives.mined(empty(table), F.lit(True))) == []
    assert as_tuples(hard_negatives.mined(table, F.lit(False))) == []


def test_large_scores_are_exact():
    left = np.array([[2.0**27 + 1, 3.0], [2.0**30, 1.0]])
    right = np.array([[2.0**27 - 1, 5.0], [2.0**30, 7.0]])
    expected = [int(a[0]) * int(b[0]) + int(a[1]) * int(b[1]) for a, b in zip(left, right, strict=True)]
    assert hard_negatives._exact(left, right).tolist() == expected


# --- lexical search -------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def ranked_plainly(docs, items):
    """docs and items: lists of (id, text)."""
    words = [(k, TERM.findall((t or "").translate(LOWER))) for k, t in docs]
    n_docs, length = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    held = Counter(t for _, w in words for t in set(w))
    found = []
    for item, text in set(items):
        scores = []
        for k, w in words:
            tf, score = Counter(w), 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if t in tf:
                    weight = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held[t] + 1))))
                    m = 75 + 25 * len(w) * n_docs // length
                    score += weight * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0 and k is not None:
                scores.append((-score, k))
        found += [(item, rank, k, -s) for rank, (s, k) in enumerate(sorted(scores)[:20], 1)]
    return sorted(found, key=str)


def searched(found):
    return sorted((tuple(r[n] for n in ("item_id", "rank", "doc_id", "score")) for r in found.collect()), key=str)


@pytest.mark.parametrize("tree", [8, 64, 8192])
def test_search(spark, monkeypatch, tree):
    monkeypatch.setattr(lexical_search, "DOCUMENTS", tree)
    monkeypatch.setattr(lexical_search, "POSTINGS", 20 * tree)
    monkeypatch.setattr(lexical_search, "AT_ONCE", 3)
    monkeypatch.setattr(lexical_search, "OPEN", 200)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 4)
    rng = random.Random(tree)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in ("", "1", "é", "Z")]
    docs = [(k, " ".join(rng.choices(vocabulary, range(40, 0, -1), k=rng.randint(1, 60)))) for k in range(200)]
    docs += [(300 + k, docs[3][1]) for k in range(40)]  # more copies than results
    items = [(k, ", ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for k in range(9)] + [(90, docs[3][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = lexical_search.ranked(table, spark.createDataFrame(items, "item_id long, text string"))
    assert searched(found) == ranked_plainly(docs, items)


def test_search_of_odd_rows(spark):
    docs = documents(spark)
    items = [(1, "quick BROWN fox fox"), (1, "quick BROWN fox fox"), (1, "otters"), (2, None), (3, ""), (4, "..."), (None, "w1 w2 one"), (5, "日本語 again"), (6, "w29999 " * 3000)]
    table = spark.createDataFrame([(*r, 1, 2) for r in items], "item_id long, text string, doc_id long, score long")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert searched(lexical_search.ranked(docs, table)) == ranked_plainly(rows, items)
    assert searched(lexical_search.ranked(empty(docs), table)) == []
    assert searched(lexical_search.ranked(docs, empty(table))) == []


def test_treap_finds_every_cell():
    rng = np.random.default_rng(1)
    grid = np.where(rng.random((16, 16)) < 0.2, rng.integers(1, 100, (16, 16)), 0)
    row, column = np.nonzero(grid)
    tree = lexical_search.Treap(row, column, grid[row, column], 4)
    for r in range(16):
        for c in range(16):
            cell = np.array([1])
            for level in range(4):
                size = 8 >> level
                cell = tree.below(cell, np.array([2 * (r // size % 2) + c // size % 2]))
                assert tree.best[cell[0]] == grid[r // size * size :, c // size * size :][:size, :size].max()


# --- packing --------------------------------------------------------------------------------


def cheapest_plainly(at, penalty, window):
    cost = [0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        for i in range(j):
            n = at[j] - at[i]
            if n <= window:
                exempt = penalty[j] == 0 and n & (n - 1) == 0
                c = cost[i] + (0 if exempt else window - n) + packing.WINDOW_COST + penalty[j]
                cost[j] = c if cost[j] is None else min(cost[j], c)
    return cost[-1]


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_cuts(seed):
    rng = np.random.default_rng(seed)
    window = (64, 100)[seed % 2]
    at = np.append(0, np.cumsum(rng.integers(1, 17, 150)))
    penalty = np.array([0, packing.SENTENCE_COST, packing.TOKEN_COST])[rng.integers(0, 3, len(at))]
    penalty[-1] = 0
    cuts = packing.cheapest_cuts(at, penalty, window)
    ends = at[cuts]
    cost = 0
    for j, (a, b) in zip(cuts, pairwise([0, *ends]), strict=True):
        n = b - a
        assert 0 < n <= window
        cost += (0 if penalty[j] == 0 and n & (n - 1) == 0 else window - n) + packing.WINDOW_COST + penalty[j]
    assert ends[-1] == at[-1] and cost == cheapest_plainly(at.tolist(), penalty.tolist(), window)


def plain_ids(text):
    return Tokenizer.from_file(TOKENIZER).encode(text or "", add_special_tokens=False).ids


def check_packing(pieces, ids_of):
    """Every document's ids lie in pieces without gap or overlap, every sequence is gapless and not too long."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids_of)
    for doc, rows in by_doc.items():
        rows.sort(key=lambda r: r["start"])
        assert [r["start"] for r in rows] == [0, *np.cumsum([r["length"] for r in rows])[:-1].tolist()]
        assert {r["doc_tokens"] for r in rows} == {len(ids_of[doc])} == {sum(r["length"] for r in rows)}
        for r in rows:
            own = ids_of[doc][r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    sizes = []
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == [0, *np.cumsum([r["length"] for r in rows])[:-1].tolist()]
        sizes.append(sum(r["length"] for r in rows))
    assert max(sizes) <= packing.WINDOW
    return sum(packing.WINDOW - n for n in sizes if n & (n - 1)) / sum(sizes)


def test_packing_query(spark, sf_dir):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for k, t in texts(spark, sf_dir).items()}
    rows = QUERIES["op13_packing"](spark, sf_dir).collect()
    assert check_packing(rows, ids) < 0.02
    assert Counter(map(tuple, rows)) == Counter(map(tuple, QUERIES["op13_packing"](spark, sf_dir).collect()))


def test_packing_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "CHUNK", 5000)
    docs = documents(spark)
    one = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)
    rows = packing.packed(one, TOKENIZER).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(rows, {r["doc_id"]: [*plain_ids(r["text"]), 1] for r in one.collect()})
    assert packing.packed(docs, TOKENIZER).filter("start = 0").count() == docs.count()
    assert packing.packed(empty(docs), TOKENIZER).collect() == []
    blanks = spark.createDataFrame([(k, None) for k in range(40)], "doc_id long, text string").coalesce(1)
    assert [r["length"] for r in packing.packed(blanks, TOKENIZER).collect()] == [1] * 40


@pytest.mark.parametrize("by_word", [True, False])
def test_ids_of_odd_texts(by_word):
    encoder = packing.Encoder(TOKENIZER)
    assert encoder.by_word
    encoder.by_word = by_word
    rng = random.Random(8)
    odd = ["", " ", "a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|>x", "it's 'rex don't we'll 'S'T 12a3 #a'b'c|d<e>f| <|x|>", "é ≠ …. ….a İstanbul ΑΣ. Σ ß ŒUVRE"]
    odd += ["\x00a\x1c b\x85c d ×÷a Ünï--code", "ab\u0301c'\u0301 1\u0301 .\u0301 é\u0301 =\u0338", "日本語1テ't 😀's \u200d\u2028x", "x" * 3000, "\t\n\u3000\xa0"]
    letters = "abCD 'éÉß<|>.,;1²Ⅷ\u0301\u0338\u0130Σς日😀\n\t\x1f"
    odd += ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(300)]
    _, data, offsets = next(flat.slices(pa.array(odd)))
    for _ in range(2):  # the second time all words are known
        ids, limits = encoder.encode(data, offsets)
        for k, text in enumerate(odd):
            assert ids[limits[k] : limits[k + 1]].tolist() == [*encoder.whole.encode(text, add_special_tokens=False).ids, 1], text
    assert json.dumps(limits.tolist())
