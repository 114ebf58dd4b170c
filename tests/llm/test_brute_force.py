"""Queries that SQL cannot express, against the plainest version of what they promise."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers

from hexstats.llm import byte_cnn, flat, license_scan, near_vectors, quality_rules
from hexstats.llm.queries import QUERIES
from tests.llm.fixtures import by_id, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _components(ids, linked):
    label = {i: i for i in ids}
    while True:
        before = dict(label)
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK", 16)
    monkeypatch.setattr(near_vectors, "PER_CELL", 40)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    rows = np.concatenate([base, base[:20] + rng.normal(scale=0.15, size=(20, 8)), np.repeat(base[:1], 50, 0) + rng.normal(scale=0.1, size=(50, 8))])
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")
    found = by_id(near_vectors.near_copies(table), "vec_id")
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    label = _components(range(len(rows)), [*zip(*np.nonzero(close), strict=True)])
    assert {k: r["n_links"] for k, r in found.items()} == dict(enumerate(close.sum(axis=1)))
    assert {k: r["component_id"] for k, r in found.items()} == label
    assert all(r["kept"] == (k == label[k]) for k, r in found.items())


def test_bound_has_slack_for_rounding():
    # equal centres: the distance is 0, the margin an ulp
    assert near_vectors._admitted(np.array([[0.0, 2.0**-52]]), np.zeros((1, 2))).all()
    assert not near_vectors._admitted(np.array([[1e-6]]), np.zeros((1, 1))).any()


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_copies_of_a_third(spark, monkeypatch, size):
    monkeypatch.setattr(near_vectors, "BLOCK", 32)
    monkeypatch.setattr(near_vectors, "PER_CELL", 20)
    rng = np.random.default_rng(size)
    copy = rng.normal(size=64)
    rows = np.concatenate([np.repeat(copy[None], 110, 0), rng.normal(size=(220, 64))])[rng.permutation(330)]
    count = 330 // 20 // 2 * 2 + 1
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    # no two centres are (nearly) the same one
    found = near_vectors.centres(unit, count)
    gaps = np.linalg.norm(found[:, None] - found[None], axis=2)
    assert gaps[~np.eye(len(found), dtype=bool)].min() > 1e-7
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        got = by_id(near_vectors.near_copies(table), "vec_id")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    copies = [k for k, v in enumerate(rows) if (v == copy).all()]
    assert {(got[k]["n_links"], got[k]["component_id"]) for k in copies} == {(109, min(copies))}


def test_layout_is_bounded_by_cells():
    # 60 million vectors, all cells meet
    first, senders = near_vectors._layout(np.full(256, 234_375), np.triu(np.ones((256, 256), bool)), 2048)
    assert first[-1] > 29_000 and len(first) + sum(map(len, senders)) < 256 * 256
    met = np.array([[1, 0, 1], [0, 1, 1], [0, 0, 1]], bool)
    first, senders = near_vectors._layout(np.array([25, 0, 35]), met, 10)
    cell_of = [0, 0, 0, 1, 2, 2, 2, 2]
    for v, c in enumerate(cell_of):
        assert near_vectors._senders_of(v, c, first, senders).tolist() == [u for u in range(v) if met[cell_of[u], c]]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, []), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (9, [1.0, 0.01])]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, cell string")
    found = near_vectors.near_copies(table).collect()
    assert len(found) == 10
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found}
    assert links == {1: (2, 1), 2: (2, 1), 9: (2, 1), None: (0, None)} | {k: (0, k) for k in (3, 4, 5, 6, 7, 8)}
    assert near_vectors.near_copies(table.filter("false")).count() == 0
    assert near_vectors.near_copies(table.filter("vec_id = 3")).count() == 1


def test_vectors_of_extreme_length(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [5e-324, 5e-324]), (4, [1.7e308, -1.7e308]), (5, [1e-300, -1e-300]), (6, [1e308, 1e-308])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_copies(table).collect()}
    assert links == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


@pytest.mark.parametrize("width", [2, 64, 300])
def test_products_close_to_the_limit(monkeypatch, width):
    # single precision alone cannot tell these
    monkeypatch.setattr(near_vectors, "ROWS", 7)
    monkeypatch.setattr(near_vectors, "EXACT", 500)
    rng = np.random.default_rng(width)
    left = near_vectors._unit(rng.normal(size=(20, width)))
    side = rng.normal(size=left.shape)
    side = near_vectors._unit(side - (side * left).sum(axis=1, keepdims=True) * left)
    right = np.vstack([
        c * left + np.sqrt(1 - c * c) * side for c in (0.9 + 1e-11, 0.9 - 1e-11, 0.9 + 1e-7, 0.9 - 1e-7, 0.5, 1.0)
    ])
    found = {(int(a), int(b)) for i, j in near_vectors._links(left, right) for a, b in zip(i, j, strict=True)}
    own = {(a, b) for a, b in found if b % 20 == a}
    assert own == {(k, k + 20 * block) for k in range(20) for block in (0, 2, 5)}
    exact = left @ right.T
    sure = np.abs(exact - 0.9) > 1e-12
    assert {p for p in found if sure[p]} == {(int(a), int(b)) for a, b in np.argwhere((exact >= 0.9) & sure)}


def test_unusable_vector_hides_no_usable_one(spark):
    rows = [(1, [1.0, 0.0]), (1, [None, 1.0]), (2, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [None, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    links = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_copies(table).collect()}
    assert links == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


def test_licenses(spark, sf_dir):
    found = by_id(QUERIES["op3_license_scan"](spark, sf_dir))
    for i, text in texts(spark, sf_dir).items():
        words = license_scan.split_words(text)
        places, base = [], set()
        for phrase, label in license_scan.PHRASES.items():
            p = phrase.split()
            here = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
            places += here
            base |= {label} if here else set()
        more = set(base)
        for label, wording, musts in license_scan.TEMPLATES:
            t = wording.split()
            for begin in range(1 - len(t), len(words)):
                there = [words[begin + k] if 0 <= begin + k < len(words) else None for k in range(len(t))]
                if sum(a == b for a, b in zip(there, t, strict=True)) >= license_scan.AGREEMENT * len(t) and all(
                    any(there[k : k + len(m.split())] == m.split() for k in range(len(t))) for m in musts
                ):
                    more.add(label)
        r = found[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None)
        )
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(base)), ",".join(sorted(more)))
        assert 0 <= r["score"] <= 1


def test_licence_text_with_changes(spark):
    wording = dict((t[0], t[1]) for t in license_scan.TEMPLATES)["bsd"].split()
    wording[13] = "changed"
    rows = [(1, "some code " + " ".join(wording).upper()), (2, "redistribution of source is nice"), (3, None)]
    found = by_id(license_scan.scanned(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [found[k]["labels"] for k in (1, 2, 3)] == ["bsd", "", ""]
    assert found[3]["score"] == 0


def test_suffixes(spark, sf_dir):
    found = by_id(QUERIES["op6_suffix_dedup"](spark, sf_dir))
    seen: dict[bytes, int] = {}
    removed = 0
    for i, text in sorted(texts(spark, sf_dir).items()):
        data = text.encode()
        cover = np.zeros(len(data), bool)
        for k in range(len(data) - 49):
            if seen.setdefault(data[k : k + 50], i) < i:
                cover[k : k + 50] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~cover])
        spans = int((cover & ~np.append(False, cover[:-1])).sum())
        r = found[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), int(cover.sum()), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        removed += int(cover.sum())
    assert removed


def test_pieces(spark, sf_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = by_id(QUERIES["op7_pieces"](spark, sf_dir))
    for i, text in texts(spark, sf_dir).items():
        ids = model.encode(text, add_eos=True)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def _runs(text):
    words = WORD.findall(text)
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def test_near_texts(spark, sf_dir):
    found = by_id(QUERIES["op8_near_text"](spark, sf_dir))
    runs = {i: _runs(t) for i, t in texts(spark, sf_dir).items()}
    holders: dict = {}
    for i, own in runs.items():
        for run in own:
            holders.setdefault(run, []).append(i)
    pairs = {(a, b) for ids in holders.values() for a in ids for b in ids if a < b}
    linked = []
    for a, b in pairs:
        shared = (runs[a] & runs[b]).total()
        if 5 * shared >= 4 * (runs[a].total() + runs[b].total() - shared):
            linked.append((a, b))
    label = _components(runs, linked)
    assert linked
    assert {i: r["component_id"] for i, r in found.items()} == label
    assert {i for i, r in found.items() if r["kept"]} == set(label.values())


def test_signals(spark, sf_dir):
    found = by_id(QUERIES["op10_quality_rules"](spark, sf_dir))
    for i, text in texts(spark, sf_dir).items():
        words = WORD.findall(text)
        windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        r = found[i]
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(map(len, words)))
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(repeated))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])


def _network(seed):
    rng = np.random.default_rng(seed)
    n = byte_cnn.FILTERS
    filters = rng.normal(0, 0.3, (byte_cnn.WIDTH, 256, n))
    filters[:, 0] = 0
    return byte_cnn.Network(filters, rng.normal(0, 0.3, n), rng.normal(0, 0.5, 2 * n + 2))


def _plain_odds(network, text):
    """The network byte by byte."""
    data, half = text.encode(), byte_cnn.HALF
    halves = -(-(len(data) + byte_cnn.WIDTH - 1) // half)
    best = np.zeros((halves, byte_cnn.FILTERS))
    for p in range(len(data)):
        response = network.bias + sum(network.filters[k, c] for k, c in enumerate(data[p : p + byte_cnn.WIDTH]))
        best[p // half] = np.maximum(best[p // half], response)
    chunks = [np.maximum(best[h], best[min(h + 1, halves - 1)]) for h in range(halves)]
    features = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0), [np.log1p(len(data)) / 10]])
    return features @ network.head[:-1] + network.head[-1]


ODD_TEXTS = ["", "a", "seven b", "x" * 121, "y" * 122, "z" * 128 + "tail", "é日本 😀" * 40, "".join(chr(33 + k * k % 90) for k in range(700))]


def test_network_equals_plain_loops():
    network = _network(1)
    tables = network.tables()
    for most in (1, 500, 1 << 20):
        z = [byte_cnn.log_odds(network, tables, d, o) for _, d, o in flat.slices(pa.array(ODD_TEXTS), most)]
        np.testing.assert_allclose(np.concatenate(z), [_plain_odds(network, t) for t in ODD_TEXTS], atol=2e-5)


def test_slopes_equal_differences():
    network, good, weight = _network(2), np.arange(len(ODD_TEXTS)) % 2 == 0, np.linspace(0.5, 2, len(ODD_TEXTS))

    def loss():
        z = np.array([_plain_odds(network, t) for t in ODD_TEXTS])
        return (weight * (np.logaddexp(0, z) - good * z)).sum()

    _, data, offsets = next(flat.slices(pa.array(ODD_TEXTS), 1 << 30))
    slopes = byte_cnn._gradients(network, byte_cnn.padded(data, offsets), good, weight)
    rng = np.random.default_rng(3)
    for part, slope in zip((network.filters, network.bias, network.head), slopes, strict=True):
        steep = np.argwhere(np.abs(slope) > 1e-2)
        for at in map(tuple, steep[rng.permutation(len(steep))[:12]]):
            kept, sides = part[at], []
            for step in (1e-6, -1e-6):
                part[at] = kept + step
                sides.append(loss())
            part[at] = kept
            assert abs((sides[0] - sides[1]) / 2e-6 - slope[at]) < 1e-3 * max(1, abs(slope[at])), at


def _held_out_rank(scores, good):
    """Probability that a good row scores higher than a bad one."""
    return float(np.mean([[a > b for b in scores[~good]] for a in scores[good]]))


def test_classifiers_on_rows_they_have_not_seen(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    known = by_id(labels)
    network = byte_cnn.trained(docs, labels)
    rows = [r for r in byte_cnn.scored(docs, network).collect() if r["held_out"] and r["doc_id"] in known]
    good = np.array([known[r["doc_id"]]["quality"] == 1 for r in rows])
    assert _held_out_rank(np.array([r["score"] for r in rows]), good) > 0.9
    assert all(r["predicted"] == (r["score"] >= byte_cnn.ACCEPT) for r in rows)
    fitted = quality_rules.trained(docs, labels.filter("doc_id % 3 > 0"))
    rows = [r for r in quality_rules.judged(docs, fitted).collect() if r["doc_id"] % 3 == 0 and r["doc_id"] in known]
    good = np.array([known[r["doc_id"]]["quality"] == 1 for r in rows])
    assert _held_out_rank(np.array([r["probability"] for r in rows]), good) > 0.9


@pytest.mark.parametrize("held", [True, False])
def test_held_out_rows_are_not_learned_from(spark, held):
    from pyspark.sql import functions as F

    rows = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    allowed = rows.filter(byte_cnn.held_out(F.col("doc_id")) == held)
    import zlib

    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == held for r in allowed.collect())
