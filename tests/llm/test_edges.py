"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

import corpus_pipeline
from hexstats.llm import (
    byte_cnn, license_scan, line_dedup, mixing, near_text, pieces, quality_rules, suffix_dedup, url_filter,
)
from tests.llm.fixtures import PROSE, by_id, documents, empty, labels

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


def per_row(docs, labels):
    network, model = byte_cnn.trained(docs, labels), quality_rules.trained(docs, labels)
    return {
        "license": license_scan.scanned(docs),
        "cnn": byte_cnn.scored(docs, network),
        "pieces": pieces.coded(docs, MODEL),
        "rules": quality_rules.judged(docs, model),
        "mixing": mixing.mixed_sizes(docs),
        "lines": line_dedup.report(docs),
        "suffix": suffix_dedup.removed(docs),
    }


def test_one_result_per_row(spark, docs):
    ids = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    for name, found in per_row(docs, labels(spark)).items():
        rows = found.collect()
        assert Counter(r["doc_id"] for r in rows) == ids, name
        results = {}
        for r in rows:  # repeated rows get the same result
            assert results.setdefault(r["doc_id"], r) == r or r["doc_id"] is None, name


def test_empty_tables(spark, docs):
    none, no_labels = empty(docs), empty(labels(spark))
    for name, found in per_row(none, no_labels).items():
        assert found.collect() == [], name
    assert near_text.near_copies(none).collect() == []
    assert line_dedup.dedup_lines(none).collect() == []
    # without labels nothing can be learned: everything is let through
    assert {r["predicted"] for r in byte_cnn.scored(docs, byte_cnn.trained(docs, no_labels)).collect()} == {1}


def test_near_copies(docs):
    found = [r for r in near_text.near_copies(docs).collect()]
    classes = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert (classes[1], classes[2], classes[3]) == (1, 1, 1)
    assert (classes[6], classes[7]) == (6, 6)
    assert (classes[8], classes[9]) == (8, 8)
    assert [classes[k] for k in (4, 5, 10)] == [4, 5, 10]
    assert sum(r["doc_id"] is None and r["kept"] for r in found) == 2
    left = near_text.drop_near_copies(docs)
    assert left.columns == docs.columns and left.count() == len(set(classes.values())) + 2


def test_lines(docs):
    kept = line_dedup.dedup_lines(docs, min_docs=3)
    assert kept.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert texts[30].startswith("Page 0 of 900") and not texts[31].startswith("Page 1")
    assert texts[31].endswith("reserved.") is False and 11 in texts and texts[5] is None


def test_long_passages_of_two_documents(spark, sf_dir):
    words = [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]
    long, dated = " ".join(words[:51]), " ".join([*words[:30:-1], "2024", *words[:25]])
    short, other = " ".join(words[:50]), dated.replace("2024", "2025")
    rows = [
        (1, f"one\n{long}\n{dated}\n{short}"), (2, f"two\n  {long.replace(' ', '  ')}\n{dated}\n{short}"),
        (3, f"three\n{other}"), (4, f"four\n{long}x\n{long}x"), (None, f"five\n{' '.join(words[:60])}"),
        (6, " ".join(words[:60])),
    ]
    table = spark.createDataFrame([(*r, "en", "s", 1) for r in rows[:3]], "doc_id long, text string, lang string, source string, n_chars long")
    # min_docs out of reach: only passages count
    gone = line_dedup.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string"), 9, line_dedup.PASSAGE_WORDS)
    assert sorted((r["doc"], r["line"]) for r in gone.collect()) == [(2, 1), (2, 2), (6, 0)]
    # the pipeline has both: other digits need a third document, the same ones do not
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup_stage(spark, table, sf_dir).collect()}
    assert kept == {1: f"one\n{long}\n{dated}\n{short}", 2: f"two\n{short}", 3: "three"}  # dated: three documents


def test_passages_of_two_documents_in_the_query(spark):
    long = " ".join(f"{a}{b}" for a in "abcdefgh" for b in "klmnopqr")
    rows = [(4, f"own\n{long} 7"), (2, f"{long} 7\nmine"), (9, f"x {long} 7")]
    found = by_id(line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: (r["n_lines"], r["n_dropped"], r["emptied"]) for k, r in found.items()} == {4: (2, 1, False), 2: (2, 0, False), 9: (1, 0, False)}
    assert found[4]["kept_sha256"] == hashlib.sha256(b"own").hexdigest()


def test_copies_stay_whole_for_the_next_stage(spark):
    rng = random.Random(5)
    body = [" ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(10)) for _ in range(8)]
    own = "some words of its own that stand nowhere else at all here"
    texts = {
        1: body, 2: [*body, "tail"], 3: [*body[:6], own + " indeed", body[7][::-1]], None: body,
        4: [body[0], own, own + " too", body[1][::-1]], 5: [body[2], body[3]], 6: [body[2][::-1], body[3][::-1]],
    }
    docs = spark.createDataFrame([(k, "\n".join(t)) for k, t in texts.items()], "doc_id long, text string")
    cut = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, min_docs=2).collect()}
    assert cut[2] == "tail" and cut[4] == "\n".join(texts[4][1:]) and 1 not in cut  # null comes first
    kept = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup_lines(docs, min_docs=2, copies_share=0.5).collect()}
    # a line of four is no copy, nor is a small part of another document
    assert kept == {**{k: t for k, t in texts.items() if k != 5}, 4: texts[4][1:]}
    assert line_dedup.dedup_lines(empty(docs), copies_share=0.5).collect() == []


def test_mixing(docs):
    rows = mixing.mixed_sizes(docs).collect()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    targets = mixing.with_targets(mixing.source_totals(mixing.sized(docs))).collect()
    assert sum(r["target"] for r in targets) == pytest.approx(total)
    assert [r["weight"] for r in sorted(targets, key=lambda r: (r["source"] is None, r["source"] or ""))] == [5, 2, 1, 5, 2, 1, 5]
    assert all(r["target"] <= 3 * r["source_size"] for r in targets)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    again = Counter(r["doc_id"] for r in mixing.mix(docs).collect())
    assert Counter(r["doc_id"] for r in mixed.collect()) == again


def test_mixing_without_ids(spark):
    # each document draws for itself, so the source comes near its target
    rows = [(None, f"words number {k}", "a") for k in range(2000)] + [(None, "other words here", "b")] * 2000
    found = mixing.mixed_sizes(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    own = [r for r in found if r["size"] == 3 and r["target"] == max(r["target"] for r in found)]
    assert len(own) == 2000 and own[0]["target"] == 12_000 * 5 / 7
    assert abs(sum(r["taken"] for r in own) - own[0]["target"]) < 0.03 * own[0]["target"]
    assert len({r["taken"] for r in found if r["target"] < own[0]["target"]}) == 1  # equal texts draw alike


def test_suffixes_of_odd_rows(docs):
    found = by_id(suffix_dedup.removed(docs).filter("doc_id is not null"))
    assert found[1]["n_removed"] == 0 and found[2]["n_removed"] == len(PROSE) and found[3]["n_removed"] == len(PROSE)
    assert (found[3]["n_spans"], found[3]["kept"]) == (1, b" again")
    assert found[8]["n_removed"] == found[9]["n_removed"] == 0  # shorter than a window
    assert found[11]["n_removed"] == 0  # repeats only itself
    assert found[7]["kept"] == b" end"
    assert found[5]["kept_sha256"] == hashlib.sha256(b"").hexdigest()


def test_pieces_of_odd_rows(docs):
    found = by_id(pieces.coded(docs, MODEL, texts=True).filter("doc_id is not null"))
    assert found[4]["ids"] == found[5]["ids"] == [2] and found[4]["decoded"] == ""
    assert found[12]["decoded"] == "日本語 テキスト 😀\x00   "  # the piece for a space decodes to one


def test_urls(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "HTTP://Example.ORG/en/12?x#y"), (5, "http://a.example.org"),
        (6, "http://example.org/es/1"), (7, "http://x.com/de/1.html"), (8, "http://xcom/de/1"), (None, "http://x.com/fr/"),
        (9, "a://b://c/d"), (9, "a://b://c/d"),
    ]
    pages = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, host string, n long")
    found = by_id(url_filter.judged(pages), "page_id")
    got = {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in found.items()}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[5] == ("a.example.org", "", None, "allow")
    assert got[6][2:] == ("example.org/es/", "block") and got[7][2:] == ("com/de/", "block")
    assert got[8][2] is None and got[None][2:] == ("com/fr/", "allow")
    assert got[9][:2] == ("b:", "//c/d")
    assert url_filter.judged(empty(pages)).collect() == []


def test_path_templates(spark):
    rows = [(k, f"http://{'ab'[k % 2]}.com/{'de' if k % 4 else 'fr'}/{k}.html") for k in range(80)]
    rows += [(100 + k, f"http://a.com/de/x{k}") for k in range(3)] + [(200, "http://a.com/shop/1.html")]
    rules = (url_filter.Rule("block", "a.com", "/de/"), url_filter.Rule("allow", "a.com", "/fr/"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = by_id(url_filter.judged(pages, rules), "page_id")
    assert found[2]["template"] == "de/*.html" and found[2]["verdict"] == "block"
    assert found[4]["verdict"] == "allow" and found[200]["verdict"] == "allow"
    assert {found[k]["verdict"] for k in range(1, 80, 2)} == {"allow"}  # nothing is known about b.com


def test_deep_path_templates(spark):
    names = "ant bee cat dog elk fox gnu hen ibis jay koi lynx".split()
    rows = [(k, f"http://a.com/p/q/r/{n}/{m}/photo") for k, (n, m) in enumerate(zip(names, reversed(names), strict=True))]
    rows += [(50, "http://a.com/" + "x/" * 300)]  # deep, but alone
    found = by_id(url_filter.judged(spark.createDataFrame(rows, "page_id long, url string")), "page_id")
    assert {found[k]["template"] for k in range(len(names))} == {"p/q/r/*/*/photo"}
    assert found[50]["template"] == "x/" * 300


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = work(spark, docs, sf_dir).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        after = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert set(after) <= before and after, name
        if name == "MinHash near-dedup":
            left = near_text.near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet").join(docs.select("doc_id"), "doc_id", "left_semi"))
            classes = Counter(r["component_id"] for r in left.collect())
            assert sum(classes.values()) - len(classes) <= 0.05 * len(after)  # near copies, also as scraps
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert Counter(r["doc_id"] for r in coded.collect()) == Counter(after)
    assert corpus_pipeline.run(spark, sf_dir).count() == len(after)


@pytest.mark.parametrize("rows", ["all", "none", "unlabelled"])
def test_pipeline_of_odd_rows(spark, docs, tmp_path, rows):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns; empty tables."""
    folder = str(tmp_path)
    (empty(docs) if rows == "none" else docs).write.parquet(f"{folder}/documents.parquet")
    (empty(labels(spark)) if rows != "all" else labels(spark)).write.parquet(f"{folder}/labels.parquet")
    left = spark.read.parquet(f"{folder}/documents.parquet")
    for name, work in corpus_pipeline.STAGES[:-1]:
        given = left
        left = work(spark, given, folder).cache()
        assert left.schema.names == docs.schema.names, name
        assert {r[0] for r in left.select("doc_id").collect()} <= {r[0] for r in given.select("doc_id").collect()}, name
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert found.count() == left.count() and (rows != "none" or not found.count())
    if rows == "unlabelled":  # nothing is learned, so only copies go
        kept = {r["doc_id"] for r in found.collect()}
        assert {8, 10, 11, 12} & kept and not {2, 3, 7, 9} & kept
