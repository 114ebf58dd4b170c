"""The operators as queries over the given tables, and the SQL that some are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexstats.llm import (
    byte_cnn, hard_negatives, lexical_search, license_scan, line_dedup, mixing, near_text, near_vectors, packing, pieces, quality_rules,
    suffix_dedup, url_filter,
)
from hexstats.llm.common import read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_copies(read(spark, sf_dir, "embeddings"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(read(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = url_filter.judged(read(spark, sf_dir, "pages"))
    return pages.select("page_id", "host", "path", "rule", "verdict")


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return byte_cnn.scored(docs, byte_cnn.trained(docs, read(spark, sf_dir, "labels")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removed(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.coded(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op8_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_copies(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(read(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality_rules.trained(docs, read(spark, sf_dir, "labels"))
    return quality_rules.judged(docs, model)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mined(rows, F.col("vec_id") % 50 == 0)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces_of = packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces_of.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_near_vectors, op3_license_scan, op4_url_filter, op5_byte_cnn, op6_suffix_dedup, op7_pieces, op8_near_text, op9_mixing,
        op10_quality_rules, op11_hard_negatives, op12_lexical_search, op13_packing,
    )
}
