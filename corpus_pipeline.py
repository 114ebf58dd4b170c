"""Training-corpus pipeline over documents: classify, drop lines, drop near copies, mix, encode.

Each stage works on all rows its predecessor kept and takes (spark, docs, sf_dir). All but the last
return the columns of documents; the last returns the encoded corpus. Empty tables, nulls and extra
columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hexstats.llm import byte_cnn, line_dedup, mixing, near_text, pieces
from hexstats.llm.common import read
from hexstats.sources.staging import stage

#: share of the words of either that a document must have from one other for it to count as its copy
COPIES_SHARE = 0.7
#: SQL cannot express the classifier, nor the coding
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the byte-level network accepts; labels come from the labels table."""
    return byte_cnn.keep_good(docs, read(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs, or long passages that two documents have.

    Copies of one other document stay whole: the next stage drops them, which it could not if only scraps
    of them were left.
    """
    return line_dedup.dedup_lines(docs, passage_words=line_dedup.PASSAGE_WORDS, copies_share=COPIES_SHARE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_text.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by the weight of their source."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and digests of them and of the text they decode to."""
    coded = pieces.coded(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("MinHash near-dedup", near_dedup),
    ("source mixing", mix_sources),
    ("SentencePiece coding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
