"""Small tables with everything that may go wrong in a row."""

import random

from pyspark.sql import DataFrame, SparkSession

LONG = " ".join(f"w{k}" for k in range(30_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven calm otters read quiet books near a river bank and then swim home"


def documents(spark: SparkSession) -> DataFrame:
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    rng = random.Random(3)
    mixed = [" ".join(rng.choice(PROSE.split()) for _ in range(80)) for _ in range(6)]
    rows = [
        (1, PROSE, "en", "b"),
        (2, PROSE, "en", "b"),
        (2, PROSE, "en", "b"),
        (3, PROSE + " again", None, None),
        (4, "", "en", "a"),
        (5, None, "en", "a"),
        (None, PROSE, None, "a"),
        (None, None, None, None),
        (6, LONG, "en", "c"),
        (7, LONG + " end", "en", "c"),
        (8, "one two", "en", "ä"),
        (9, "one two", "en", "ä"),
        (10, "\n\n \t\n", "en", "ä"),
        (11, "x" * 400, "en", "a"),
        (12, "日本語 テキスト 😀\x00 ▁▁", "en", "a"),
        *((20 + k, t, "en", "d") for k, t in enumerate(mixed)),
        *((30 + k, f"Page {k} of 900\n{t}\nAll rights reserved.", "en", "e") for k, t in enumerate(mixed)),
    ]
    wide = [(*row, 7, "clash", 1.0, True, 5, 5, [1]) for row in rows]
    return spark.createDataFrame(
        wide,
        "doc_id long, text string, lang string, source string, n_chars long, labels string, score double, kept boolean, "
        "component long, _row long, bands array<int>",
    )


def labels(spark: SparkSession) -> DataFrame:
    rows = [(k, k % 2, 0) for k in range(1, 40)] + [(None, 1, 0), (3, None, None), (8, 0, 0), (8, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def empty(table: DataFrame) -> DataFrame:
    return table.filter("false")


def texts(spark: SparkSession, sf_dir: str) -> dict[int, str]:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def by_id(found: DataFrame, key: str = "doc_id") -> dict:
    return {r[key]: r for r in found.collect()}
