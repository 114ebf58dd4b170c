"""Joins that plain equality keys would not spread evenly."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows of either side that meet in one tile
TILE_ROWS = 2_000
#: partitions the tiles are dealt to, at most
MAX_PARTITIONS = 2_000
#: marks in one number
_BITS = 64


def match_rows(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """Join on an inequality, for results that really consist of nearly all combinations.

    Both sides are cut into tiles and every combination of tiles becomes one equi-join key, so
    the work is spread evenly, no side has to fit into one executor, and no key is hot. Column
    names of the two sides must differ; both sides should be staged or cheap, they are counted.
    """
    rows = ceil(max(left.count(), 1) / TILE_ROWS)
    columns = ceil(max(right.count(), 1) / TILE_ROWS)

    def tile(df: DataFrame, count: int) -> Column:
        return F.pmod(F.xxhash64(*df.columns), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    a = left.withColumn("_row", tile(left, rows)).withColumn("_column", every(columns))
    b = right.withColumn("_column", tile(right, columns)).withColumn("_row", every(rows))
    return _meet(a, b, rows * columns).filter(condition).drop("_row", "_column")


def _meet(a: DataFrame, b: DataFrame, tiles: int) -> DataFrame:
    """Tiles of few bytes yield many rows, so adaptive execution must not merge their partitions: the number
    is set here, with room for tiles that hash alike. A side is repeated for every tile it meets, which Spark's
    estimate of its size leaves out, so it is never broadcast."""
    count = min(2 * tiles, MAX_PARTITIONS)
    a, b = (side.repartition(count, "_row", "_column").hint("merge") for side in (a, b))
    return a.join(b, ["_row", "_column"])


def match_numbered(
    left: DataFrame, right: DataFrame, known: DataFrame, condition: Column, ways: int = 1, ascending: bool = False
) -> DataFrame:
    """Join on an inequality, as ``match_rows``, of rows numbered compactly in ``x`` and ``y``; if ``ascending``,
    only those with x < y.

    ``known`` (x, y, way) marks pairs in up to ``ways`` ways, counted from 0; ``condition`` asks for them by
    ``is_known``. The marks of a row travel with it as bits, one per row it meets in a tile, so what is
    known of all combinations costs a shuffle of the known pairs alone, and no combination is ever shuffled.
    The right rows of a tile come as one list, which each left row reads in a loop of generated code.
    Both sides should be staged.
    """
    size, words = F.lit(TILE_ROWS), ceil(TILE_ROWS / _BITS)
    rows, columns = (
        (df.agg(F.max(n)).first()[0] or 0) // TILE_ROWS + 1 for df, n in ((left, "x"), (right, "y"))
    )

    def tile(name: str) -> Column:
        return F.floor(F.col(name) / size).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    place = F.pmod("y", size).cast("int")
    word = F.floor(place / _BITS).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(_BITS)))
    marks = (
        known.select("x", tile("y").alias("_column"), (F.col("way") * words + word).cast("int").alias("word"), bit.alias("bit"))
        .groupBy("x", "_column", "word")
        .agg(F.bit_or("bit").alias("bits"))
        .groupBy("x", "_column")
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("marks"))
        .select(
            "x", "_column",
            F.transform(
                F.sequence(F.lit(0), F.lit(ways * words - 1)), lambda i: F.coalesce(F.try_element_at("marks", i), F.lit(0).cast("long"))
            ).alias("_marks"),
        )
    )
    a = left.withColumn("_column", every(columns)).join(marks, ["x", "_column"], "left").withColumn("_row", tile("x"))
    lists = (
        right.select(tile("y").alias("_column"), F.struct(*right.columns, word.alias("_word"), bit.alias("_bit")).alias("_y"))
        .groupBy("_column")
        .agg(F.collect_list("_y").alias("_ys"))
    )
    b = lists.withColumn("_row", every(rows))
    if ascending:
        a, b = (side.filter("_row <= _column") for side in (a, b))
        condition = (F.col("x") < F.col("y")) & condition
    met = _meet(a, b, rows * columns).select(*left.columns, "_marks", F.inline("_ys"))
    return met.filter(condition).drop("_marks", "_word", "_bit")


def is_known(way: int = 0) -> Column:
    """Whether a combination of ``match_numbered`` is marked in a way."""
    word = F.get("_marks", F.col("_word") + F.lit(way * ceil(TILE_ROWS / _BITS)))
    return F.coalesce(word.bitwiseAND(F.col("_bit")) != 0, F.lit(False))


def apart(left: str, right: str) -> Column:
    """Whether two texts that are not NULL differ, told from their hashes (``hashed``) unless these are the same."""
    return (F.col(f"{left}_hash") != F.col(f"{right}_hash")) | (F.col(left) != F.col(right))


def hashed(text: Column, name: str) -> list[Column]:
    """A text and its hash, for ``apart``."""
    return [text.alias(name), F.xxhash64(text).alias(f"{name}_hash")]


def attach(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of a large table with a small one, where any key may hold much of the large one.

    ``small`` should be staged: Spark then knows its size and broadcasts it up to the session's
    threshold. Beyond that both sides are shuffled for this join alone, which lets adaptive execution
    split the partitions of hot keys; no row is repeated for keys that are not hot.
    """
    return rows.join(small, keys)
