"""Scalar measures shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where the denominator is zero (ANSI mode raises otherwise)."""
    return num / F.nullif(den, F.lit(0.0))


def spread(low: str, high: str) -> Column:
    """log10 of the ratio between two extremes; zero or NULL extremes give NULL.

    Extremes of different sign have no ratio: their distance relative to the smaller of the
    two magnitudes is used.
    """
    lo, hi = f"nullif({low}, 0D)", f"nullif({high}, 0D)"
    return F.expr(
        f"case when {hi} / {lo} > 0 then log10({hi} / {lo})"
        f" when {hi} / {lo} < 0 then log10(({hi} - {lo}) / least(abs({lo}), abs({hi}))) end"
    )


def relative_error(a: Column, b: Column) -> Column:
    """|a-b| / (|a|+|b|), NULL where both are zero."""
    return ratio(F.abs(a - b), F.abs(a) + F.abs(b))


def within(x: Column, mean: Column, stddev: Column, width: float = 3.0) -> Column:
    return x.between(mean - stddev * width, mean + stddev * width)
