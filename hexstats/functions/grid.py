"""Cell-id and boundary expressions. All are native columns, none needs a UDF.

A cell id is a 64-bit integer: mode 1 in bits 59-62, resolution in bits 52-55, base cell in
bits 45-51, then one 3-bit digit per resolution (7 = unused).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Average hexagon area in km2 for resolutions 0 to 15 (public grid tables).
AVG_AREA_KM2 = (
    4.357449416078383e06,
    6.097884417941332e05,
    8.680178039899720e04,
    1.239343465508816e04,
    1.770347654491307e03,
    2.529038581819449e02,
    3.612906216441245e01,
    5.161293359717191e00,
    7.373275975944177e-01,
    1.053325134272067e-01,
    1.504750190766435e-02,
    2.149643129451879e-03,
    3.070918756316060e-04,
    4.387026794728296e-05,
    6.267181135324313e-06,
    8.953115907605790e-07,
)
# WGS84 authalic radius (km), first eccentricity squared, Web Mercator radius (m).
AUTHALIC_RADIUS_KM = 6371.0071809
ECCENTRICITY_SQ = 0.0066943799901413165
MERCATOR_RADIUS_M = 6378137.0

_CELL_MODE = 1 << 59


def resolution(cell: Column) -> Column:
    return F.shiftrightunsigned(cell, 52).bitwiseAND(F.lit(15)).cast("int")


def resolution_between(cell: Column, low: int, high: int) -> Column:
    """Resolution test as a plain id range.

    The resolution bits directly follow the mode bits, so cells of one resolution form one
    contiguous range of ids. Unlike a bit expression, the range reaches the Parquet scan as a
    pushed filter and skips row groups of files sorted by cell.
    """
    first = _CELL_MODE | (low << 52)
    last = (_CELL_MODE | ((high + 1) << 52)) - 1
    return cell.between(F.lit(first), F.lit(last))


def parent(cell: Column) -> Column:
    """Parent one level up; NULL for resolution 0."""
    res = resolution(cell)
    shift = (F.lit(45) - res * 3).cast("int")
    unused_digit = F.call_function("shiftleft", F.lit(7).cast("long"), shift)
    # lowering the resolution field by one is a subtraction, it never borrows for res >= 1
    return F.when(res >= 1, (cell - F.lit(1 << 52)).bitwiseOR(unused_digit))


def average_area(res: Column) -> Column:
    """Average cell area in km2 for a resolution column; NULL outside 0..15."""
    return F.get(F.array(*[F.lit(a) for a in AVG_AREA_KM2]), res)


def mercator(boundary: Column) -> Column:
    """lon/lat boundary to Web Mercator metres."""
    return F.transform(
        boundary,
        lambda p: F.struct(
            (F.radians(p["lon"]) * MERCATOR_RADIUS_M).alias("x"),
            (F.log(F.tan(F.radians(p["lat"]) / 2 + F.lit(3.141592653589793 / 4))) * MERCATOR_RADIUS_M)
            .alias("y"),
        ),
    )


def edges(boundary: Column, digits: int = 9) -> Column:
    """Directed edges of a closed boundary, as structs of (ax, ay, bx, by).

    Coordinates are rounded so that neighbours agree on shared vertices. Rounding can merge
    two vertices of a tiny cell; such zero-length edges are dropped.
    """
    points = F.transform(
        boundary,
        lambda p: F.struct(
            # adding zero turns -0.0 into 0.0, which would otherwise be a different vertex
            (F.round(p["lon"], digits) + F.lit(0.0)).alias("x"),
            (F.round(p["lat"], digits) + F.lit(0.0)).alias("y"),
        ),
    )
    shifted = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))
    pairs = F.zip_with(
        points,
        shifted,
        lambda a, b: F.struct(
            a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")
        ),
    )
    return F.filter(pairs, lambda e: (e["ax"] != e["bx"]) | (e["ay"] != e["by"]))


def _authalic_latitude(lat: Column) -> Column:
    """Geodetic latitude (degrees) to authalic latitude (radians), series in e^2."""
    phi = F.radians(lat)
    e2 = ECCENTRICITY_SQ
    return (
        phi
        - F.sin(phi * 2) * (e2 / 3 + 31 * e2**2 / 180 + 59 * e2**3 / 560)
        + F.sin(phi * 4) * (17 * e2**2 / 360 + 61 * e2**3 / 1260)
        - F.sin(phi * 6) * (383 * e2**3 / 45360)
    )


def area_km2(boundary: Column) -> Column:
    """Geodetic area of a closed lon/lat boundary, on the equal-area sphere of WGS84."""
    points = F.transform(
        boundary,
        lambda p: F.struct(
            F.radians(p["lon"]).alias("lam"), (F.tan(_authalic_latitude(p["lat"]) / 2)).alias("t")
        ),
    )
    shifted = F.concat(F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0))), F.slice(points, 1, 1))

    def turn(a: Column, b: Column) -> Column:
        d = b["lam"] - a["lam"]
        return F.atan2(F.sin(d), F.cos(d))  # wraps at the antimeridian

    parts = F.zip_with(
        points,
        shifted,
        lambda a, b: F.struct(
            turn(a, b).alias("turn"),
            (F.atan2(F.tan(turn(a, b) / 2) * (a["t"] + b["t"]), a["t"] * b["t"] + 1) * 2).alias("excess"),
        ),
    )

    def total(field: str) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda acc, e: acc + e[field])

    excess = F.abs(total("excess"))
    # a boundary that runs once around a pole encloses what the strip to the equator leaves over
    around_pole = F.abs(total("turn")) > 3.141592653589793
    return F.when(around_pole, F.lit(2 * 3.141592653589793) - excess).otherwise(excess) * (
        AUTHALIC_RADIUS_KM**2
    )
