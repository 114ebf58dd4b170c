"""Small hand-made facts for the tests."""

from hexstats import schemas

A, B, C, P = (f"00000000-0000-4000-8000-00000000000{i}" for i in "abcd")
IDS = schemas.SystemIds(population=P)


def cell(res, *digits, base=20):
    """Cell id from its resolution and digits; missing digits are 0."""
    bits = (1 << 59) | (res << 52) | (base << 45)
    for i in range(1, 16):
        digit = (digits[i - 1] if i <= len(digits) else 0) if i <= res else 7
        bits |= digit << (45 - 3 * i)
    return bits


def facts(spark, rows):
    return spark.createDataFrame([(h, i, float(v)) for h, i, v in rows], schemas.FACTS)


def axes(spark, *pairs):
    return spark.createDataFrame(list(pairs), "numerator_uuid string, denominator_uuid string")


def metadata(spark, *rows):
    """Rows as dicts; what is missing is NULL."""
    return spark.createDataFrame(
        [{"owner": "me", "is_base": False, "state": "READY", **row} for row in rows], schemas.METADATA
    )


def axis_table(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.AXIS)


def empty(spark, schema):
    return spark.createDataFrame([], schema)
