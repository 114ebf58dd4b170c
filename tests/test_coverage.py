import math
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from hexstats import schemas
from hexstats.operators import coverage
from tests.cells import A, B, IDS, cell, empty, facts, metadata


def hexagon(q, r):
    """Corners of a hexagon of a planar lattice, counter-clockwise."""
    x, y = math.sqrt(3) * (q + r / 2), 1.5 * r
    return [(x + math.cos(math.radians(60 * k + 30)), y + math.sin(math.radians(60 * k + 30))) for k in range(6)]


def _outline(spark, *places):
    cells = {cell(5, *divmod(i, 7)): p for i, p in enumerate(places)}
    boundary = spark.createDataFrame([(h, hexagon(*p), None) for h, p in cells.items()], schemas.CELL_BOUNDARY)
    data = facts(spark, [(h, A, 1) for h in cells])
    res = coverage.max_resolution(data, IDS)
    edges = coverage.outline_edges(data, res, boundary)
    return edges.count(), coverage.coverage_outline(edges).first().rings


def _area(ring):
    return sum(a.lon * b.lat - b.lon * a.lat for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def test_single_cell(spark):
    edges, rings = _outline(spark, (0, 0))
    assert edges == 6 and [len(r) for r in rings] == [6] and _area(rings[0]) > 0


def test_neighbours_share_no_edge(spark):
    edges, rings = _outline(spark, (0, 0), (1, 0))
    assert edges == 10 and [len(r) for r in rings] == [10]


def test_hole(spark):
    edges, rings = _outline(spark, (1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))
    assert edges == 24
    outer, hole = sorted(rings, key=_area, reverse=True)
    assert (len(outer), len(hole)) == (18, 6)
    assert _area(outer) > 0 > _area(hole)
    one = 3 * math.sqrt(3) / 2
    assert math.isclose(_area(outer), 7 * one, rel_tol=1e-6) and math.isclose(-_area(hole), one, rel_tol=1e-6)


def test_separate_cells(spark):
    _, rings = _outline(spark, (0, 0), (5, 0))
    assert sorted(len(r) for r in rings) == [6, 6]


def test_resolutions(spark):
    many = [(cell(8, *[(i // 7**k) % 7 for k in range(7, -1, -1)]), A, 1) for i in range(1001)]
    data = facts(spark, many + [(cell(3, 1), A, 1), (cell(4, 1), schemas.ONE_ID, 1)])
    assert [tuple(r) for r in coverage.max_resolution(data, IDS).collect()] == [(A, 8, 3)]
    found = coverage.max_resolution(facts(spark, many), IDS)
    assert [tuple(r) for r in found.collect()] == [(A, 8, None)]


def test_polygon_is_null_without_coverage_resolution(spark):
    meta = metadata(spark, {"internal_id": A, "max_res": 3}, {"internal_id": B, "max_res": 4})
    res = spark.createDataFrame([(A, 8, None)], "indicator_uuid string, max_res int, coverage_res int")
    rings = spark.createDataFrame([], "indicator_uuid string, rings array<array<struct<lon: double, lat: double>>>")
    rows = {r.internal_id: (r.max_res, r.coverage_polygon) for r in coverage.apply_coverage(meta, res, rings).collect()}
    assert rows == {A: (8, None), B: (4, None)}


def test_cell_geometry_takes_new_coarse_cells_of_recent_indicators(spark):
    now = datetime(2024, 1, 10)
    meta = metadata(
        spark, {"internal_id": A, "date": now - timedelta(days=1)}, {"internal_id": B, "date": now - timedelta(days=3)}
    )
    fresh, known, old, fine = cell(8, 1), cell(8, 2), cell(8, 3), cell(9, 1)
    data = facts(spark, [(fresh, A, 1), (known, A, 1), (old, B, 1), (fine, A, 1)])
    boundary = spark.createDataFrame([(h, [(0.0, 0.0), (1.0, 0.0)], None) for h in (fresh, known, old, fine)], schemas.CELL_BOUNDARY)
    existing = spark.createDataFrame([(known,)], "h3 long")
    found = coverage.cell_geometry(data, meta, existing, boundary, now).collect()
    assert [(r.h3, r.resolution) for r in found] == [(fresh, 8)]


def _polygons(spark, rings):
    table = spark.createDataFrame([(rings,)], "rings array<array<struct<lon: double, lat: double>>>")
    return table.select(coverage.polygons(F.col("rings")).alias("found")).first().found


def _square(x, y, size, *, hole=False):
    x, y, size = map(float, (x, y, size))
    ring = [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]
    return ring[::-1] if hole else ring


def test_holes_belong_to_the_smallest_shell_around_them(spark):
    lake, island, pond, far = _square(2, 2, 16, hole=True), _square(5, 5, 10), _square(6, 6, 2, hole=True), _square(50, 0, 4)
    second = _square(0.5, 0.5, 1, hole=True)
    found = _polygons(spark, [pond, far, lake, _square(0, 0, 20), island, second])
    plain = [[[tuple(p) for p in ring] for ring in polygon] for polygon in found]
    assert plain == [[_square(0, 0, 20), lake, second], [island, pond], [far]] or plain == [[_square(0, 0, 20), second, lake], [island, pond], [far]]


def test_polygons_of_nothing(spark):
    assert _polygons(spark, None) is None and _polygons(spark, []) == []


def test_a_covered_area_is_stored_with_its_holes(spark):
    places = [(1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1), (9, 9)]
    cells = {cell(5, *divmod(i, 7)): p for i, p in enumerate(places)}
    boundary = spark.createDataFrame([(h, hexagon(*p), None) for h, p in cells.items()], schemas.CELL_BOUNDARY)
    data = facts(spark, [(h, A, 1) for h in cells])
    found = coverage.max_resolution(data, IDS)
    outlines = coverage.coverage_outline(coverage.outline_edges(data, found, boundary))
    row = coverage.apply_coverage(metadata(spark, {"internal_id": A}), found, outlines).first()
    assert [[len(ring) for ring in polygon] for polygon in row.coverage_polygon] == [[18, 6], [6]]
