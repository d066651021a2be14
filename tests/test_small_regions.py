"""Regions with few edges are covered by cells of their own size, not by one that holds them all."""

import pytest

from millrace.operators import cells, geo

SQUARE = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]


@pytest.mark.parametrize("ring", [SQUARE(517.0, 33.0, 5.0), [(300.0, 300.0), (306.0, 301.0), (302.0, 307.0), (300.0, 300.0)]])
def test_cells_are_small_beside_the_region(ring):
    found = cells.cover([ring], 0.0, 0.0, 1024.0, cells.MAX_LEVEL, cells.MAX_EDGES)
    width = max(p[0] for p in ring) - min(p[0] for p in ring)
    assert all(1024.0 / 2**level <= width for level, *_ in found)
    assert len(found) < 200 and any(whole for _, _, whole, _ in found)
    # Points are tested against the region's own edges, not against rounded parts of them.
    assert all(rings == [ring] for _, _, whole, rings in found if not whole)


def test_lists_stay_short_where_regions_are_many(spark):
    rings = [(i, f"r{i}", [[[{"x": a, "y": b} for a, b in SQUARE(i % 20 * 10.0, i // 20 * 10.0, 4.0)]]]) for i in range(400)]
    regions = spark.createDataFrame(rings, "code long, name string, polygons array<array<array<struct<x:double,y:double>>>>")
    covered = cells.cover_regions(regions, ["code", "name"], "polygons", (0.0, 0.0, 256.0)).cache()
    level = cells.join_level({r["level"]: r["count"] for r in covered.groupBy("level").count().collect()})
    longest = cells.listed(covered, ["code"], ["name"], level, cells.MAX_LEVEL).selectExpr("max(size(_cells))").first()[0]
    assert longest <= 4
    points = spark.createDataFrame([(i, i % 20 * 10.0 + d, i // 20 * 10.0 + d) for i in range(400) for d in (0.0, 3.9, 4.0)], "id long, x double, y double")
    found = geo.locate(points, regions, "id", "x", "y", "name", ["code"], "polygons")
    assert {(r["id"], r["name"]) for r in found.collect()} == {(i, f"r{i}") for i in range(400)} and found.count() == 800
