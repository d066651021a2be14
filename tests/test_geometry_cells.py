"""Geometries of every type, and points in regions by cells against plain tests of every edge."""

import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import geometry
from millrace.operators import cells, geo
from millrace.sources import readers, writers

SQUARE = "[[0,0],[4,0],[4,4],[0,4],[0,0]]"
HOLE = "[[1,1],[2,1],[2,2],[1,2],[1,1]]"
FAR = "[[10,0],[12,0],[12,2],[10,2]]"  # not closed

TEXTS = {
    '{"type":"Point","coordinates":[1,2]}': (1, 0, 0, 0.0, None),
    '{"type":"MultiPoint","coordinates":[[1,2],[3,4]]}': (2, 0, 0, 0.0, None),
    '{"type":"LineString","coordinates":[[1,2],[3,4]]}': (0, 1, 0, 0.0, None),
    '{"type":"MultiLineString","coordinates":[[[1,2],[3,4]],[[0,0],[1,1]]]}': (0, 2, 0, 0.0, None),
    f'{{"type":"Polygon","coordinates":[{SQUARE},{HOLE}]}}': (0, 0, 1, 15.0, None),
    f'{{"type":"MultiPolygon","coordinates":[[{SQUARE},{HOLE}],[{FAR}]]}}': (0, 0, 2, 19.0, None),
    f'{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":[1,2]}},{{"type":"GeometryCollection","geometries":[{{"type":"Polygon","coordinates":[{FAR}]}}]}}]}}': (1, 0, 1, 4.0, None),
    '{"type":"GeometryCollection","geometries":[]}': (0, 0, 0, 0.0, None),
    '{"type":"Circle","coordinates":[1,2]}': (0, 0, 0, 0.0, "no geometry type Circle"),
    '{"coordinates":[1,2]}': (0, 0, 0, 0.0, "no geometry type "),
    '{"type":"Polygon","coordinates":[1,2]}': (0, 0, 0, 0.0, "coordinates do not fit Polygon"),
    '{"type":"Point"}': (0, 0, 0, 0.0, "coordinates do not fit Point"),
    '{"type":"LineString","coordinates":[[1,2]]}': (0, 0, 0, 0.0, "coordinates do not fit LineString"),
    None: (0, 0, 0, 0.0, None),
}


def measured(df):
    g = F.col("g")
    return df.select("text", F.size(g["points"]), F.size(g["lines"]), F.size(g["polygons"]), geometry.area(g), g["error"])


def test_every_type(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").withColumn("g", geometry.shape_of("text"))
    assert {r[0]: tuple(r)[1:] for r in measured(df).collect()} == TEXTS
    good = df.where("g.error IS NULL").withColumn("again", geometry.geometry_json("g")).withColumn("g", geometry.shape_of("again"))
    assert {r[0]: tuple(r)[1:] for r in measured(good).collect()} == {t: v for t, v in TEXTS.items() if v[-1] is None}
    deep = '{"type":"Point","coordinates":[1,2]}'
    for _ in range(geometry.DEPTH + 1):
        deep = f'{{"type":"GeometryCollection","geometries":[{deep}]}}'
    error = spark.createDataFrame([(deep,)], "text string").select(geometry.shape_of("text")["error"]).first()[0]
    assert error == "collections nested too deep"


def test_relations(spark):
    text = f'{{"type":"GeometryCollection","geometries":[{{"type":"Point","coordinates":[20,0]}},{{"type":"MultiPolygon","coordinates":[[{SQUARE},{HOLE}],[{FAR}]]}},{{"type":"LineString","coordinates":[[0,9],[4,9]]}}]}}'
    df = spark.createDataFrame([(text,)], "text string").withColumn("g", geometry.shape_of("text"))
    ask = lambda fn, x, y: df.select(fn(F.col("g"), F.lit(x), F.lit(y))).first()[0]
    assert ask(geometry.contains, 0.5, 0.5) and ask(geometry.within, 11.0, 1.0) and not ask(geometry.contains, 1.5, 1.5)
    assert ask(geometry.disjoint, 5.0, 1.0)
    assert ask(geometry.distance, 0.5, 0.5) == 0 and ask(geometry.distance, 20.0, 3.0) == 3.0
    assert ask(geometry.distance, 2.0, 8.5) == pytest.approx(0.5) and ask(geometry.distance, 1.5, 1.5) == pytest.approx(0.5)


def test_features_of_any_geometry_are_written(spark):
    text = f'{{"type":"FeatureCollection","features":[{{"type":"Feature","id":"a","properties":{{"name":"A"}},"geometry":{{"type":"MultiPolygon","coordinates":[[{SQUARE}],[{FAR}]]}}}},{{"type":"Feature","id":"b","properties":{{"name":"B"}},"geometry":null}}]}}'
    features = readers.features_of(spark.createDataFrame([(text,)], "t string"), "t")
    named = features.withColumn("name", F.col("properties")["name"]).drop("properties").coalesce(1)
    texts = writers.feature_collections(named, ["name"], 1)
    assert texts.count() == 2
    again = readers.features_of(texts, "value")
    assert sorted(map(str, again.select("id", "properties", "geometry").collect())) == sorted(map(str, features.select("id", "properties", "geometry").collect()))


def star(rng, x, y, n, big):
    """A closed ring around (x, y) that crosses itself nowhere."""
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(x + math.cos(a) * r, y + math.sin(a) * r) for a, r in ((a, big * rng.uniform(0.5, 1)) for a in angles)]
    return [*ring, ring[0]]


def plain_inside(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) > x:
                inside = not inside
    return inside


def test_cells_fill_the_region():
    """The areas of a region's cells are those of the region, and whole cells need no edges."""
    rng = random.Random(5)
    for n in (3, 8, 60, 300):
        rings = [star(rng, 30, 30, n, 25), star(rng, 30, 30, 5, 2)]
        found = cells.cover(rings, 0, 0, 64.0, 12, 8)
        area = sum((64 / 2**level) ** 2 if whole else abs(cells.signed_area(held[0])) if len(held) == 1 else 0 for level, _, whole, held in found)
        most = max((sum(len(r) - 1 for r in held) for level, _, whole, held in found if level < 12), default=0)
        assert most <= 8
        if n > 8:
            assert any(whole for _, _, whole, _ in found)
        assert area <= abs(cells.signed_area(rings[0])) + 1e-6


@pytest.mark.parametrize("max_level,max_edges", [(20, 8), (3, 4), (10, 50)])
def test_locate_equals_all_edges(spark, max_level, max_edges):
    rng = random.Random(max_level)
    regions = []
    for i in range(25):
        x, y, big = rng.uniform(-50, 50), rng.uniform(-50, 50), rng.choice([1, 5, 40])
        parts = [[star(rng, x, y, rng.choice([3, 10, 80]), big), star(rng, x, y, 6, big * 0.2)], [star(rng, x + 3 * big, y, 4, big * 0.5)]]
        regions.append((i % 4, f"r{i}", parts[: 1 + i % 2]))
    regions.append((9, "square", [[[(-64.0, -64.0), (64.0, -64.0), (64.0, 64.0), (-64.0, 64.0), (-64.0, -64.0)]]]))
    points = [(rng.randrange(50), rng.uniform(-120, 120), rng.uniform(-120, 120)) for _ in range(600)]
    # Points on borders of cells.
    points += [(7, x / 4 + 1e-3, y / 4 + 1e-3) for x in range(-40, 40, 7) for y in range(-40, 40, 7)]
    kind = "rank int, name string, parts array<array<array<struct<x:double,y:double>>>>"
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = cells.locate(df, spark.createDataFrame(regions, kind), "x", "y", "parts", ["rank", "name"], ["name"], max_level, max_edges)
    want = []
    for i, x, y in points:
        hits = [(rank, name) for rank, name, parts in regions if any(plain_inside(p, x, y) for p in parts)]
        if hits:
            want.append((i, x, y, min(hits)[1]))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_nothing_to_locate(spark):
    kind = "name string, parts array<array<array<struct<x:double,y:double>>>>"
    points = spark.createDataFrame([(1, 0.5, 0.5)], "id int, x double, y double")
    none = spark.createDataFrame([], kind)
    assert cells.locate(points, none, "x", "y", "parts", ["name"], ["name"]).collect() == []
    flat = spark.createDataFrame([("flat", [[[(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]])], kind)
    assert cells.locate(points, flat, "x", "y", "parts", ["name"], ["name"]).collect() == []
