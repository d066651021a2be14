"""Points and polygons. A polygon is a list of rings, the first one outer, others holes:
``rings array<array<struct<x double, y double>>>``; rings are closed (last point = first).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import cells
from millrace.ordered import Ordered

RINGS = "array<array<struct<x:double,y:double>>>"


def ring_edges(ring: Column) -> Column:
    """Edges ``(x1, y1, x2, y2)`` of a closed ring."""
    return F.transform(
        F.slice(ring, F.lit(2), F.size(ring) - 1),
        lambda p, i: F.struct(
            ring[i]["x"].alias("x1"), ring[i]["y"].alias("y1"), p["x"].alias("x2"), p["y"].alias("y2")
        ),
    )


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def area(rings: Column) -> Column:
    """Area of the outer ring less the holes."""

    def shoelace(ring: Column) -> Column:
        doubled = F.aggregate(
            ring_edges(ring), F.lit(0.0), lambda acc, e: acc + e["x1"] * e["y2"] - e["x2"] * e["y1"]
        )
        return F.abs(doubled) / 2

    holes = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return shoelace(rings[0]) - F.aggregate(holes, F.lit(0.0), lambda acc, r: acc + shoelace(r))


def contains(edge_list: Column, x: Column, y: Column) -> Column:
    """Is the point inside? A ray to the right crosses the edges an odd number of times."""

    def crossed(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        # which side of the edge the point is on; no division, so level edges do no harm
        side = (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])
        return spans & ((side > 0) == (e["y2"] > e["y1"]))

    return F.aggregate(edge_list, F.lit(False), lambda inside, e: inside != crossed(e))


def within(edge_list: Column, x: Column, y: Column) -> Column:
    """Point within polygon: the same question from the point's side."""
    return contains(edge_list, x, y)


def disjoint(edge_list: Column, x: Column, y: Column) -> Column:
    return ~contains(edge_list, x, y)


def edge_distance(edge_list: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the nearest edge."""

    def to_edge(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        length = dx * dx + dy * dy
        along = F.when(length == 0, F.lit(0.0)).otherwise(((x - e["x1"]) * dx + (y - e["y1"]) * dy) / length)
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        return F.hypot(x - e["x1"] - t * dx, y - e["y1"] - t * dy)

    return F.array_min(F.transform(edge_list, to_edge))


def distance(edge_list: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the polygon, 0 inside."""
    return F.when(contains(edge_list, x, y), F.lit(0.0)).otherwise(edge_distance(edge_list, x, y))


def sorted_features(features: DataFrame, code: str) -> DataFrame:
    """Features by (code, larger area first)."""
    return features.withColumn("area", area(F.col("rings"))).orderBy(code, F.desc("area"))


def placed_features(features: DataFrame, code: str, size: Column, key: str, limit: int | None = None) -> DataFrame:
    """Features with their ``area`` and their ``place``, from 1, in order of (code, larger area
    first, key)."""
    sized = features.withColumns({"area": size, "_less": -size})
    return Ordered.of(sized, [], [code, "_less", key], limit).position("place").df.drop("_less")


def locate(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    x: str,
    y: str,
    name: str,
    priority: Sequence[str] = (),
    rings: str = "rings",
) -> DataFrame:
    """``(point_id, name)`` of the first polygon, by ``priority`` (ascending) and then by
    larger area, that contains the point; points outside all polygons are left out, points that
    share an id stay rows of their own.

    Points and polygons meet in cells of a tree (see ``cells.locate``). With ``rings`` of more
    dimensions, as in a shape's ``polygons``, regions may have several parts.
    """
    several = polygons.schema[rings].dataType.simpleString().count("array") == 3
    parts = F.col(rings) if several else F.array(rings)
    size = F.aggregate(parts, F.lit(0.0), lambda acc, r: acc + area(r))
    regions = polygons.select(F.col(name), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(priority)], (-size).alias("_less"), parts.alias("_parts"))
    order = [*[f"_p{i}" for i in range(len(priority))], "_less", name]
    found = cells.locate(points.select(point_id, F.col(x).alias("_x"), F.col(y).alias("_y")), regions, "_x", "_y", "_parts", order, [name])
    return found.select(point_id, name)
