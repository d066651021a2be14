"""Any GeoJSON geometry as one nested type: its points, its lines and its polygons.

``SHAPE`` holds what a Point, MultiPoint, LineString, MultiLineString, Polygon, MultiPolygon or
GeometryCollection (collections within collections up to ``DEPTH``) is made of. Polygons are
lists of rings as in ``millrace.operators.geo``: the first one outer, others holes, closed on
reading if they are not. What cannot be read has a text in ``error`` and no parts: an unknown or
missing type, coordinates that do not fit the type, or collections nested too deep. A missing
geometry is an empty shape without an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.operators import geo

POINT = "struct<x:double,y:double>"
SHAPE = f"struct<points:array<{POINT}>,lines:array<array<{POINT}>>,polygons:array<array<array<{POINT}>>>,error:string>"
DEPTH = 3

_GEOMETRY = "type string, coordinates string, geometries array<string>"


# The reader is one SQL expression: built call by call it would take seconds to put together.


def _line(points: str, name: str) -> str:
    return f"transform({points}, {name} -> named_struct('x', {name}[0], 'y', {name}[1]))"


def _polygon(rings: str, name: str) -> str:
    """Rings, closed where they are not."""
    r, p = f"{name}r", f"{name}p"
    return f"transform({rings}, {r} -> {_line(f'if({r}[0] = {r}[size({r}) - 1], {r}, concat({r}, array({r}[0])))', p)})"


def _part(points: str = "array()", lines: str = "array()", polygons: str = "array()", error: str = "null") -> str:
    return (
        f"named_struct('points', CAST({points} AS array<{POINT}>), 'lines', CAST({lines} AS array<array<{POINT}>>),"
        f" 'polygons', CAST({polygons} AS array<array<array<{POINT}>>>), 'error', CAST({error} AS string))"
    )


def _parts(text: str, depth: int) -> str:
    """The parts of a geometry text: an array of shapes, one for each simple geometry."""
    g, v, t = f"g{depth}", f"v{depth}", f"t{depth}"
    pair = lambda p: f"size({p}) >= 2 AND NOT exists({p}, {p}n -> {p}n IS NULL)"
    pairs = lambda l: f"forall({l}, {l}p -> {pair(f'{l}p')})"
    line = lambda l: f"size({l}) >= 2 AND {pairs(l)}"
    polygon = lambda r: f"size({r}) >= 1 AND forall({r}, {r}r -> size({r}r) >= 3 AND {pairs(f'{r}r')})"
    each = lambda fits: f"forall({v}, {v}i -> {fits(f'{v}i')})"
    kinds = [
        ("Point", 1, pair(v), _part(points=_line(f"array({v})", f"{v}a"))),
        ("MultiPoint", 2, pairs(v), _part(points=_line(v, f"{v}a"))),
        ("LineString", 2, line(v), _part(lines=f"array({_line(v, f'{v}a')})")),
        ("MultiLineString", 3, each(line), _part(lines=f"transform({v}, {v}b -> {_line(f'{v}b', f'{v}a')})")),
        ("Polygon", 3, polygon(v), _part(polygons=f"array({_polygon(v, f'{v}a')})")),
        ("MultiPolygon", 4, each(polygon), _part(polygons=f"transform({v}, {v}b -> {_polygon(f'{v}b', f'{v}a')})")),
    ]
    wrong = f"array({_part(error=f"concat('coordinates do not fit ', {g}.type)")})"
    cases = ""
    for name, dimensions, fits, made in kinds:
        read = f"from_json({g}.coordinates, '{'array<' * dimensions}double{'>' * dimensions}')"
        # Bound once, as the value is both tested and used.
        cases += f" WHEN '{name}' THEN transform(array({read}), {v} -> if(coalesce({fits}, false), array({made}), {wrong}))[0]"
    inner = f"array({_part(error="'collections nested too deep'")})"
    if depth:
        inner = f"flatten(transform(coalesce({g}.geometries, array()), {t} -> {_parts(t, depth - 1)}))"
    unknown = f"array({_part(error=f"concat('no geometry type ', coalesce({g}.type, ''))")})"
    read = f"CASE {g}.type WHEN 'GeometryCollection' THEN {inner}{cases} ELSE {unknown} END"
    # A null text is an empty geometry.
    return f"if({text} IS NULL, array({_part()}), transform(array(from_json({text}, '{_GEOMETRY}')), {g} -> {read})[0])"


def shape_of(text: str, depth: int = DEPTH) -> Column:
    """A column of GeoJSON geometry texts as ``SHAPE``."""
    merged = ", ".join(f"'{part}', concat(acc.{part}, p.{part})" for part in ("points", "lines", "polygons"))
    return F.expr(f"aggregate({_parts(text, depth)}, {_part()}, (acc, p) -> named_struct({merged}, 'error', coalesce(acc.error, p.error)))").cast(SHAPE)


def geometry_json(shape: Column | str) -> Column:
    """A shape as GeoJSON text: the simplest type that holds all its parts."""
    shape = F.col(shape) if isinstance(shape, str) else shape
    pair = lambda p: F.array(p["x"], p["y"])
    line = lambda l: F.transform(l, pair)
    polygon = lambda r: F.transform(r, line)
    points, lines, polygons = shape["points"], shape["lines"], shape["polygons"]
    of = lambda name, value: F.to_json(F.struct(F.lit(name).alias("type"), value.alias("coordinates")))

    def one_or_more(items: Column, single: str, make) -> Column:
        return F.when(F.size(items) == 1, of(single, make(items[0]))).otherwise(of("Multi" + single, F.transform(items, make)))

    kinds = [(points, one_or_more(points, "Point", pair)), (lines, one_or_more(lines, "LineString", line)), (polygons, one_or_more(polygons, "Polygon", polygon))]
    held = F.filter(F.array(*[F.when(F.size(items) > 0, text) for items, text in kinds]), lambda t: t.isNotNull())
    collection = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), F.array_join(held, ","), F.lit("]}"))
    return F.when(F.size(held) == 1, held[0]).otherwise(collection)


def area(shape: Column) -> Column:
    """Sum over the polygons, holes left out."""
    return F.aggregate(shape["polygons"], F.lit(0.0), lambda acc, rings: acc + geo.area(rings))


def contains(shape: Column, x: Column, y: Column) -> Column:
    """Is the point inside one of the polygons?"""
    return F.exists(shape["polygons"], lambda rings: geo.contains(geo.edges(rings), x, y))


def within(shape: Column, x: Column, y: Column) -> Column:
    return contains(shape, x, y)


def disjoint(shape: Column, x: Column, y: Column) -> Column:
    """Is the point outside all polygons?"""
    return ~contains(shape, x, y)


def distance(shape: Column, x: Column, y: Column) -> Column:
    """Distance from a point to the nearest part, 0 inside a polygon; null for an empty shape."""
    to_points = F.transform(shape["points"], lambda p: F.hypot(x - p["x"], y - p["y"]))
    segments = lambda line: geo.ring_edges(line)
    to_lines = F.transform(shape["lines"], lambda line: geo.edge_distance(segments(line), x, y))
    to_polygons = F.transform(shape["polygons"], lambda rings: geo.distance(geo.edges(rings), x, y))
    return F.array_min(F.concat(to_points, to_lines, to_polygons))
