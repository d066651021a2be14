"""Points in regions by hierarchical cells.

A square around all regions is cut in four again and again. A region is covered by cells of this
tree: one that lies wholly inside needs no further test; one at the region's border is cut again
until it is small beside the region and the region clipped to it has few edges, and then holds just
these (those of the whole region, if they are few). Cells are numbered along
a space-filling curve (the bits of column and row in turn), on which a cell is an interval, so
points and cells meet by an equi-join on the interval's leading bits. Cells larger than these bits
tell are listed under each of their parts, smaller ones under the part that holds them; the level
is chosen from the number of cells of each size so that the listing stays in proportion.

All cells under one key come as one list in order of priority, which ends at the first that covers
the whole key: what comes later is never needed. So each point meets one row at most, whatever
regions overlap, and no point is shuffled to pick among its regions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import store

MAX_LEVEL = 20
MAX_EDGES = 8
# Cells at a region's border are at most a quarter of it wide: so a point meets few regions that
# are not at its place, and cells that lie wholly inside end most lists.
FINE = 4
# How often the list of cells may grow by listing large ones under their parts.
LISTING = 4

Ring = list[tuple[float, float]]


def clip(ring: Ring, axis: int, border: float, below: bool) -> Ring:
    """The part of a closed ring on one side of a line; borders run along the line."""
    out: Ring = []
    for a, b in zip(ring, ring[1:]):
        a_in = a[axis] <= border if below else a[axis] >= border
        b_in = b[axis] <= border if below else b[axis] >= border
        if a_in:
            out.append(a)
        if a_in != b_in and a[axis] != border and b[axis] != border:
            other = a[1 - axis] + (border - a[axis]) * (b[1 - axis] - a[1 - axis]) / (b[axis] - a[axis])
            out.append((border, other) if axis == 0 else (other, border))
    distinct = [p for i, p in enumerate(out) if not i or p != out[i - 1]]
    if len(distinct) > 1 and distinct[0] == distinct[-1]:
        distinct.pop()
    return [*distinct, distinct[0]] if len(distinct) >= 3 else []


def signed_area(ring: Ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def is_whole(rings: list[Ring], x0: float, y0: float, x1: float, y1: float) -> bool:
    """Do the rings fill the cell? Clipped corners are exactly those of the cell."""
    if len(rings) != 1:
        return False
    corners = {(x0, y0), (x1, y0), (x1, y1), (x0, y1)}
    return set(rings[0]) == corners and len(rings[0]) == 5


def cover(rings: list[Ring], x: float, y: float, size: float, max_level: int, max_edges: int) -> list[tuple[int, int, bool, list[Ring]]]:
    """(level, number along the curve, whole, rings) of the cells of a region in the square at
    (x, y)."""
    out = []
    open_cells = [(0, 0, x, y, size, rings)]
    few = sum(len(r) - 1 for r in rings) <= max_edges
    fine = max((max(p[axis] for p in r) - min(p[axis] for p in r) for r in rings for axis in (0, 1)), default=0.0) / FINE
    while open_cells:
        level, number, x0, y0, width, held = open_cells.pop()
        if is_whole(held, x0, y0, x0 + width, y0 + width):
            out.append((level, number, True, []))
        elif level == max_level or (width <= fine and sum(len(r) - 1 for r in held) <= max_edges):
            out.append((level, number, False, rings if few else held))
        else:
            half = width / 2
            for column, left in ((0, True), (1, False)):
                side = [c for r in held if (c := clip(r, 0, x0 + half, left))]
                for row, low in ((0, True), (1, False)):
                    part = [c for r in side if (c := clip(r, 1, y0 + half, low))]
                    # Rings that only touch the part have no area in it.
                    part = [r for r in part if signed_area(r)]
                    if part:
                        open_cells.append((level + 1, number << 2 | column << 1 | row, x0 + column * half, y0 + row * half, half, part))
    return out


def cover_regions(regions: DataFrame, columns: Sequence[str], polygons: str, box: tuple[float, float, float], max_level: int = MAX_LEVEL, max_edges: int = MAX_EDGES) -> DataFrame:
    """``columns`` with level, number, whole and rings of every cell of every region, whose
    ``polygons`` are lists of rings."""
    kept = regions.select(*columns, F.col(polygons).alias("_polygons"))
    ring = "array<array<struct<x:double,y:double>>>"
    schema = kept.drop("_polygons").withColumns({"level": F.lit(0), "number": F.lit(0).cast("long"), "whole": F.lit(True), "rings": F.lit(None).cast(ring)}).schema
    x, y, size = box

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                cells = []
                for polygon in one.column(one.num_columns - 1)[0].as_py() or []:
                    rings = [[(p["x"], p["y"]) for p in r] for r in polygon]
                    cells += cover([r for r in rings if len(r) > 3 and signed_area(r)], x, y, size, max_level, max_edges) if rings else []
                take = pa.array([0] * len(cells), pa.int64())
                held = [one.column(c).take(take) for c in range(one.num_columns - 1)]
                shown = [[[{"x": a, "y": b} for a, b in r] for r in c[3]] for c in cells]
                new = [[c[0] for c in cells], [c[1] for c in cells], [c[2] for c in cells], shown]
                arrays = [*held, *[pa.array(v, f.type) for v, f in zip(new, list(arrow)[-4:])]]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return kept.mapInArrow(run, schema)


def curve_number(column: Column, row: Column, levels: int) -> Column:
    """The bits of column and row in turn, by halving steps that spread them."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    if levels > 31:
        raise ValueError("at most 31 levels fit in a number")
    return F.shiftleft(spread(column), 1).bitwiseOR(spread(row))


def join_level(sizes: dict[int, int], listing: int = LISTING) -> int:
    """The finest level at which listing coarser cells by part keeps their number within
    ``listing`` times that of all cells."""
    total, best = sum(sizes.values()), 0
    for level in range(max(sizes, default=0) + 1):
        listed = sum(n * 4 ** max(0, level - own) for own, n in sizes.items())
        if listed <= listing * total:
            best = level
    return best


def listed(cells: DataFrame, priority: Sequence[str], payload: Sequence[str], level: int, max_level: int) -> DataFrame:
    """One row per key of ``level``: its cells in order of priority, up to the first that covers
    the whole key. A cell is an interval [lo, hi) on the curve of ``max_level``."""
    from millrace.operators.geo import edges

    coarse = F.greatest(F.lit(0), F.lit(level) - F.col("level"))
    first = F.expr(f"CASE WHEN level >= {level} THEN shiftright(number, CAST(2 * (level - {level}) AS INT)) ELSE shiftleft(number, CAST(2 * ({level} - level) AS INT)) END")
    parts = F.sequence(first, first + F.pow(F.lit(4), coarse).cast("long") - 1)
    spread = f"CAST(2 * ({max_level} - level) AS INT)"
    own = cells.select(
        F.explode(parts).alias("_key"),
        F.struct(
            F.struct(*priority).alias("priority"),
            F.expr(f"shiftleft(number, {spread})").alias("lo"),
            F.expr(f"shiftleft(number + 1, {spread})").alias("hi"),
            "whole",
            (F.col("whole") & (F.col("level") <= level)).alias("all"),
            edges(F.col("rings")).alias("edges"),
            *payload,
        ).alias("cell"),
    )
    # What stands behind a cell that fills the key can never be chosen: it goes before lists are made.
    fills = own.where("cell.all").groupBy("_key").agg(F.min("cell.priority").alias("_filled"))
    needed = own.join(fills, "_key", "left").where(F.col("_filled").isNull() | (F.col("cell.priority") <= F.col("_filled")))
    return needed.groupBy("_key").agg(F.array_sort(F.collect_list("cell"), lambda a, b: F.when(a["priority"] < b["priority"], -1).when(a["priority"] > b["priority"], 1).otherwise(0)).alias("_cells"))


def locate(points: DataFrame, regions: DataFrame, x: str, y: str, polygons: str, priority: Sequence[str], payload: Sequence[str], max_level: int = MAX_LEVEL, max_edges: int = MAX_EDGES) -> DataFrame:
    """Every row of ``points`` that lies in a region, with the ``payload`` columns of the first
    region by ``priority`` (columns, ascending)."""
    from millrace.operators.geo import contains

    corners = regions.select(F.explode(F.flatten(F.flatten(polygons))).alias("p"))
    b = corners.agg(F.min("p.x").alias("x0"), F.min("p.y").alias("y0"), F.max("p.x").alias("x1"), F.max("p.y").alias("y1")).first()
    if b["x0"] is None:
        return points.limit(0).withColumns({c: F.lit(None).cast(regions.schema[c].dataType) for c in payload})
    # A power of two, and a corner on the finest grid, so that borders of cells are exact numbers.
    extent = max(b["x1"] - b["x0"], b["y1"] - b["y0"], 2.0**-40)
    size = 2.0 ** math.ceil(math.log2(extent * (1 + 2.0 ** (1 - max_level))))
    unit = size / 2**max_level
    left, bottom = (math.floor(b[c] / unit) * unit for c in ("x0", "y0"))
    cells = store(cover_regions(regions, [*dict.fromkeys([*priority, *payload])], polygons, (left, bottom, size), max_level, max_edges), "cells")
    # At most one row per level.
    sizes = {r["level"]: r["count"] for r in cells.groupBy("level").count().collect()}
    level = join_level(sizes)
    keys = store(listed(cells, priority, payload, level, max_level), "cell-keys")
    place = lambda c, low: F.floor((F.col(c) - F.lit(low)) / F.lit(unit)).cast("long")
    column, row = place(x, left), place(y, bottom)
    inside = (column >= 0) & (row >= 0) & (column < 2**max_level) & (row < 2**max_level)
    placed = points.where(inside).withColumn("_z", curve_number(column, row, max_level))
    placed = placed.withColumn("_key", F.shiftright("_z", 2 * (max_level - level)))
    holds = lambda c: (c["lo"] <= F.col("_z")) & (F.col("_z") < c["hi"]) & (c["whole"] | contains(c["edges"], F.col(x), F.col(y)))
    # A generator runs the tests once for each point.
    found = placed.join(keys, "_key").select(*points.columns, F.explode(F.slice(F.filter("_cells", holds), 1, 1)).alias("_hit"))
    return found.select(*points.columns, *[F.col("_hit")[c].alias(c) for c in payload])
