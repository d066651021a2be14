"""Queries for routing (R), graphs (G), places (J07, F08-F10) and user functions (X)."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import geometry, udf
from millrace.operators import aggs, geo, routing
from millrace.operators.graph import Graph
from millrace.plans.registry import query, table
from millrace.session import spread
from millrace.sources import readers, writers

ORDER = ["ts", "event_id"]


def _events(spark, sf, *columns):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", *columns)


# -- routing ------------------------------------------------------------------


@query("r01_round_robin", "SELECT event_id, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) % 4 AS INT) AS channel FROM events")
def _(spark, sf):
    return routing.round_robin(_events(spark, sf), 4, ORDER).select("event_id", "channel")


@query("r02_by_hash")
def _(spark, sf):
    routed = routing.by_hash(_events(spark, sf), 8, "user_id")
    return routed.groupBy("channel").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("r02_by_number", "SELECT CAST(user_id % 8 AS INT) AS channel, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    shard = routing.shard(F.col("user_id"), 8).alias("channel")
    return table(spark, sf, "events").groupBy(shard).agg(F.count(F.lit(1)).alias("n"))


def _ring_sql(nodes: str, name: str) -> str:
    """Each user's node: the ring point with the smallest hash at or above its own."""
    return f"""
    {name}_p AS (SELECT min(node) AS node, h FROM (SELECT node, CAST(concat('0x', substr(md5(concat(node, ':', r)), 1, 8)) AS BIGINT) AS h
                 FROM (SELECT unnest([{nodes}]) AS node), range(1, 11) AS t(r)) GROUP BY h),
    {name} AS (SELECT user_id, coalesce(arg_min(node, h) FILTER (h >= u), (SELECT arg_min(node, h) FROM {name}_p)) AS node
               FROM (SELECT DISTINCT user_id, CAST(concat('0x', substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) AS u FROM events), {name}_p
               GROUP BY user_id)
    """


@query(
    "r03_consistent_hash",
    f"WITH {_ring_sql(repr(['n0', 'n1', 'n2', 'n3', 'n4'])[1:-1], 'a')} SELECT event_id, user_id, node FROM events JOIN a USING (user_id)",
)
def _(spark, sf):
    df = routing.consistent_hash(_events(spark, sf), "user_id", ["n0", "n1", "n2", "n3", "n4"])
    return df.select("event_id", "user_id", "node")


@query(
    "r03_moved_keys",
    f"""
    WITH {_ring_sql(repr(['n0', 'n1', 'n2', 'n3', 'n4'])[1:-1], 'a')}, {_ring_sql(repr(['n0', 'n1', 'n2', 'n3'])[1:-1], 'b')}
    SELECT count(*) AS n_keys, count(*) FILTER (a.node <> b.node) AS n_moved FROM a JOIN b USING (user_id)
    """,
)
def _(spark, sf):
    return routing.moved_keys(table(spark, sf, "events"), "user_id", ["n0", "n1", "n2", "n3", "n4"], ["n0", "n1", "n2", "n3"])


@query("r04_balance_and_merge", "SELECT event_id, round(value * 2, 2) AS work FROM events")
def _(spark, sf):
    work = lambda part: part.select("event_id", F.round(F.col("value") * 2, 2).alias("work"))
    return routing.balance_and_merge(_events(spark, sf, "value"), 8, work)


@query(
    "r05_in_sequence",
    """
    SELECT event_id, user_id, row_number() OVER w AS nth, event_id - coalesce(lag(event_id) OVER w, 0) AS step
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def _(spark, sf):
    def step(state, event_id):
        n, last = state
        return (n + 1, event_id), (n + 1, event_id - last)

    outputs = [("nth", T.LongType()), ("step", T.LongType())]
    return routing.in_sequence(_events(spark, sf), "user_id", ORDER, ["event_id"], (0, 0), step, outputs).drop("ts")


# -- graph: customers buy from suppliers, suppliers deliver parts ----------------
# Vertex ids: customers from 0, suppliers from 10^12, parts from 2 * 10^12.

_S, _P = 10**12, 2 * 10**12

_VERTICES = f"""
    SELECT CAST(c_custkey AS BIGINT) AS id, c_mktsegment AS label FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT {_S} + s_suppkey, 'supplier' FROM supplier
    UNION ALL SELECT {_P} + p_partkey, p_type FROM part
"""
_EDGES = f"""
    SELECT DISTINCT CAST(o_custkey AS BIGINT) AS src, {_S} + l_suppkey AS dst, 'buys' AS label FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    UNION ALL SELECT DISTINCT {_S} + l_suppkey, {_P} + l_partkey, 'delivers' FROM lineitem
"""
_GRAPH = f"""
    WITH RECURSIVE v AS ({_VERTICES}),
    e AS (SELECT src, dst, label FROM ({_EDGES}) WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v))
"""


def _graph(spark, sf):
    customer, supplier, part = (table(spark, sf, t) for t in ("customer", "supplier", "part"))
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    vertices = (
        customer.where("c_acctbal > 0").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_mktsegment").alias("label"))
        .unionByName(supplier.select((F.col("s_suppkey") + _S).alias("id"), F.lit("supplier").alias("label")))
        .unionByName(part.select((F.col("p_partkey") + _P).alias("id"), F.col("p_type").alias("label")))
    )
    lines = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_partkey")
    # Counted from the footers of the files.
    n = max(orders.count(), lineitem.count())
    buys = spread(orders.select("o_orderkey", "o_custkey"), n, "o_orderkey").join(spread(lines, n, "o_orderkey"), "o_orderkey").select(
        F.col("o_custkey").cast("long").alias("src"), (F.col("l_suppkey") + _S).alias("dst"), F.lit("buys").alias("label")
    )
    delivers = lines.select((F.col("l_suppkey") + _S).alias("src"), (F.col("l_partkey") + _P).alias("dst"), F.lit("delivers").alias("label"))
    edges = [spread(e, n, "src", "dst").distinct() for e in (buys, delivers)]
    return Graph.build(vertices, edges[0].unionByName(edges[1]), 2 * n)


@query("g01_build", f"{_GRAPH} SELECT src, dst, label FROM e")
def _(spark, sf):
    return _graph(spark, sf).edges


@query(
    "g02_reachable",
    f"{_GRAPH}, r AS (SELECT id FROM v WHERE id = 7 UNION SELECT dst FROM r JOIN e ON src = id) SELECT id FROM r",
)
def _(spark, sf):
    return _graph(spark, sf).reachable(7)


@query(
    "g03_select_with_edges",
    f"""
    {_GRAPH}, f AS (SELECT id FROM v WHERE label = 'AUTOMOBILE' OR label = 'supplier')
    SELECT 'in' AS side, src, dst FROM e WHERE dst IN (SELECT id FROM f)
    UNION ALL SELECT 'out', src, dst FROM e WHERE src IN (SELECT id FROM f)
    """,
)
def _(spark, sf):
    _, incoming, outgoing = _graph(spark, sf).stored().select(F.col("label").isin("AUTOMOBILE", "supplier"))
    sides = incoming.withColumn("side", F.lit("in")).unionByName(outgoing.withColumn("side", F.lit("out")))
    return sides.select("side", "src", "dst")


@query("g04_without_node", f"{_GRAPH} SELECT src, dst, label FROM e WHERE src <> {_S} AND dst <> {_S}")
def _(spark, sf):
    return _graph(spark, sf).without(_S).edges


@query(
    "g05_degrees",
    f"{_GRAPH} SELECT id, count(x) AS degree FROM v LEFT JOIN (SELECT src AS x FROM e UNION ALL SELECT dst FROM e) ON x = id GROUP BY 1",
)
def _(spark, sf):
    return _graph(spark, sf).degrees()


@query("g06_neighbours", f"{_GRAPH} SELECT src AS id, dst AS neighbour FROM e UNION SELECT dst, src FROM e")
def _(spark, sf):
    return _graph(spark, sf).neighbours()


@query(
    "g07_totals",
    f"{_GRAPH} SELECT CAST((SELECT sum(id) FROM v) AS BIGINT) AS id_sum, (SELECT count(*) FROM v) AS n_vertices, (SELECT count(*) FROM e) AS n_edges",
)
def _(spark, sf):
    return _graph(spark, sf).totals()


@query("g08_reverse", f"{_GRAPH} SELECT dst AS src, src AS dst, label FROM e")
def _(spark, sf):
    return _graph(spark, sf).reverse().edges


@query(
    "g09_adjacent_by_label",
    f"{_GRAPH} SELECT src AS id, dst AS adjacent FROM e WHERE label = 'buys' UNION SELECT dst, src FROM e WHERE label = 'buys'",
)
def _(spark, sf):
    return _graph(spark, sf).adjacent("buys")


# -- places: four small polygons as reference data, points from the events --------

BOROUGHS = """{"type": "FeatureCollection", "features": [
 {"type": "Feature", "id": "1", "properties": {"borough": "Island", "boroughCode": "1"},
  "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [40, 0], [40, 40], [0, 40], [0, 0]], [[10, 10], [20, 10], [20, 20], [10, 20], [10, 10]]]}},
 {"type": "Feature", "id": "2", "properties": {"borough": "Core", "boroughCode": "1"},
  "geometry": {"type": "Polygon", "coordinates": [[[25, 25], [35, 25], [35, 35], [25, 35], [25, 25]]]}},
 {"type": "Feature", "id": "3", "properties": {"borough": "East", "boroughCode": "2"},
  "geometry": {"type": "Polygon", "coordinates": [[[30, 5], [90, 10], [70, 60], [30, 5]]]}},
 {"type": "Feature", "id": "4", "properties": {"borough": "North", "boroughCode": "3"},
  "geometry": {"type": "Polygon", "coordinates": [[[0, 50], [50, 45], [60, 95], [20, 70], [0, 95], [0, 50]]]}}
]}"""

# The same polygons as edges for SQL: (code, name, area, x1, y1, x2, y2).
_EDGE_ROWS = """
    (VALUES (1,'Island',1500,0,0,40,0),(1,'Island',1500,40,0,40,40),(1,'Island',1500,40,40,0,40),(1,'Island',1500,0,40,0,0),
            (1,'Island',1500,10,10,20,10),(1,'Island',1500,20,10,20,20),(1,'Island',1500,20,20,10,20),(1,'Island',1500,10,20,10,10),
            (1,'Core',100,25,25,35,25),(1,'Core',100,35,25,35,35),(1,'Core',100,35,35,25,35),(1,'Core',100,25,35,25,25),
            (2,'East',1550,30,5,90,10),(2,'East',1550,90,10,70,60),(2,'East',1550,70,60,30,5),
            (3,'North',1875,0,50,50,45),(3,'North',1875,50,45,60,95),(3,'North',1875,60,95,20,70),(3,'North',1875,20,70,0,95),(3,'North',1875,0,95,0,50)
    ) AS t(code, name, area, x1, y1, x2, y2)
"""
_POINTS = "SELECT event_id, CAST(user_id % 97 AS DOUBLE) + 0.37 AS x, value / 5 + 0.0013 AS y FROM events"
_INSIDE = f"""
    SELECT event_id, code, name, area,
           sum(CASE WHEN (y1 > y) <> (y2 > y) THEN CASE WHEN x < (x2 - x1) * (y - y1) / CAST(y2 - y1 AS DOUBLE) + x1 THEN 1 ELSE 0 END ELSE 0 END) % 2 = 1 AS inside
    FROM ({_POINTS}), {_EDGE_ROWS} GROUP BY ALL
"""


def _boroughs(spark):
    text = spark.createDataFrame([(BOROUGHS,)], "value string")
    return readers.features_of(text, "value").select(
        "id", F.col("properties")["borough"].alias("name"), F.col("properties")["boroughCode"].cast("int").alias("code"), "rings"
    )


def _points(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", ((F.col("user_id") % 97).cast("double") + 0.37).alias("x"), (F.col("value") / 5 + 0.0013).alias("y")
    )


@query("j07_point_in_polygon", f"SELECT event_id, arg_min(name, (code, -area)) AS name FROM ({_INSIDE}) WHERE inside GROUP BY 1")
def _(spark, sf):
    return geo.locate(_points(spark, sf), _boroughs(spark), "event_id", "x", "y", "name", ["code"])


@query(
    "a10_histogram_by_region",
    f"SELECT name, count(*) AS n FROM (SELECT event_id, arg_min(name, (code, -area)) AS name FROM ({_INSIDE}) WHERE inside GROUP BY 1) GROUP BY 1",
)
def _(spark, sf):
    located = geo.locate(_points(spark, sf), _boroughs(spark), "event_id", "x", "y", "name", ["code"])
    return aggs.histogram(located, "name")


# Shapes from the table of suppliers: a square of side w at (x, y), with a hole, with a second
# square, both within nested collections, or alone; some of a type that does not exist.
_SIZED = "SELECT s_suppkey AS k, s_name, s_nationkey, s_nationkey % 7 + 2 AS w, s_suppkey % 10 * 20 AS x, s_suppkey // 10 % 10 * 20 AS y FROM supplier"
_AREA = "CASE WHEN k % 11 = 5 THEN 0 WHEN k % 4 = 0 THEN w * w - 1 WHEN k % 4 IN (1, 2) THEN w * w + 1 ELSE w * w END::DOUBLE"


def _shape_texts(spark, sf):
    sized = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS k", "s_name", "s_nationkey", "s_nationkey % 7 + 2 AS w", "s_suppkey % 10 * 20 AS x", "s_suppkey div 10 % 10 * 20 AS y"
    )

    def square(dx: int, dy: int, side) -> Column:
        x0, y0 = F.col("x") + dx, F.col("y") + dy
        return F.to_json(F.array(*[F.array(a, b) for a, b in ((x0, y0), (x0 + side, y0), (x0 + side, y0 + side), (x0, y0 + side), (x0, y0))]))

    text = lambda kind, *parts: F.concat(F.lit(f'{{"type":"{kind}","coordinates":['), *parts, F.lit("]}"))
    comma, outer, hole, far = F.lit(","), square(0, 0, F.col("w")), square(1, 1, F.lit(1)), square(12, 12, F.lit(1))
    nested = F.concat(
        F.lit('{"type":"GeometryCollection","geometries":['), text("Point", F.col("x"), comma, F.col("y")), comma, text("Polygon", outer), comma,
        F.lit('{"type":"GeometryCollection","geometries":['), text("LineString", F.lit("[0,0],[1,1]")), comma, text("Polygon", far), F.lit("]}]}"),
    )
    shape = (
        F.when(F.expr("k % 11 = 5"), F.lit('{"type":"Blob","coordinates":[1]}'))
        .when(F.expr("k % 4 = 0"), text("Polygon", outer, comma, hole))
        .when(F.expr("k % 4 = 1"), text("MultiPolygon", F.lit("["), outer, F.lit("],["), far, F.lit("]")))
        .when(F.expr("k % 4 = 2"), nested)
        .otherwise(text("Polygon", outer))
    )
    return sized.withColumn("text", shape)


def _shapes(spark, sf):
    return _shape_texts(spark, sf).withColumn("shape", geometry.shape_of("text")).drop("text")


@query("f08_area_of_regions", f"SELECT k, {_AREA} AS area FROM ({_SIZED})")
def _(spark, sf):
    return _shapes(spark, sf).select("k", geometry.area(F.col("shape")).alias("area"))


_PLACES = "SELECT event_id, (user_id % 200)::DOUBLE + 0.37 AS px, value / 2.5 + 0.0013 AS py FROM events"
_IN_SHAPE = f"""
    SELECT *, k % 11 <> 5 AND ((px > x AND px < x + w AND py > y AND py < y + w AND NOT (k % 4 = 0 AND px > x + 1 AND px < x + 2 AND py > y + 1 AND py < y + 2))
        OR (k % 4 IN (1, 2) AND px > x + 12 AND px < x + 13 AND py > y + 12 AND py < y + 13)) AS inside, {_AREA} AS area
    FROM ({_PLACES}), ({_SIZED})
"""
_FIRST_SHAPE = f"SELECT event_id, arg_min(s_name, (s_nationkey, -area, s_name)) AS s_name FROM ({_IN_SHAPE}) WHERE inside GROUP BY 1"


def _places(spark, sf):
    x, y = (F.col("user_id") % 200).cast("double") + 0.37, F.col("value") / 2.5 + 0.0013
    return table(spark, sf, "events").select("event_id", x.alias("px"), y.alias("py"))


def _located(spark, sf):
    regions = _shapes(spark, sf).select("s_name", "s_nationkey", F.col("shape.polygons").alias("polygons"))
    return geo.locate(_places(spark, sf), regions, "event_id", "px", "py", "s_name", ["s_nationkey"], "polygons")


@query("j07_point_in_shape", _FIRST_SHAPE)
def _(spark, sf):
    return _located(spark, sf)


@query("a10_histogram_by_shape", f"SELECT s_name, count(*) AS n FROM ({_FIRST_SHAPE}) GROUP BY 1")
def _(spark, sf):
    return aggs.histogram(_located(spark, sf), "s_name")


@query(
    "f10_shape_relations",
    f"SELECT event_id, k, inside AS contains, inside AS within, NOT inside AS disjoint FROM ({_IN_SHAPE}) WHERE k = event_id % 10 + 1",
)
def _(spark, sf):
    args = F.col("shape"), F.col("px"), F.col("py")
    paired = _places(spark, sf).withColumn("k", F.col("event_id") % 10 + 1).join(_shapes(spark, sf), "k")
    return paired.select("event_id", "k", geometry.contains(*args).alias("contains"), geometry.within(*args).alias("within"), geometry.disjoint(*args).alias("disjoint"))


def _paired(spark, sf):
    """Each point with one polygon, by number."""
    regions = _boroughs(spark).select(F.col("id").cast("long").alias("id"), geo.edges(F.col("rings")).alias("edges"))
    return _points(spark, sf).withColumn("id", F.col("event_id") % 4 + 1).join(F.broadcast(regions), "id")  # four rows


_PAIRED = f"""
    SELECT event_id, inside FROM ({_INSIDE}) WHERE CASE name WHEN 'Island' THEN 1 WHEN 'Core' THEN 2 WHEN 'East' THEN 3 ELSE 4 END = event_id % 4 + 1
"""


@query(
    "f09_distance_to_region",
    f"""
    SELECT event_id, round(CASE WHEN inside THEN 0.0 ELSE d END, 6) AS distance
    FROM ({_PAIRED}) JOIN (
      SELECT event_id, min(sqrt((x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2)) AS d
      FROM (SELECT *, greatest(0.0, least(1.0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / CAST((x2 - x1) ** 2 + (y2 - y1) ** 2 AS DOUBLE))) AS t
            FROM ({_POINTS}), {_EDGE_ROWS}
            WHERE CASE name WHEN 'Island' THEN 1 WHEN 'Core' THEN 2 WHEN 'East' THEN 3 ELSE 4 END = event_id % 4 + 1)
      GROUP BY 1) USING (event_id)
    """,
)
def _(spark, sf):
    d = geo.distance(F.col("edges"), F.col("x"), F.col("y"))
    return _paired(spark, sf).select("event_id", F.round(d, 6).alias("distance"))


@query("f10_contains_within_disjoint", f"SELECT event_id, inside AS contains, inside AS within, NOT inside AS disjoint FROM ({_PAIRED})")
def _(spark, sf):
    args = F.col("edges"), F.col("x"), F.col("y")
    return _paired(spark, sf).select(
        "event_id", geo.contains(*args).alias("contains"), geo.within(*args).alias("within"), geo.disjoint(*args).alias("disjoint")
    )


@query(
    "l02_sorted_features",
    f"SELECT row_number() OVER (ORDER BY s_nationkey, area DESC, k) AS place, k, s_nationkey, area FROM (SELECT *, {_AREA} AS area FROM ({_SIZED}))",
)
def _(spark, sf):
    """The place of each feature in order of (code, larger area first), ties by key."""
    return geo.placed_features(_shapes(spark, sf), "s_nationkey", geometry.area(F.col("shape")), "k").select("place", "k", "s_nationkey", "area")


@query(
    "s04_geojson_features",
    f"""
    SELECT k::VARCHAR AS id, s_name, CASE WHEN k % 11 <> 5 AND k % 4 = 2 THEN 1 ELSE 0 END AS n_points, CASE WHEN k % 11 <> 5 AND k % 4 = 2 THEN 1 ELSE 0 END AS n_lines,
        CASE WHEN k % 11 = 5 THEN 0 WHEN k % 4 IN (1, 2) THEN 2 ELSE 1 END AS n_polygons, {_AREA} AS area,
        CASE WHEN k % 11 = 5 THEN 'no geometry type Blob' END AS error
    FROM ({_SIZED})
    """,
)
def _(spark, sf):
    """Collection texts with every kind of geometry, read, written as GeoJSON and read again."""
    texts = _shape_texts(spark, sf).select(
        F.format_string('{"type":"FeatureCollection","features":[{"type":"Feature","id":%s,"properties":{"s_name":"%s"},"geometry":%s}]}', "k", "s_name", "text").alias("value")
    )
    features = readers.features_of(texts, "value")
    written = features.withColumn("written", geometry.geometry_json("geometry"))
    again = written.select("id", "properties", F.when(F.col("geometry.error").isNull(), geometry.shape_of("written")).otherwise(F.col("geometry")).alias("g"))
    return again.select(
        "id", F.col("properties")["s_name"].alias("s_name"), F.size("g.points").alias("n_points"), F.size("g.lines").alias("n_lines"),
        F.size("g.polygons").alias("n_polygons"), geometry.area(F.col("g")).alias("area"), F.col("g.error").alias("error"),
    )


@query(
    "s05_geojson_write",
    """
    SELECT concat('{"type":"Feature","id":"', s_suppkey, '","properties":{"s_name":"', s_name,
                  '"},"geometry":{"type":"Polygon","coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,', s_nationkey + 1, '.0],[0.0,0.0]]]}}') AS feature
    FROM supplier
    """,
)
def _(spark, sf):
    from millrace.session import scratch_path

    ring = "array(array(struct(0D AS x, 0D AS y), struct(1D AS x, 0D AS y), struct(1D AS x, CAST(s_nationkey + 1 AS DOUBLE) AS y), struct(0D AS x, 0D AS y)))"
    df = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", F.expr(ring).alias("rings"))
    path = scratch_path(spark, "features")
    writers.write_features(df, path, ["s_name"])
    return spark.read.text(path).withColumnRenamed("value", "feature")


# -- user functions -------------------------------------------------------------


@query("x01_map_ordered", "SELECT event_id, round(value * 1.1, 4) AS y FROM events")
def _(spark, sf):
    def scale(s: pd.Series) -> pd.Series:
        return (s * 1.1).round(4)

    return udf.map_ordered(table(spark, sf, "events").select("event_id", "value"), scale, "value", "y", "double").drop("value")


@query("x02_map_unordered", "SELECT event_id, user_id + 1 AS y FROM events")
def _(spark, sf):
    work = lambda pdf: pd.DataFrame({"event_id": pdf.event_id, "y": pdf.user_id + 1})
    return udf.map_unordered(table(spark, sf, "events").select("event_id", "user_id"), work, "event_id long, y long")


@query("x03_chunk_function", "SELECT CAST(sum(user_id) AS BIGINT) AS total, count(*) AS n FROM events")
def _(spark, sf):
    work = lambda pdf: pd.DataFrame({"total": [int(pdf.user_id.sum())], "n": [len(pdf)]})
    chunks = udf.map_chunks(table(spark, sf, "events").select("user_id"), 64, work, "total long, n long")
    return chunks.agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


@query("x04_monoid_aggregate", "SELECT user_id, bit_xor(event_id) AS result FROM events GROUP BY 1")
def _(spark, sf):
    return udf.monoid_aggregate(table(spark, sf, "events"), "event_id", 0, lambda a, b: a ^ b, T.LongType(), "user_id")


@query("x05_table_function", "SELECT doc_id, unnest(string_split(lang || '-' || source, '-')) AS part FROM documents")
def _(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", F.concat_ws("-", "lang", "source").alias("t"))
    return udf.explode_with(df, lambda c: F.split(c, "-"), "t", "part").drop("t")


@query("x07_reusable_piece", "SELECT event_type, count(*) AS n FROM events WHERE value > 50 GROUP BY 1")
def _(spark, sf):
    piece = udf.piece(lambda d: d.where("value > 50"), lambda d: d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))
    return table(spark, sf, "events").transform(piece)


@query("x08_carried_context", "SELECT event_id, user_id, round(value / 2, 3) AS half FROM events")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "value")
    return udf.with_context(df, ["event_id", "user_id"], lambda d: d.select(F.round(F.col("value") / 2, 3).alias("half"), "_context"))
