import math
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import geo, graph
from millrace.operators.graph import Graph
from millrace.plans.networks import BOROUGHS
from millrace.sources import readers


def ids(df, column):
    return sorted(r[column] for r in df.collect())


@pytest.fixture(scope="module")
def letters(spark):
    v = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "e")], "id long, label string")
    e = spark.createDataFrame([(1, 2, ""), (1, 3, ""), (3, 4, ""), (3, 99, "")], "src long, dst long, label string")
    return Graph.build(v, e)


@pytest.fixture(scope="module")
def airports(spark):
    names = ["SEA", "SFO", "LAX", "DFW", "IAD", "JFK"]
    v = spark.createDataFrame(list(enumerate(names, 1)), "id long, label string")
    e = [(1, 2, "45"), (2, 3, "28"), (5, 4, "31"), (6, 5, "12"), (6, 1, "22"), (3, 6, "61"), (4, 2, "25")]
    return Graph.build(v, spark.createDataFrame(e, "src long, dst long, label string"))


@pytest.fixture(scope="module")
def people(spark):
    v = spark.createDataFrame([("Alice", 34), ("Bob", 28), ("Charlie", 32), ("Sam", 31)], "id string, label int")
    e = [("Alice", "Bob", "friend"), ("Sam", "Bob", "follow"), ("Alice", "Charlie", "follow"), ("Bob", "Charlie", "follow"), ("Alice", "Sam", "follow")]
    return Graph.build(v, spark.createDataFrame(e, "src string, dst string, label string"))


def test_letters(letters):
    assert ids(letters.neighbours_of(1), "neighbour") == [2, 3]
    assert ids(letters.reachable(1), "id") == [1, 2, 3, 4]
    assert ids(letters.reachable(3), "id") == [3, 4]
    assert ids(letters.reachable(98), "id") == []
    assert letters.totals().first().asDict() == {"id_sum": 10, "n_vertices": 4, "n_edges": 3}
    assert ids(letters.reverse().reachable(4), "id") == [1, 3, 4]
    assert letters.without(3).totals().first()["n_edges"] == 1


def test_airports(airports):
    assert {r["id"]: r["degree"] for r in airports.degrees().collect()}[2] == 3
    assert ids(airports.reachable(2), "id") == [1, 2, 3, 4, 5, 6]
    found, incoming, outgoing = airports.select(F.col("label") == "SFO")
    assert ids(found, "id") == [2]
    assert [(r["label"], r["dst"]) for r in outgoing.collect()] == [("28", 3)]
    assert sorted((r["label"], r["src"]) for r in incoming.collect()) == [("25", 4), ("45", 1)]


def test_long_path(spark):
    v = spark.range(12).select("id", F.lit("").alias("label"))
    e = spark.range(11).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit("").alias("label"))
    assert ids(Graph(v, e).reachable(0), "id") == list(range(12))


def test_people(people):
    adjacent = lambda who, label, way: ids(people.adjacent(label, way).where(F.col("id") == who), "adjacent")
    assert adjacent("Alice", "follow", "both") == ["Charlie", "Sam"]
    assert adjacent("Bob", "follow", "in") == ["Sam"]
    assert adjacent("Alice", "friend", "both") == ["Bob"]


@pytest.fixture(scope="module")
def boroughs(spark):
    text = spark.createDataFrame([(BOROUGHS,)], "value string")
    return readers.features_of(text, "value").select(
        F.col("properties")["borough"].alias("name"), F.col("properties")["boroughCode"].cast("int").alias("code"), "rings"
    )


def test_areas_and_order(boroughs):
    rows = geo.sorted_features(boroughs, "code").collect()
    assert [(r["name"], r["area"]) for r in rows] == [("Island", 1500.0), ("Core", 100.0), ("East", 1550.0), ("North", 1875.0)]


def test_locate(spark, boroughs):
    points = [(1, 5.0, 5.0), (2, 15.0, 15.0), (3, 30.0, 30.0), (4, 70.0, 30.0), (5, 200.0, 5.0), (6, 5.0, 60.0), (7, 20.0, 80.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = {r["id"]: r["name"] for r in geo.locate(df, boroughs, "id", "x", "y", "name", ["code"]).collect()}
    # in the outer ring; in its hole; in both nested ones; elsewhere; outside; ...
    assert got == {1: "Island", 3: "Island", 4: "East", 6: "North"}


def test_distance(spark, boroughs):
    island = boroughs.where("name = 'Island'").select(geo.edges(F.col("rings")).alias("e"))
    d = lambda x, y: island.select(geo.distance(F.col("e"), F.lit(x), F.lit(y))).first()[0]
    assert d(5.0, 5.0) == 0
    assert d(43.0, 44.0) == pytest.approx(5.0)
    assert d(15.0, 14.0) == pytest.approx(4.0)  # in the hole
    assert d(-3.0, 20.0) == pytest.approx(3.0)
    assert math.isclose(d(20.0, 50.0), 10.0)


def reached(edges, start):
    ahead, seen, open_ = {}, {start}, [start]
    for a, b in edges:
        ahead.setdefault(a, []).append(b)
    while open_:
        for b in ahead.get(open_.pop(), []):
            if b not in seen:
                seen.add(b)
                open_.append(b)
    return seen


def graph_of(spark, edges, n):
    vertices = spark.range(n).select("id", F.lit("v").alias("label"))
    return Graph(vertices, spark.createDataFrame(edges, "src long, dst long").withColumn("label", F.lit("e")))


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    n, stored = 10_001, []
    keep = graph.store
    monkeypatch.setattr(graph, "store", lambda df, label: stored.append(label) or keep(df, label))
    got = graph_of(spark, [(i, i + 1) for i in range(n - 1)], n).reachable(0)
    assert got.count() == n
    assert len(stored) < 90


def test_reachable_on_graphs_of_many_shapes(spark):
    rng = random.Random(4)
    shapes = {
        "ring": [(i, (i + 1) % 100) for i in range(100)],
        "tail into a ring": [(i, i + 1) for i in range(60)] + [(60, 30)],
        "ladder": [(2 * i + a, 2 * i + 2 + b) for i in range(30) for a in (0, 1) for b in (0, 1)],
        "sparse": [(rng.randrange(120), rng.randrange(120)) for _ in range(150)],
        "trees": [(i, 3 * i + k) for i in range(1, 40) for k in (0, 1, 2)],
        "hub": [(i, 0) for i in range(1, 50)] + [(0, i) for i in range(1, 50)],
        "own loops": [(0, 0), (0, 1), (1, 1)],
    }
    for name, edges in shapes.items():
        for start in (0, 7):
            got = graph_of(spark, edges, 125).reachable(start, plain_hops=1)
            assert sorted(r["id"] for r in got.collect()) == sorted(reached(edges, start)), name
