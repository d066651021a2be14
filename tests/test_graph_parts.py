"""Shuffles of a graph of known size have parts in proportion to it."""

from millrace import session
from millrace.operators.graph import Graph


def _graph(spark, most):
    vertices = spark.createDataFrame([(i, "v") for i in range(60)], "id long, label string")
    pairs = [(i, i + 1) for i in range(0, 58)] * 2 + [(None, 3), (4, None), (5, 999), (59, 59)]
    return Graph.build(vertices, spark.createDataFrame([(a, b, "e") for a, b in pairs], "src long, dst long, label string"), most)


def test_parts_grow_with_the_edges_and_rows_stay(spark, monkeypatch):
    plain = _graph(spark, None)
    edges, near, reached = (sorted(map(tuple, df.collect())) for df in (plain.edges, plain.neighbours(), plain.reachable(50)))
    monkeypatch.setattr(session, "ROWS_PER_PART", 10)
    known = _graph(spark, 120)
    pairs = known.neighbours()
    # Twice the edges, ten in a part.
    assert "hashpartitioning(id" in pairs._jdf.queryExecution().toString() and ", 24)" in pairs._jdf.queryExecution().toString()
    assert sorted(map(tuple, known.edges.collect())) == edges
    assert sorted(map(tuple, pairs.collect())) == near
    assert sorted(map(tuple, known.reachable(50).collect())) == reached == [(i,) for i in range(50, 59)]
