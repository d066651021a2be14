"""Labelled directed graphs as two tables: ``vertices(id, label)``, ``edges(src, dst, label)``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import spread, store

# Steps outwards before shortcuts are made, and how many times the edges of the graph these may have.
PLAIN_HOPS = 8
GROWTH = 4


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame
    # About how many edges at most, if that is known: shuffles then have parts in proportion.
    most: int | None = None

    @classmethod
    def build(cls, vertices: DataFrame, edges: DataFrame, most: int | None = None) -> Graph:
        """Edges with an unknown end are dropped."""
        ids = vertices.select("id")
        known = spread(edges, most, "src").join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
        known = spread(known, most, "dst").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        return cls(vertices, known.select(*edges.columns), most)

    def stored(self) -> Graph:
        """The graph written to the shared folder: worth it before several queries, or one
        that uses its edges more than once, over a graph derived from other tables."""
        return Graph(store(self.vertices, "vertices"), store(self.edges, "edges"), self.most)

    def select(self, predicate: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Vertices by predicate with their (incoming, outgoing) edges."""
        found = self.vertices.where(predicate)
        ids = found.select("id")
        incoming = self.edges.join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        outgoing = self.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi")
        return found, incoming.select(*self.edges.columns), outgoing.select(*self.edges.columns)

    def without(self, node: int | str) -> Graph:
        """The graph without one node and its edges."""
        return Graph(
            self.vertices.where(F.col("id") != node),
            self.edges.where((F.col("src") != node) & (F.col("dst") != node)),
            self.most,
        )

    def degrees(self) -> DataFrame:
        """Number of edge ends at each vertex; a loop counts twice."""
        ends = self.edges.select(F.explode(F.array("src", "dst")).alias("id"))
        counted = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
        return (
            self.vertices.select("id")
            .join(counted, "id", "left")
            .select("id", F.coalesce("degree", F.lit(0)).alias("degree"))
        )

    def neighbours(self) -> DataFrame:
        """``(id, neighbour)`` pairs over edges of either direction."""
        both = F.array(
            F.struct(F.col("src").alias("id"), F.col("dst").alias("neighbour")),
            F.struct(F.col("dst").alias("id"), F.col("src").alias("neighbour")),
        )
        pairs = self.edges.select(F.explode(both).alias("_p")).select("_p.*")
        return spread(pairs, self.most and 2 * self.most, "id", "neighbour").distinct()

    def neighbours_of(self, node: int | str) -> DataFrame:
        return self.neighbours().where(F.col("id") == node).select("neighbour")

    def totals(self) -> DataFrame:
        """Sum of ids, number of vertices, number of edges."""
        v = self.vertices.agg(F.sum("id").alias("id_sum"), F.count(F.lit(1)).alias("n_vertices"), F.lit(0).alias("n_edges"))
        e = self.edges.agg(F.lit(None).cast("long").alias("id_sum"), F.lit(0).alias("n_vertices"), F.count(F.lit(1)).alias("n_edges"))
        sums = [F.sum(c).alias(c) for c in ("id_sum", "n_vertices", "n_edges")]
        return v.unionByName(e).agg(*sums)

    def reverse(self) -> Graph:
        swapped = self.edges.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), *[c for c in self.edges.columns if c not in ("src", "dst")]
        )
        return Graph(self.vertices, swapped, self.most)

    def adjacent(self, label: str, direction: str = "both") -> DataFrame:
        """``(id, adjacent)`` over edges with the label: ``out``, ``in`` or ``both``."""
        chosen = self.edges.where(F.col("label") == label)
        out = F.struct(F.col("src").alias("id"), F.col("dst").alias("adjacent"))
        into = F.struct(F.col("dst").alias("id"), F.col("src").alias("adjacent"))
        pairs = {"out": [out], "in": [into], "both": [into, out]}[direction]
        return chosen.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*").distinct()

    def reachable(self, start: int | str, out: str = "id", plain_hops: int = PLAIN_HOPS, growth: int = GROWTH) -> DataFrame:
        """All vertices on paths from ``start``, itself included.

        The first steps outwards are one join each. Where they don't come to an end the graph is
        deep, and shortcuts take over: edges of 2, 4, 8, ... hops, each the square of the last.
        A sweep goes from the longest to the shortest once; since any distance is a sum of powers
        of two it reaches everything up to twice the longest, and sweeps repeat until one finds
        nothing. Squaring ends before a square would have more than ``growth`` times the edges of
        the graph, so shortcuts stay in proportion to it whatever its shape.

        All sets are stored in the shared folder: plans stay small, a lost executor costs a step.
        """
        spark = self.edges.sparkSession
        links = store(spread(self.edges.select("src", "dst"), self.most, "src", "dst").distinct(), "links")
        counted = None if self.most is None else links.count()
        frontier = self.vertices.where(F.col("id") == start).select("id")
        visited = frontier = store(frontier, "visited")
        for _ in range(plain_hops):
            if frontier.isEmpty():
                return visited.withColumnRenamed("id", out)
            frontier = _step(links, frontier, visited, counted)
            visited = visited.unionByName(frontier)
        visited = store(visited, "visited")
        levels = None
        while not frontier.isEmpty():
            levels = levels or self._shortcuts(links, growth)
            found = None
            for hops in reversed(levels):
                sources = frontier if found is None else frontier.unionByName(found)
                new = _step(hops, sources, visited if found is None else visited.unionByName(found))
                found = new if found is None else found.unionByName(new)
            frontier = store(found, "frontier")
            visited = store(visited.unionByName(frontier), "visited")
        return visited.withColumnRenamed("id", out)

    def _shortcuts(self, links: DataFrame, growth: int) -> list[DataFrame]:
        """Edges of 1, 2, 4, ... hops, as far as the growth and the number of vertices allow."""
        levels, most = [links], growth * links.count()
        longest = max(1, self.vertices.count()).bit_length()
        while len(levels) <= longest:
            last = levels[-1]
            ends = last.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("into"))
            starts = last.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out"))
            pairs = ends.join(starts, "id").agg(F.sum(F.col("into") * F.col("out"))).first()[0] or 0
            if not pairs or pairs > most:
                break
            onward = last.select(F.col("src").alias("dst"), F.col("dst").alias("_to"))
            levels.append(store(last.join(onward, "dst").select("src", F.col("_to").alias("dst")).distinct(), "shortcuts"))
        return levels


def _step(links: DataFrame, sources: DataFrame, visited: DataFrame, most: int | None = None) -> DataFrame:
    """What ``links`` lead to from ``sources`` that was not visited yet, stored."""
    nearby = spread(links, most, "src").join(sources.withColumnRenamed("id", "src"), "src", "left_semi")
    return store(nearby.select(F.col("dst").alias("id")).distinct().join(visited, "id", "left_anti"), "frontier")
