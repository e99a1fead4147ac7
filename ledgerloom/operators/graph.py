"""Co-occurrence graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cooccurrence(df: DataFrame, vertex: str, event: str, year: str) -> tuple[DataFrame, DataFrame]:
    """Vertices (vertex, n events) and undirected edges (v1 < v2, weight, first_year) between vertices of one event.

    Repeated rows count once. An event's members are paired, so events should be small, as those with few people are;
    null vertices and events take no part in edges.
    """
    members = df.where(F.col(vertex).isNotNull()).select(F.col(vertex).alias("vx"), F.col(event).alias("ed"), F.col(year).alias("y")).distinct()
    vertices = members.groupBy(F.col("vx").alias("vertex")).agg(F.count_distinct("ed").alias("n"))
    a, b = members.alias("a"), members.alias("b")
    pairs = a.join(b, (F.col("a.ed") == F.col("b.ed")) & (F.col("a.vx") < F.col("b.vx")))
    edges = pairs.groupBy(F.col("a.vx").alias("v1"), F.col("b.vx").alias("v2")).agg(F.count(F.lit(1)).alias("weight"), F.min("a.y").alias("first_year"))
    return vertices, edges


def min_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, label) of the ends of edges (a, b): label is the smallest id linked directly or through others.

    Each round every vertex moves to the smallest vertex next to it, or to where that one moves; edges move with their
    ends, and loops and repeats go, so that the graph shrinks until no edge is left. The smallest id of a group never
    moves. A hub's edges meet in a minimum with partial aggregation; where it is looked up, it is one of few heavy keys.
    Edges with a null end are no links.
    """
    from ledgerloom.operators.skew import lookup_join
    from ledgerloom.session import cut, release

    known = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    labels = cut(known.select(F.col("a").alias("id")).unionByName(known.select(F.col("b").alias("id"))).distinct().withColumn("label", F.col("id")))
    links = cut(known.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        if links.isEmpty():
            release(links)
            return labels
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut(ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("to")))
        moves = cut(lookup_join(near, near.select(F.col("id").alias("to"), F.col("to").alias("far")), "to").select("id", F.coalesce("far", "to").alias("to")))
        old = labels, links, near, moves
        labels = cut(lookup_join(labels, moves.withColumnsRenamed({"id": "label"}), "label").select("id", F.coalesce("to", "label").alias("label")))
        half = lookup_join(links, moves.withColumnsRenamed({"id": "a", "to": "to_a"}), "a")
        both = half.join(moves.withColumnsRenamed({"id": "b", "to": "to_b"}), "b").where("to_a <> to_b")
        links = cut(both.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
        release(*old)
    raise RuntimeError(f"labels still change after {max_rounds} rounds")
