"""Groups from pairwise links: minimum labels, pointer jumping, a checkpoint each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup_join
from ledgerloom.session import cut, release


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """One row (id, label) for each id in a or b of edges; label is the smallest id linked with it, directly or not.

    Each round, every vertex points at the smallest vertex among itself and its neighbours (a minimum with partial
    aggregation, so a vertex with a third of all edges is no burden), pointers jump on to where the next two
    pointers lead, and labels and the ends of edges follow them; loops and repeated edges go. A group's smallest id never moves,
    and what follows one pointer each stays linked, so rounds end with that id alone, when no edge is left and no label
    changes any more. Pointers, labels and edges are checkpointed in each round; the driver sees only counts.

    Null ends are no links, but their other end is an id. Loops and repeated edges are fine; empty input gives no rows.
    Ids need an order (strings by code point).
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    ids = both.select(F.col("u").alias("id")).unionByName(both.select(F.col("v").alias("id"))).where("id IS NOT NULL").distinct()
    links = cut(both.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    labels = cut(ids.withColumn("label", F.col("id")))
    for _ in range(max_rounds):
        if links.isEmpty():
            return labels
        ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        old = labels, links
        roots = jump(cut(ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("id"), F.least("u", "m").alias("root"))))
        labels = cut(lookup_join(labels, roots.select(F.col("id").alias("label"), "root"), "label").select("id", F.coalesce("root", "label").alias("label")))
        half = lookup_join(links, roots.select(F.col("id").alias("u"), F.col("root").alias("ru")), "u").select(F.col("ru").alias("u"), "v")
        # larger ends seldom are hubs, as hubs become small after the first rounds; where one is, AQE splits it
        whole = half.join(roots.select(F.col("id").alias("v"), F.col("root").alias("rv")), "v")
        links = cut(whole.where("u <> rv").select(F.least("u", "rv").alias("u"), F.greatest("u", "rv").alias("v")).distinct())
        release(roots, *old)
    raise RuntimeError(f"labels still change after {max_rounds} rounds")


def jump(pointers: DataFrame) -> DataFrame:
    """Pointers (id, root) with root <= id, each made to point two pointers further. Many ids may share one root; such
    roots are looked up by broadcast.
    """
    step = pointers.select(F.col("id").alias("root"), F.col("root").alias("next"))
    twice = lookup_join(pointers, step, "root").select("id", F.coalesce("next", "root").alias("root"))
    out = cut(lookup_join(pointers.select("id", F.col("root").alias("first")), twice.select(F.col("id").alias("first"), F.col("root").alias("next")), "first").select("id", F.coalesce("next", "first").alias("root")))
    release(pointers)
    return out


def groups(labels: DataFrame) -> DataFrame:
    """(leader, member) rows of the groups with two or more ids: the smallest id with each other id."""
    return labels.where("id <> label").select(F.col("label").alias("leader"), F.col("id").alias("member"))
