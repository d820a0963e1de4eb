"""Connected components of a graph too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node in ``edges`` (``a``, ``b`` long, not null).

    ``label`` is the smallest node of the component.  Alternates the large-star
    and small-star steps, which hang every node on smaller and smaller nodes
    until each component is one star.  Every step is an aggregate and a join,
    written to the shared folder; the minima are read back from files, so that
    the join of a node with very many edges can be split.
    """
    now = stage(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                      F.least("a", "b").alias("b")).distinct(),
        "cc_edges",
    )
    seen = None
    for _ in range(MOST_ROUNDS):
        mark = now.agg(F.count("a"), F.sum(F.hash("a", "b").cast("long"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = _small_star(_large_star(now))
    else:
        raise RuntimeError("components did not settle")
    # a star: (member, centre)
    centres = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        centres.select("node", F.col("node").alias("label"))
    )


def _minima(pairs: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, itself included."""
    return stage(
        pairs.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("of"), F.least("u", "m").alias("m")),
        "cc_minima",
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = _minima(both)
    return (
        both.filter("v > u").join(low, F.col("u") == F.col("of"))
        .select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = stage(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "cc_large")
    low = _minima(down)
    linked = down.join(low, F.col("u") == F.col("of")).select(F.col("v").alias("a"),
                                                            F.col("m").alias("b"))
    own = low.select(F.col("of").alias("a"), F.col("m").alias("b"))
    return stage(linked.unionByName(own).filter("a <> b").distinct(), "cc_edges")
