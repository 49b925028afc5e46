"""Connected components of a large undirected graph, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a``, ``b``); a component is named by one
    of its nodes.

    Each round, every node moves to the smallest node among itself and its neighbours, in the order of
    a hash, and edges follow their ends.  In a random order this takes away a constant share of the
    nodes, whatever the shape of the graph, so the rounds are few and shrink geometrically.  At the end
    the moves are composed from the last round back.  Nothing is gathered on the driver but one count
    per round."""
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = stored(edges.select(low, high).where("a <> b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        least = both.groupBy("a").agg(F.min(ranked("b")).alias("m")).select(
            F.col("a").alias("node"), F.least("m", ranked("a")).getField("id").alias("to"))
        move = stored(least, "moves")
        moves.append(move)
        ends = (edges.join(move.withColumnsRenamed({"node": "a", "to": "p"}), "a")
                .join(move.withColumnsRenamed({"node": "b", "to": "q"}), "b").where("p <> q"))
        edges = stored(ends.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "edges")
    if not moves:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = moves[-1].select("node", F.col("to").alias("component"))
    for i, move in enumerate(reversed(moves[:-1])):
        later = out.select(F.col("node").alias("to"), "component")
        out = move.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    return stored(out, "components")
