"""Connected components of a graph given as an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialize


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of edges (a, b), root the smallest node of its component.

    Alternating stars: each round first links every node's larger neighbours to
    its smallest neighbour, then every node and its smaller neighbours to the
    smallest of these; components become stars in a logarithmic number of
    rounds. Each step is written to the shared folder, so a lost executor costs
    one step, and what the next one has read is deleted. Edges of a node with
    itself, null ends and repeated edges are ignored; an empty table gives an
    empty one.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    e, state = materialize(e, name), None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the smallest neighbours are tables of their own, so that a join with them can split a hub's many edges
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), name)
        large = materialize(both.join(least, "a").where("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), name)
        smallest = materialize(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, e = e, materialize(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), name)
        discard(before, least, large, smallest)  # round by round, not all at the end
        now = e.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == now:
            break
        state = now
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    out = materialize(e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), name)
    discard(e)
    return out
