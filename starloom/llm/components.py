"""Connected components by alternating large-star and small-star rounds, as DataFrame joins.

Each round hangs every node on the least node it sees; a graph of n nodes settles in
about log n rounds.  Least neighbours come from a map-side combined aggregate, so a
node with many neighbours is not gathered; edges and labels stay distributed and each round is
checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.materialize import materialize

MAX_ROUNDS = 100


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; ``component`` is its least reachable node.

    Links are undirected; repeated links and links of a node to itself do no harm, links
    with a null end are ignored.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    # edges run from the greater node a to the lesser b
    edges = materialize(links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(high.alias("a"), low.alias("b")).distinct())
    loops = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    edges = edges.filter("a <> b")
    before = _digest(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        lesser = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(lesser, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(lesser.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = materialize(small)
        after = _digest(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    hung = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = hung.select(F.col("component").alias("node"), "component").distinct()
    lone = loops.join(hung.unionByName(roots).select("node").distinct(), "node", "left_anti")
    return hung.unionByName(roots).unionByName(lone)
