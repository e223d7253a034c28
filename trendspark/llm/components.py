"""Connected components of an edge table, as alternating star contractions.

Each round hangs every neighbour of a node on the smallest node it sees (larger
neighbours first, then smaller ones), which ends in one star per component after a
number of rounds logarithmic in the longest path. A round is a partial aggregate and a
join, so a node with very many edges is combined before the shuffle and its join
partition can be split. Edges are written to the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge has a > b here: b is a smaller neighbour of a
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.union(low.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.max(F.xxhash64("b", "a"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node reachable.

    Null ends, self loops and repeated edges are allowed and change nothing; an empty
    edge table gives an empty result.
    """
    scratch = Scratch(edges.sparkSession, "components")
    now = scratch.keep(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                       .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        new = scratch.keep(_small_star(_large_star(now)), "edges")
        after = _state(new)
        scratch.drop(now)
        now = new
        if after == state:
            break
        state = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
