"""Connected components of an edge table by alternating large-star and small-star joins.

Nothing is gathered per node: a hub's neighbours stay rows, and each round is
a minimum per node (combined before the shuffle) joined back to the edges. The
minima are written first, so the join meets two plain tables and a hub's edges
can be split over tasks. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialize

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return int(r["n"]), int(r["x"] or 0)


def _star(pairs: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """For each node u with neighbours v: links of v (where ``keep``) to the least of them all, and that least."""
    least = materialize(pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
    linked = pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked, least


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v; longs); root is the component's least node.

    Self-loops and nulls are ignored, repeated edges count once, no edges give no rows.
    """
    edges = materialize(edges.where(F.col("u") != F.col("v"))
                        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large, _ = _star(both, F.col("v") > F.col("u"))
        large = materialize(large.where(F.col("u") != F.col("v")).distinct())
        small, least = _star(large, F.col("v") != F.col("m"))
        small = small.unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.where(F.col("u") != F.col("v")).distinct())
        now = _state(edges)
        if now == state:
            break
        state = now
    else:  # pragma: no cover - the number of rounds is logarithmic
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
