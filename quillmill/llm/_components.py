"""Connected components by alternating large-star and small-star steps; nothing but counters reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm._store import dropped, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m")).select("k", F.least("k", "m").alias("m"))
    return both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung on the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
    moved = down.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that an edge (a, b) touches; the root is the smallest node reachable.

    Self-loops are left out, repeated edges count once. Rounds grow with the logarithm of the nodes; each is
    written to the shared folder, so a lost executor costs one round at most.
    """
    now = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        then = written(_small(_large(now)), "edges")
        new = _state(then)
        dropped(now)
        now = then
        if new == state:
            break
        state = new
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
