"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import written

MOST_ROUNDS = 50


def components(edges: DataFrame) -> DataFrame:
    """(node, component): of every node in edges (a, b) the least node it is connected with.

    Alternating large-star and small-star steps: every node's larger (then smaller) neighbours are tied to the least
    neighbour, which keeps components and ends in stars after few rounds. Each round is written, nothing is collected.
    Null ends are left out; self loops and repeated edges don't matter.
    """
    now = written(edges.select("a", "b").where("a is not null and b is not null and a <> b").distinct(), "edges")
    before = None
    for _ in range(MOST_ROUNDS):
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above the node are tied to the least of the node and its neighbours
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: the node and its neighbours below it are tied to the least of these
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components didn't settle in {MOST_ROUNDS} rounds")
    return now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
