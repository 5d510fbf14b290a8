"""Connected components of a table of links, by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.tables import finished, stored


@finished
def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links (a, b)``: the smallest node it can be reached from.

    In each round every node follows the neighbour of least hash, and that one's choice in turn, unless
    it is itself the least; the links are then drawn between those that are left. In expectation at
    least half of the nodes go in a round, so the rounds grow with the logarithm of the nodes alone.
    Repeated links, loops and either order of a pair are allowed; nulls are not. No links: no rows."""
    links = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    found, turn = None, 0
    while not links.isEmpty():
        def order(node):
            return F.struct(F.xxhash64(F.col(node), F.lit(turn)).alias("h"), F.col(node).alias("n"))  # noqa: B023

        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min(order("b")).alias("least"))
        chosen = stored(least.select("a", F.least("least", order("a"))["n"].alias("b")), "chosen")
        onward = chosen.select(F.col("a").alias("b"), F.col("b").alias("c"))
        chosen = stored(chosen.join(onward, "b").select("a", F.col("c").alias("b")), "chosen")
        to = chosen.select(F.col("b").alias("root"), F.col("a").alias("end"))
        first = links.join(to.withColumnRenamed("root", "ra"), F.col("a") == F.col("end")).select("ra", "b")
        second = first.join(to.withColumnRenamed("root", "rb"), F.col("b") == F.col("end"))
        links = stored(second.select(F.col("ra").alias("a"), F.col("rb").alias("b")).where("a <> b").distinct(), "links")
        if found is None:
            found = chosen.select(F.col("a").alias("node"), F.col("b").alias("root"))
        else:
            moved = found.join(to.withColumnRenamed("root", "new"), F.col("root") == F.col("end"), "left")
            found = stored(moved.select("node", F.coalesce("new", "root").alias("root")), "roots")
        turn += 1
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(smallest, "root").select("node", "component")
