"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.runtime import discard, settle


def components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """node, component: every node of ``edges`` with the least node of its component.

    Edges have no direction; null ends and loops are ignored (a node with only
    loops gives no row), repeated edges count once. Each round joins every
    node's neighbours to the least of them, so the number of rounds grows with
    the logarithm of the size. A node's neighbours are reduced to their minimum
    before any shuffle, so a node of very many edges is no hot group.
    """
    e = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null and u <> v")
    cur = settle(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    print_sum = None
    while True:
        # large star: larger neighbours go to the least neighbour (or the node itself)
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: smaller neighbours, and the node, go to the least of them
        low = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = low.groupBy("u").agg(F.min("v").alias("m"))
        small = low.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        nxt = settle(small, "cc")
        s = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(cur)
        cur = nxt
        if (s["n"], s["h"]) == print_sum:
            break
        print_sum = (s["n"], s["h"])
    comp = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return comp.unionByName(roots)
