"""Connected components of a link table by alternating star contraction.

Large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", 2014). Every round is two aggregates and joins; the
edges are written to the shared folder after each round, nothing but a
(count, checksum) pair comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node.

    Self-links and null ends are ignored. Nodes are compared as values of
    their own type. Repeated links count once.
    """
    x, y = F.col(a), F.col(b)
    cur = saved(
        edges.where(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(),
        "edges",
    )
    before = None
    while True:
        mark = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        # large star: each node's larger neighbours move to its smallest one
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: each node's smaller neighbours and itself move to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        cur = saved(small.where("u <> v").distinct(), "edges")
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
