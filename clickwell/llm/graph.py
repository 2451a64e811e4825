"""Connected components of a link table, computed with joins and aggregations.

Alternates the two star operations of Kiveris et al., "Connected Components in
MapReduce and Beyond" (2014): the large star links every larger neighbour of a node to
the smallest node of its neighbourhood, the small star does so for the smaller ones.
Both keep the components and never add links beyond the number there are, so a hub
with millions of neighbours costs as many rows.  Every round is written to the shared
checkpoint folder; nothing but two counters per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import write_shared


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` has columns a, b with b < a (each undirected link once)."""
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = links
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    paired = around.join(least, around.a == least.u)
    if large:
        out = paired.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = paired.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node
    reachable.  Links may repeat, go in either direction, loop or hold nulls (ignored);
    no links give an empty table."""
    now = write_shared(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                       .filter("a is not null and b is not null and a > b").distinct())
    # a forest of stars: no parent has a parent, no node has two
    while True:
        tops = now.agg(F.count("*").alias("n"), F.countDistinct("a").alias("k")).first()
        if tops.n == 0:
            break
        deep = now.join(now.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        if tops.n == tops.k and not deep:
            break
        now = write_shared(_star(_star(now, large=True), large=False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
