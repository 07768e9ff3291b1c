"""Connected components of a table of links, by alternating large and small stars.

Every step is a combined aggregation and a join on node ids, so no group of nodes ever
meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise

#: Parts that the links of a node are dealt to.
PARTS = 16


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v, m: beside each edge the smallest v of its u.

    The edges of a node are dealt to PARTS by their other end, so one with very many is
    summed and joined in as many tasks.
    """
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    some = dealt.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = some.groupBy("u").agg(F.min("m").alias("m"))
    return dealt.join(some.select("u", "part").join(least, "u"), ["u", "part"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node gives its larger neighbours the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    known = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return known.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    known = _with_least(edges)
    moved = known.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(known.filter("v = m").select("u", "v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for each node of ``links`` (a, b).

    Null ends and loops are ignored; repeated links count once; roots aren't listed.
    No links give no rows. The number of rounds grows with the logarithm of the
    largest component; each is written to the shared folder.
    """
    ends = links.filter("a is not null and b is not null and a <> b")
    edges = materialise(ends.select(F.greatest("a", "b").cast("bigint").alias("u"), F.least("a", "b").cast("bigint").alias("v")).distinct(), "edges")
    before, now = None, _state(edges)
    while now != before and now[0]:
        old, edges = edges, materialise(_small_star(_large_star(edges)), "edges")
        discard(old)
        before, now = now, _state(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
