"""Connected components of a sparse graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import checkpointed


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can reach.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its
    smallest one, then its smaller neighbours likewise. Both keep the number of edges, and the
    number of rounds grows with the logarithm of the longest path. Minima are partial
    aggregates, and a hub's edges meet in an equi-join whose large partitions Spark can split. Each
    round is checkpointed. Null and self edges are ignored; no edges give an empty table.
    """
    current = checkpointed(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .filter("a is not null and b is not null and a < b")
        .distinct()
    )
    before = None
    while True:
        # Larger neighbours go to the smallest of all neighbours and the node itself.
        both = _both_ways(current)
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a")
            .join(low, "a")
            .select(F.col("m").alias("a"), "b")
            .distinct()
        )
        # Smaller neighbours of a node go to the smallest of them: (a, b) has a < b.
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")),
                                      F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .filter("a < b")
            .distinct()
        )
        current = checkpointed(small)
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return current.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
