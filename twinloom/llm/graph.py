"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinloom.llm.rows import written


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame) -> DataFrame:
    """Rows (id, component): the smallest id reachable, for every id that has a link.

    Alternates large-star and small-star steps on (u, v) with u > v: each step links the
    neighbours of a node to the smallest of them, until all edges point at their component.
    Smallest neighbours are combined before the shuffle. In large-star steps, where a node may
    have very many neighbours, they are written, so that the join can be split there.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = written(edges, "edges"), None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = written(small.where("u <> v").distinct(), "edges")
    own = edges.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(own).groupBy("id").agg(F.min("component").alias("component"))
