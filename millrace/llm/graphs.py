"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.staging import Staging


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for every node of the ``a``, ``b`` edges; the component is its least node.

    Alternates two steps until the edges are stars around the least nodes: every node hands its
    larger neighbours to its least one, then its smaller neighbours and itself. Both fold to a
    minimum before they are joined back, each round is written to the shared folder, and only a
    count and a checksum of the edges reach the driver. Nodes must not be null.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    edges = staging.write(edges.distinct(), "edges")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staging.write(large, "edges")
        staging.remove(edges)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = staging.write(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "edges")
        staging.remove(large)
        after = _state(edges)
        if after == before:
            break
        before = after
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)


def _state(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    row = edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.pmod(hashed, F.lit(1 << 30)))).first()
    return tuple(row)
