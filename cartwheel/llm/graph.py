"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import discard, shared_table


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (columns a, b): label is the smallest node
    of its component.

    A large-star step ties every node's larger neighbours to its smallest neighbour, a
    small-star step its smaller ones; the number of rounds grows with the logarithm of the
    component size, and no step makes more edges than there were. Each round is written
    to the shared folder.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = shared_table(edges, "links")
    mark = fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, edges = edges, shared_table(small.unionByName(least.withColumnRenamed("m", "v")).distinct(), "links")
        discard(before)
        new = fingerprint(edges)
        if new == mark:
            break
        mark = new
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.withColumn("label", F.col("node")))


def fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
