"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplometh.storage import materialize


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of every node in ``links`` (``a``, ``b``).

    Each round hangs every node's larger neighbours, then its smaller ones,
    under its smallest neighbour (the published large-star and small-star
    steps) until nothing changes: a number of rounds that grows with the
    logarithm of the links. Minima are aggregates and meet the links in joins,
    so a node with very many links is no task of its own.
    """
    edges = materialize(links.filter(F.col("a") != F.col("b")).select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links")
    before = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).collect()[0])
        if now == before:
            break
        before = now
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo != hi").distinct()
        large = materialize(large, "links")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        hung = large.join(least, "hi").select("m", "lo", "hi")
        small = hung.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).unionByName(hung.select(F.col("m").alias("lo"), "hi"))
        edges = materialize(small.filter("lo != hi").distinct(), "links")
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
    return roots.unionByName(edges.select(F.col("hi").alias("node"), F.col("lo").alias("label")))
