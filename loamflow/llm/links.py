"""Links between nodes settled into components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamflow.llm.base import settle
from loamflow.operators.joins import lookup_join


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) for every node of ``edges`` (u, v) that isn't its own root.

    By alternating star contractions. The centre of a large star holds most edges: the joins on it can be split.
    """
    edges, seen = settle(edges, "edges"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = lookup_join(both.filter(F.col("v") > F.col("u")), least, ["u"], "inner")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = lookup_join(large, least, ["u"], "inner").filter(F.col("v") > F.col("m"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
