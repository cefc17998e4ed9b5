"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the component is its least id.

    Each round hangs every node's neighbours on the least of them; the rounds needed grow with the logarithm of
    the longest path. Only links move, never a whole component; least neighbours are aggregated before the shuffle.
    """
    links = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every a hangs its smaller neighbours, and itself, on the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        links = materialise(small.filter("a <> b").distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        seen = now
