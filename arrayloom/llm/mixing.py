"""Mixing sources to target weights: hash-random keys, a range sort in each source, prefix sums, exact cuts.

Defined results: a null text has size 0; a null source is a source of its own; documents of size 0 are kept in
the result with nothing taken; an empty table gives an empty result. Rows that agree in key, id and size are
interchangeable, so reruns give the same rows. Other columns pass through, but for those named as what is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, prefix_sums, table, unit_buckets, word_count

WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its words.
MOST_EPOCHS = 3


def targets(sources: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to rows (source, weight, source_size): shares of all words by weight, capped at ``most`` sizes.

    The excess of capped sources goes to the others by weight, until none is above its cap. Sources fill up in
    the order of cap / weight, so one sorted pass with running sums finds the level: a source is capped if and
    only if what is left for it and all later ones, shared by weight, is at least its cap. The number of rows
    is that of the sources, not of the documents.
    """
    everything = Window.partitionBy()
    cap = F.lit(most) * F.col("source_size")
    # Equal ratios of cap and weight are capped together or not at all: the frame ends before them.
    earlier = Window.partitionBy().orderBy("__place").rangeBetween(Window.unboundedPreceding, -1)
    df = sources.withColumn("__all", F.sum("source_size").over(everything)).withColumn("__cap", cap).withColumn("__place", F.dense_rank().over(Window.partitionBy().orderBy((F.col("__cap") / F.col("weight")).cast("double"))))
    df = df.withColumn("__left", F.col("__all") - F.coalesce(F.sum("__cap").over(earlier), F.lit(0))).withColumn("__weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    # Capped: left * weight >= cap * weights, in whole numbers.
    df = df.withColumn("__capped", F.col("__left") * F.col("weight") >= F.col("__cap") * F.col("__weights"))
    free = df.withColumn("__rest", F.col("__all") - F.sum(F.when(F.col("__capped"), F.col("__cap")).otherwise(0)).over(everything)).withColumn("__free", F.sum(F.when(F.col("__capped"), 0).otherwise(F.col("weight"))).over(everything))
    target = F.when(F.col("__capped"), F.col("__cap").cast("double")).otherwise(F.col("__rest").cast("double") * F.col("weight") / F.col("__free"))
    return free.withColumn("target", target).drop(*[c for c in free.columns if c.startswith("__")])


def weighted(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds ``weight``: the given weights in turn, sources by code point, null last."""
    # Strings compare by UTF-8 bytes, which is the order of code points.
    place = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("long"))


def random_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS, seed: int = 1) -> DataFrame:
    """Adds source_size, target and taken to rows that have doc_id, source and size.

    A source's words are laid end to end in the order of their random keys, again and again, and cut at
    floor(target): a document that starts at word p of the order is taken whole in each full epoch, and in the
    last one as far as the cut reaches.
    """
    own = [c for c in docs.columns if c not in ("source_size", "target", "taken")]
    docs = docs.select(*own).withColumn("__key", random_key(F.col("doc_id"), seed))
    sizes = materialise(docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("__rows")), "mix-sources")
    rows = sizes.agg(F.sum("__rows")).first()[0] or 0
    goal = targets(weighted(sizes.drop("__rows"), weights), most).select(F.col("source").alias("__source"), "source_size", "target")
    n = unit_buckets(rows)
    # The first 28 bits of the key, scaled to the buckets: grows with the key.
    bucket = F.floor(F.conv(F.substring("__key", 1, 7), 16, 10).cast("long") * n / F.lit(1 << 28)).cast("int")
    placed = prefix_sums(docs, ["source"], [F.col("__key"), F.col("doc_id"), F.col("size")], bucket, "size", "__p")
    placed = placed.join(goal, F.col("source").eqNullSafe(F.col("__source")))
    whole = F.floor(F.col("target")).cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    rest = whole - full * F.col("source_size")
    taken = full * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("__p")))
    return placed.withColumn("taken", taken.cast("long")).select(*own, "source_size", "target", "taken")


def op2_source_mixing(spark, sf_dir):
    """Every document with the words that the mix takes of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(materialise(docs, "mix-sizes")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight, sum(source_size) OVER () AS everything FROM s),
fill AS (
  SELECT 0 AS round, source, source_size, cap, weight, everything::DOUBLE AS rest, false AS capped FROM w
  UNION ALL
  SELECT round + 1, source, source_size, cap, weight,
    rest - coalesce(sum(CASE WHEN fresh THEN cap END) OVER (), 0), capped OR fresh
  FROM (SELECT *, NOT capped AND rest * weight >= cap * sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS fresh FROM fill WHERE round < 40)
),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE rest * weight / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS target FROM fill WHERE round = 40),
p AS (SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS whole,
  coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('1:' || coalesce(doc_id::VARCHAR, 'null')), doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN whole // source_size ELSE 0 END AS full_epochs FROM p)
SELECT doc_id, size, source_size, target, (full_epochs * size + greatest(0, least(size, whole - full_epochs * source_size - p)))::BIGINT AS taken FROM e
"""
