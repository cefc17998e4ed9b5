"""Sharding along a Hilbert curve over quantised metadata, for pruning whole shards in several dimensions.

Defined results: nulls in a dimension share its cell 0; a null text counts one byte and has the checksum of the
empty text; rows that tie in cell, key and id are interchangeable; texts of any length are one row of their size;
columns named cell, shard or slot are replaced, all others pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, prefix_sums, table, unit_buckets

BITS = 5
SHARDS = 8


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a lattice point on the Hilbert curve: Skilling's transform to transposed axes, then bit interleaving."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | ((x[i] ^ t) >> b & 1)
    return out


@lru_cache(maxsize=8)
def curve(dims: int, bits: int) -> list[int]:
    """The curve index of every cell, by the cell's row-major number; its length depends on the parameters alone."""
    side = 1 << bits
    cells = [()]
    for _ in range(dims):
        cells = [(*c, v) for c in cells for v in range(side)]
    return [hilbert_index(c, bits) for c in cells]


def category(col: Column, bits: int = BITS) -> Column:
    """Cell of a categorical dimension: its checksum's low bits, null in cell 0."""
    return F.coalesce(F.crc32(col.cast("string")) % (1 << bits), F.lit(0)).cast("int")


def magnitude(col: Column, bits: int = BITS, steps: float = 1.5) -> Column:
    """Cell of a numeric dimension, ``steps`` cells to each doubling; null and nothing in cell 0."""
    return F.coalesce(F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.greatest(col, F.lit(1))) * steps)), F.lit(0)).cast("int")


def shard(rows: DataFrame, dims: list[Column], shards: int = SHARDS, bits: int = BITS, seed: int = 11) -> DataFrame:
    """Adds cell, shard and slot to rows with doc_id: rows sorted by (curve index, hash, doc_id), cut into ``shards`` runs whose counts differ by one at most.

    The rank of a row is the count of earlier cells, plus the earlier hash buckets of its cell, plus its place in
    its bucket. No task sorts more than a bucket, however hot a cell is.
    """
    own = [c for c in rows.columns if c not in ("cell", "shard", "slot")]
    at = F.lit(0)
    for d in dims:
        at = at * (1 << bits) + d
    # One string literal, folded to an array constant: a literal for each cell would be slow to plan.
    places = F.split(F.lit(",".join(map(str, curve(len(dims), bits)))), ",").cast("array<int>")
    index = F.element_at(places, at + 1)
    rows = rows.withColumn("cell", index).withColumn("__one", F.lit(1).cast("long")).withColumn("__hash", F.xxhash64(F.lit(seed), F.col("doc_id")))
    counts = materialise(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("__n")), "shard-cells")
    total = counts.agg(F.sum("__n")).first()[0] or 0
    # At most 2 ** (dims * bits) cells, whatever the input: one task sums them, and every task may hold them.
    earlier = Window.partitionBy().orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("cell").alias("__cell"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    buckets = unit_buckets(total)
    bucket = F.floor(F.shiftrightunsigned("__hash", 40) * buckets / F.lit(1 << 24)).cast("int")
    order = [F.shiftrightunsigned("__hash", 1), F.col("__hash"), F.col("doc_id")]
    ranked = prefix_sums(rows, ["cell"], order, bucket, "__one", "__place").join(F.broadcast(starts), F.col("cell") == F.col("__cell"))
    rank = F.col("__before") + F.col("__place")
    ranked = ranked.withColumn("shard", F.expr(f"cast((( __before + __place) * {shards}) div {max(total, 1)} as int)"))
    first = F.expr(f"(shard * cast({total} as bigint) + {shards - 1}) div {shards}")
    return ranked.withColumn("slot", (rank - first).cast("long")).select(*own, "cell", "shard", "slot")


def shard_statistics(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """One row a shard: its rows and each column's least and greatest value, for a reader that skips shards."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("min", F.min), ("max", F.max))])


def op4_hilbert_sharding(spark, sf_dir):
    """Every document with its place in eight shards along the curve of source, language and size."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), category(F.col("source")).alias("d_source"), category(F.col("lang")).alias("d_lang"))
    rows = materialise(rows.withColumn("d_size", magnitude(F.col("size"))), "shard-rows")
    out = shard(rows, [F.col("d_source"), F.col("d_lang"), F.col("d_size")])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
