"""Exact top-k search by inner product over a vector-approximation file.

The file has a row for each block of vectors: a grid, and one byte a component that tells its cell. A query scans
all the file's cells, which give an upper and a lower bound of each score; every candidate whose upper bound lies
below the k-th best lower bound is out. The exact vectors of those that are left are then read in the order of
their upper bounds: first the k of the highest, and of the others only those whose bound still reaches the k-th
exact score found. No other exact vector is read or moved.

Defined results: vectors that are null or hold null or non-finite components take no part, as query or
candidate; vectors are compared with those of their own length only; rows that repeat an id are all candidates;
an empty table gives no rows; other columns take no part. Scores are whole numbers of 64 bits; components or scores beyond are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, table

#: Vectors of a block of the file, and queries that meet it together.
BLOCK = 16_384
QUERY_BLOCK = 8_192
CELLS = 256
#: Vectors whose bounds a task holds at once for one query, times queries.
AT_ONCE = 4_000_000


def approximation(ids: np.ndarray, x: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """(ids, low, width, cells) of a block as bytes: component i of a vector in cell c is in low[i] + [c, c + 1] width[i]."""
    x = x.astype(np.float64)
    low, high = (x.min(axis=0), x.max(axis=0)) if x.shape[1] else (np.zeros(0), np.zeros(0))
    # A little wider than need be, so that rounding can't put a component outside its cell.
    width = np.maximum((high - low) * (1 + 1e-9) / CELLS, np.maximum(np.abs(low), np.abs(high)) * 1e-12 + 1e-9)
    cells = np.clip(np.floor((x - low) / width), 0, CELLS - 1).astype(np.uint8)
    return ids.astype(np.int64).tobytes(), low.tobytes(), width.tobytes(), cells.tobytes()


def places(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Each vector's place, by id, among its equals in the block."""
    if not x.shape[1]:
        group = np.zeros(len(ids), np.int64)
    else:
        _, group = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    new = np.r_[True, group[order[1:]] != group[order[:-1]]]
    out = np.empty(len(ids), np.int32)
    out[order] = np.arange(len(ids)) - np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    return out


def block_bounds(q: np.ndarray, low: np.ndarray, width: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score of each query with each vector of a block, by the cells."""
    centre = low + (cells.astype(np.float64) + 0.5) * width
    middle = q @ centre.T
    # Half a cell in each dimension, and room for the rounding of the sums.
    size = np.abs(q) @ np.maximum(np.abs(low), np.abs(low + CELLS * width))
    slack = (np.abs(q) @ (width / 2) * (1 + 1e-6) + size * 1e-12 * (len(low) + 2) + 1e-6)[:, None]
    return middle - slack, middle + slack


def approximation_file(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(dims, cb, ids, places, low, width, cells): one row a block of vectors of one length, written once."""
    blocks = max(1, -(-vectors.count() // block))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["v"].to_numpy()).reshape(len(rows), -1)
        ids, *grid = approximation(rows["vec_id"].to_numpy(), x)
        return pd.DataFrame([(x.shape[1], int(rows["cb"].iloc[0]), ids, places(rows["vec_id"].to_numpy(), x).tobytes(), *grid)], columns=["dims", "cb", "ids", "places", "low", "width", "cells"])

    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    rows = vectors.select("vec_id", "v", F.size("v").alias("dims"), spread.alias("cb"))
    return materialise(rows.groupBy("dims", "cb").applyInPandas(pack, "dims int, cb int, ids binary, places binary, low binary, width binary, cells binary"), "va-file")


def survivors(file: DataFrame, queries: DataFrame, k: int, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, vec_id, lower, upper) of what may be among a query's k best by the cells of all blocks.

    Of equal vectors only the k + 1 of the least ids can be, one of which may be the query: ties go to the smaller id.
    """
    counts = file.groupBy("dims").agg(F.collect_list("cb").alias("cbs"))  # the numbers of a length's blocks
    query_blocks = max(1, -(-queries.count() // query_block))
    spread = F.pmod(F.xxhash64("vec_id", "v"), F.lit(query_blocks)).cast("int")

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        return pd.DataFrame([(int(rows["dims"].iloc[0]), int(rows["qb"].iloc[0]), rows["vec_id"].to_numpy(np.int64).tobytes(), x.tobytes())], columns=["dims", "qb", "q_ids", "q"])

    packed = queries.select("vec_id", "v", F.size("v").alias("dims"), spread.alias("qb")).groupBy("dims", "qb").applyInPandas(pack, "dims int, qb int, q_ids binary, q binary")
    # A block of queries goes to each block of its length: the same rows of cells are never moved for queries of another.
    packed = packed.join(counts, "dims").withColumn("cb", F.explode("cbs")).drop("cbs")
    met = packed.join(file, ["dims", "cb"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, q_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                low, width = np.frombuffer(r.low), np.frombuffer(r.width)
                q, cells = np.frombuffer(r.q).reshape(len(q_ids), r.dims), np.frombuffer(r.cells, np.uint8).reshape(len(ids), r.dims)
                may = np.frombuffer(r.places, np.int32) <= k
                step = max(1, AT_ONCE // len(ids))
                for at in range(0, len(q_ids), step):
                    part = q_ids[at : at + step]
                    lower, upper = block_bounds(q[at : at + step], low, width, cells)
                    own = part[:, None] == ids[None, :]
                    lower[own] = -np.inf
                    kth = np.partition(lower, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(part), -np.inf)
                    i, j = np.nonzero((upper >= kth[:, None]) & ~own & may)
                    yield pd.DataFrame({"query_id": part[i], "vec_id": ids[j], "lower": lower[i, j], "upper": upper[i, j]})

    found = met.mapInPandas(scan, "query_id long, vec_id long, lower double, upper double")
    # Rows that repeat an id are as many candidates, and bound as many places.
    best = found.groupBy("query_id").agg(kth_best(F.col("lower"), k).alias("__least"))
    return found.join(best, "query_id").filter("upper >= __least").drop("__least")


def kth_best(score: Column, k: int) -> Column:
    """The k-th highest score of a group, minus infinity if it has fewer; k rows a block and query come together at most."""
    best = F.slice(F.sort_array(F.collect_list(score), asc=False), 1, k)
    return F.when(F.size(best) < k, F.lit(float("-inf"))).otherwise(F.element_at(best, -1).cast("double"))


def exact(pairs: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, vec_id, score) of the pairs, whose exact vectors alone are read."""
    x = vectors.select("vec_id", F.col("v").alias("__v"))
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("__q"))
    both = pairs.select("query_id", "vec_id").distinct().join(x, "vec_id").join(q, "query_id").filter(F.size("__v") == F.size("__q"))
    product = F.aggregate(F.zip_with("__v", "__q", lambda a, b: a * b), F.lit(0).cast("long"), lambda total, p: total + p)
    return both.select("query_id", "vec_id", product.alias("score"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest scores of each query among all vectors but its own.

    Both frames have vec_id and v, an array of whole numbers; ids of queries are taken to be unique.
    """
    left = materialise(survivors(approximation_file(vectors, block), queries, k, query_block), "va-survivors")
    # The k of the highest bounds are read first; of the rest, what may still reach the k-th score found.
    upper = F.slice(F.sort_array(F.collect_list("upper"), asc=False), 1, k)
    reach = left.groupBy("query_id").agg(upper.alias("__best")).select("query_id", F.element_at("__best", -1).alias("__reach"))
    placed = left.join(reach, "query_id").withColumn("__first", F.col("upper") >= F.col("__reach")).drop("__reach")
    first = materialise(exact(placed.filter("__first"), vectors, queries), "va-first")
    certain = first.groupBy("query_id").agg(kth_best(F.col("score"), k).alias("__kth"))
    second = placed.filter("not __first").join(certain, "query_id").filter("upper >= __kth")
    scores = first.unionByName(exact(second, vectors, queries))
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k)
    ranked = scores.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("pos", "hit"))
    return ranked.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))


def whole_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): each component times ``scale``, rounded down; vectors that can't take part are left out."""
    v = F.col("embedding")
    sound = v.isNotNull() & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))), F.lit(True))
    return embeddings.filter(sound & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def op10_vector_approximation_search(spark, sf_dir):
    """The five nearest of every fiftieth vector among all vectors."""
    vectors = materialise(whole_vectors(table(spark, sf_dir, "embeddings")), "va-vectors")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM m)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
