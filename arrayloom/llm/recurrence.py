"""Which sampled grams of a corpus recur: the filter before exact work on repeated passages.

A text is a row of elements (words or bytes). Every window of ``window`` elements has a least gram of ``k``
elements by hash; equal windows have equal least grams, so a window can only recur if its least gram does. Only
the least grams are counted, about two in (window - k + 2) positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, spread_join

PRIME = 0x9E3779B97F4A7C15
#: Elements of several texts that are worked on together.
CHUNK = 1_000_000


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def grams(x: np.ndarray, k: int, prime: int = PRIME) -> np.ndarray:
    """Polynomial hashes of all runs of ``k`` elements, by doubling the length."""
    done, length, part, size = None, 0, x, 1
    while True:
        if k & size:
            if done is None:
                done, length = part, size
            else:  # done covers the first ``length`` elements, part the next ``size``
                n = len(x) - length - size + 1
                done = done[:n] * np.uint64(pow(prime, size, 1 << 64)) + part[length : length + n]
                length += size
        if length == k:
            return done
        n = len(x) - 2 * size + 1
        part = part[:n] * np.uint64(pow(prime, size, 1 << 64)) + part[size : size + n]
        size *= 2


def slide(x: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` (minimum or maximum) over all runs of ``width``."""
    size = 1
    while size * 2 <= width:
        x = f(x[: len(x) - size], x[size:])
        size *= 2
    return f(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def least_grams(x: np.ndarray, lengths: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each gram, the least of each window) of texts laid end to end; windows across texts have 0."""
    if len(x) < window:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    v = mix64(grams(x, k)) | np.uint64(1)
    least = slide(v, window - k + 1, np.minimum)
    ends = np.repeat(np.cumsum(lengths), lengths)
    return v, np.where(ends[: len(least)] - np.arange(len(least)) >= window, least, np.uint64(0))


def sampled(x: np.ndarray, lengths: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are least in some window of one text."""
    v, least = least_grams(x, lengths, k, window)
    if not len(v):
        return np.empty(0, np.int64), v
    pad = np.zeros(window - k, np.uint64)
    most = slide(np.concatenate([pad, least, pad]), window - k + 1, np.maximum)
    at = np.flatnonzero(most == v)
    return at, v[at]


def chunks(batch: pd.DataFrame, elements: Callable[[str], np.ndarray], most: int = CHUNK) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Runs of the rows, with their texts' elements, of about ``most`` elements together."""
    start, kept, total = 0, [], 0
    for i, t in enumerate(batch["text"]):
        kept.append(elements(t or ""))
        total += len(kept[-1])
        if total >= most:
            yield batch.iloc[start : i + 1], kept
            start, kept, total = i + 1, [], 0
    if kept:
        yield batch.iloc[start:], kept


def recurring(docs: DataFrame, make_elements: Callable[[], Callable[[str], np.ndarray]], k: int, window: int, skip: DataFrame) -> DataFrame:
    """(doc_id, anchors, often): the sampled grams of each document that are found at two places or more in the corpus, and at how many.

    Grams are aggregated before the shuffle, to one row for those of a chunk of documents, so a gram that many
    documents share arrives once a chunk. ``skip`` holds doc_ids to leave out of the result.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        elements = make_elements()
        for batch in batches:
            for rows, texts in chunks(batch, elements):
                lengths = np.array([len(t) for t in texts])
                at, h = sampled(np.concatenate(texts), lengths, k, window)
                ids = np.repeat(rows["doc_id"].to_numpy(np.int64), lengths)[at]
                order = np.lexsort((ids, h))
                h, ids = h[order], ids[order]
                new = np.r_[True, h[1:] != h[:-1]] if len(h) else np.zeros(0, bool)
                starts = np.flatnonzero(new)
                counts = np.diff(np.r_[starts, len(h)])
                more = np.full(len(starts), None, object)
                for i in np.flatnonzero(counts > 1):
                    own = np.unique(ids[starts[i] : starts[i] + counts[i]])
                    more[i] = own[1:] if len(own) > 1 else None
                yield pd.DataFrame({"h": h[starts].view(np.int64), "n": counts.astype(np.int32), "doc_id": ids[starts], "more": more})

    found = docs.filter("doc_id is not null").select("doc_id", "text").mapInPandas(run, "h long, n int, doc_id long, more array<bigint>")
    # A gram has one row a chunk at most, so the rows that meet here are bounded by the chunks, not the documents.
    twice = found.withColumn("n", F.sum("n").over(Window.partitionBy("h"))).filter("n >= 2")
    each = twice.select("h", "n", F.explode(F.concat(F.array("doc_id"), F.coalesce("more", F.array().cast("array<bigint>")))).alias("doc_id"))
    own = each.join(skip, "doc_id", "left_anti").groupBy("doc_id").agg(F.collect_set(F.struct("h", "n")).alias("own"))
    return own.select("doc_id", F.col("own.h").alias("anchors"), F.col("own.n").alias("often"))


def copies(info: DataFrame) -> DataFrame:
    """doc_ids of documents whose whole text is also that of a smaller id; ``info`` has doc_id and th (128 bits)."""
    firsts = info.filter("doc_id is not null").groupBy("th").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("th", "first")
    return spread_join(info, firsts, "th", "doc_id").filter("doc_id <> first").select("doc_id").distinct()


def candidates(docs: DataFrame, make_elements, k: int, window: int, skip: DataFrame) -> DataFrame:
    """The documents that may hold a recurring window: doc_id, text, the anchors that tell where, and how often each is found."""
    found = recurring(docs, make_elements, k, window, skip)
    return materialise(docs.select("doc_id", "text").join(found, "doc_id"), "recurring")


def anchor_table(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, how often each is found in the corpus) of all the anchors of some candidate documents."""
    h = np.concatenate([np.asarray(a, np.int64) for a in rows["anchors"]]).view(np.uint64)
    h, first = np.unique(h, return_index=True)
    return h, np.concatenate([np.asarray(a, np.int64) for a in rows["often"]])[first]


def by_group(batches: Iterator[pd.DataFrame], keys: list[str], most: int) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that are sorted by ``keys``, as many together as hold about ``most`` rows."""
    held: list[pd.DataFrame] = []
    count = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        count += len(batch)
        if count < most:
            continue
        own = batch[keys].to_numpy()
        cut = np.flatnonzero((own[1:] != own[:-1]).any(axis=1))
        if not len(cut):
            continue  # the last group may go on
        at = int(cut[-1]) + 1
        yield pd.concat([*held[:-1], batch.iloc[:at]], ignore_index=True)
        held, count = [batch.iloc[at:]], len(batch) - at
    if held:
        yield pd.concat(held, ignore_index=True)
