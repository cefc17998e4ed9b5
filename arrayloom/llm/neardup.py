"""Near-duplicate documents: b-bit MinHash signatures, a multi-index Hamming join, links confirmed on whole shingle sets.

A signature has SYMBOLS symbols of 16 bits. It is split into CHUNKS chunks; two signatures that differ in at most
DISTANCE symbols differ by pigeonhole in at most one symbol of some chunk. So each chunk is indexed with each of
its symbols left out in turn (all the ways of one error), and every pair within the distance meets under some
key. Pairs beyond the distance mostly meet too: only one with two errors in every chunk is missed, with a chance
of 2e-8 at a likeness of 0.85 and 1.1e-6 at 0.80. Likenesses at which it is above MISSED are refused.

Equal shingle sets are one node from the start. First every node of a key is compared with the key's least node
only, and the confirmed links are followed to components. Then all pairs under a key that lie in different
components are compared too, but for those whose sizes or long sketches prove that they are too far apart: what is
never compared is already connected or too far apart. A key's nodes meet in blocks, so no task holds all of a frequent key.

Defined results: texts without words are linked with nothing; shingles beyond the last whole one don't exist, and
fewer than ``width`` words are one shingle; rows without an id are kept and linked with nothing; repeated rows
belong to one node; an empty table gives an empty result; other columns pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, spread_join, table
from arrayloom.llm.components import components

WIDTH, PERCENT = 5, 85
SYMBOLS, CHUNKS, DISTANCE = 32, 8, 15
#: The chance of missing a pair of just the likeness asked for, at most.
MISSED = 1e-5
#: Bytes of a long sketch.
BINS = 1_024
#: Nodes of a key that meet in one block.
BLOCK = 512
KEPT_WORDS = 150_000

PRIME = np.uint64(0x100000001B3)


def mix64(h: np.ndarray) -> np.ndarray:
    """Murmur's finaliser."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words, kept while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingles(text: str | None, hashes: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words, A-Z in lower case."""
    words = (text or "").encode().lower().split()  # of bytes: ASCII letters and blanks only
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=7)] if words else [], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - width + 1
    out = h[:n].copy()
    for i in range(1, width):
        out = out * PRIME + h[i : i + n]
    return np.unique(mix64(out))


RNG = np.random.default_rng(77)
ODD, ADD = (RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


def signature(found: np.ndarray) -> np.ndarray:
    """SYMBOLS symbols of 16 bits, each from the least of the hashes under its own permutation."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at : at + 2048, None] * ODD + ADD
        np.minimum(least, part.min(axis=0), out=least)
    return (mix64(least) >> np.uint64(48)).astype(np.int32)


def sketch(found: np.ndarray) -> bytes:
    """One byte for each of BINS bins: the sum of the checks of all hashes that fall in it."""
    h = mix64(found * np.uint64(0x9E3779B97F4A7C15))
    check = (h >> np.uint64(40)) % np.uint64(255) + np.uint64(1)
    return (np.bincount((h % np.uint64(BINS)).astype(np.int64), check, BINS).astype(np.int64) & 255).astype(np.uint8).tobytes()


def close(a: np.ndarray, b: np.ndarray, n_a, n_b, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of n_a and n_b members with these sketches can be as like as that; never false of a pair that is.

    Their sizes must be as near as their likeness. Bins that differ hold at least a member each that is in one set
    only, and of these there are at most (1 - likeness) / (1 + likeness) of both sizes.
    """
    differ = (a != b).sum(-1)
    sizes = 100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)
    return sizes & (differ * (100 + percent) <= (100 - percent) * (n_a + n_b))


def missed(percent: int) -> float:
    """The chance that a pair of that likeness meets under no key: each chunk has two errors or more."""
    like, size = percent / 100, SYMBOLS // CHUNKS
    return (1 - like**size - size * (1 - like) * like ** (size - 1)) ** CHUNKS


def described(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, th and, of its text, n_shingles, set (128-bit hash), sig and sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(t, hashes, width) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "th": batch["th"],
                    "n_shingles": np.array([len(s) for s in sets], np.int64),
                    "set": pd.Series([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], dtype=object, index=batch.index),
                    "sig": pd.Series([signature(s) if len(s) else None for s in sets], dtype=object, index=batch.index),
                    "sketch": pd.Series([sketch(s) if len(s) else None for s in sets], dtype=object, index=batch.index),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(run, f"doc_id {kind}, th long, n_shingles long, set binary, sig array<int>, sketch binary")


def with_sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            yield pd.DataFrame({"id": batch["doc_id"], "hashes": [shingles(t, hashes, width).view(np.int64) for t in batch["text"]]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"id {kind}, hashes array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets are as like as asked, in whole numbers; the pairs of a node that is in many are split."""
    named = lambda x: sets.select(F.col("id").alias(x), F.col("hashes").alias(f"set_{x}"))
    joined = spread_join(spread_join(pairs, named("b"), "b", "a"), named("a"), "a", "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return joined.select("a", "b", both.alias("n"), (F.size("set_a") + F.size("set_b")).alias("all")).filter(F.col("n") * 100 >= (F.col("all") - F.col("n")) * percent).select("a", "b").distinct()


def keys_of(nodes: DataFrame) -> DataFrame:
    """(key, id): for each chunk of the signature and each of its symbols, the hash of the others."""
    size = SYMBOLS // CHUNKS
    keys = [F.xxhash64(F.lit(c * size + j), *[F.col("sig")[c * size + i] for i in range(size) if i != j]) for c in range(CHUNKS) for j in range(size)]
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "id")


def near_pairs(rows: pd.DataFrame, percent: int):
    """Pairs of one block: in different components, of close sketches, and meeting under no earlier key than this.

    ``side`` is 0 for rows of the block's first part, 1 for those of the second, 2 if both are the same part.
    """
    sig, comp = np.stack(rows["sig"].to_numpy()), rows["comp"].to_numpy()
    bits = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), BINS)
    n = rows["n"].to_numpy()
    ids, side, number = rows["id"].to_numpy(), rows["side"].to_numpy(), int(rows["number"].iloc[0])
    size = SYMBOLS // CHUNKS
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    for i in left:
        some = right[(comp[right] != comp[i]) & ((ids[right] > ids[i]) if side[i] == 2 else True)]
        some = some[close(bits[i], bits[some], n[i], n[some], percent)] if len(some) else some
        if not len(some):
            continue
        errors = (sig[some] != sig[i]).reshape(len(some), CHUNKS, size)
        chunk = (errors.sum(axis=2) <= 1).argmax(axis=1)
        place = errors[np.arange(len(some)), chunk].argmax(axis=1)  # 0 if they agree
        first = some[chunk * size + place == number]
        yield from ((min(ids[i], ids[j]), max(ids[i], ids[j])) for j in first)


def cross_pairs(nodes: DataFrame, members: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components among the members of each key."""
    rows = members.join(labels, "id", "left").withColumn("comp", F.coalesce("component", "id"))
    # Members of a component per key, added up before the shuffle. A key's largest component meets the others only.
    parts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    open_ = parts.groupBy("key").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n")).filter("comps > 1")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    open_ = open_.select("key", F.col("top.comp").alias("top"), blocks(F.col("top.n")).alias("tops"), blocks(F.col("n") - F.col("top.n")).alias("rests"))
    rows = rows.select("key", "id", "comp").join(open_, "key").join(nodes.select("id", "sig", "sketch", F.col("n_shingles").alias("n")), "id")
    # The others' blocks come first, 0 to rests - 1. A member of the largest component goes to its own block's meetings
    # with each of them; any other meets all blocks.
    is_top = F.col("comp") == F.col("top")
    rows = rows.withColumn("own", F.when(is_top, F.col("rests") + F.pmod(F.xxhash64("id"), F.col("tops"))).otherwise(F.pmod(F.xxhash64("id"), F.col("rests"))).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.when(is_top, F.col("rests")).otherwise(F.col("rests") + F.col("tops")) - 1)).alias("other"))
    rows = rows.select("key", "id", "comp", "sig", "sketch", "n", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"))
    # Which of a signature's keys this is; equal to all members of the key.
    size = SYMBOLS // CHUNKS
    numbers = F.array(*[F.xxhash64(F.lit(c * size + j), *[F.col("sig")[c * size + i] for i in range(size) if i != j]) for c in range(CHUNKS) for j in range(size)])
    rows = rows.withColumn("number", (F.array_position(numbers, F.col("key")) - 1).cast("int"))
    rows = rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            group = batch[["key", "x", "y"]].to_numpy()
            cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            starts = np.r_[0, cuts]
            rest = batch.iloc[starts[-1] :]
            yield found([batch.iloc[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)])
        if rest is not None:
            yield found([rest])

    def found(groups: list[pd.DataFrame]) -> pd.DataFrame:
        pairs = [p for g in groups if len(g) > 1 for p in near_pairs(g, percent)]
        return pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")

    return rows.mapInPandas(run, "a long, b long").distinct()


def close_stars(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches are close."""
    named = lambda x: nodes.select(F.col("id").alias(x), F.col("sketch").alias(f"s_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    joined = spread_join(spread_join(pairs, named("b"), "b", "a"), named("a"), "a", "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c]), np.uint8).reshape(-1, BINS) for c in ("s_a", "s_b"))
            yield batch.loc[close(a, b, batch["n_a"].to_numpy(), batch["n_b"].to_numpy(), percent), ["a", "b"]]

    return joined.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) for every row of ``docs`` (doc_id, text); th is the text's hash."""
    if missed(percent) > MISSED:
        raise ValueError(f"the keys find too few of the pairs at a likeness of {percent} %")
    texts = docs.select("doc_id", "text", F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"))
    rows = materialise(described(texts, width), "dup-rows")
    nodes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("set").agg(F.min(F.struct("doc_id", "th")).alias("id"), F.min("sig").alias("sig"), F.min("sketch").alias("sketch"), F.min("n_shingles").alias("n_shingles"))
    nodes = materialise(nodes.select("set", F.col("id.doc_id").alias("id"), F.col("id.th").alias("th"), "sig", "sketch", "n_shingles"), "dup-nodes")
    keys = keys_of(nodes)
    shared = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last").select("key", "hub")
    members = materialise(keys.join(shared, "key"), "dup-members")
    stars = materialise(members.filter("hub <> id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "dup-stars")
    wanted = members.select("id").distinct().join(nodes.select("id", F.col("th").alias("__th")), "id")
    sets = materialise(with_sets(texts.join(wanted, (F.col("doc_id") == F.col("id")) & (F.col("th") == F.col("__th")), "left_semi"), width), "dup-sets")
    links = materialise(confirmed(materialise(close_stars(stars, nodes, percent), "dup-close"), sets, percent), "dup-links")
    labels = components(links)
    crossing = materialise(cross_pairs(nodes, members, labels, percent), "dup-crossing")
    more = materialise(confirmed(crossing, sets, percent), "dup-links")
    if not more.isEmpty():
        labels = components(labels.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = nodes.join(labels, "id", "left").select("set", F.coalesce("component", "id").alias("component_id"))
    out = rows.select("doc_id", "th", "n_shingles", "set").join(named, "set", "left")
    return out.select("doc_id", "th", "n_shingles", F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))


def deduplicate(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component; rows without an id stay."""
    gone = near_duplicates(docs, width, percent).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op7_minhash_multi_index(spark, sf_dir):
    """Every document with its component of near duplicates and whether it stays."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [md5(array_to_string(w, ' ') || ' short')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) END) AS h FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS id, doc_id AS node FROM d UNION SELECT r.id, l.b FROM r JOIN l ON r.node = l.a),
k AS (SELECT id, min(node) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN k ON k.id = d.doc_id
"""
