"""Repeated byte strings, by the interval tree of an enhanced suffix array.

Only windows whose least gram recurs can recur (see ``recurrence``). The windows of a document that share one
such gram form a context of less than two windows' bytes; contexts meet by their gram, equal ones as one. A
suffix array over a chunk of contexts, with the common prefix of neighbours, is scanned with a stack: each
interval of common prefix is a repeat, and it is maximal to the left if its suffixes are preceded by different
bytes. The maximal repeats of LEAST bytes or more have all their occurrences, and every repeated window lies in one of
them. Grams only bring contexts together: which bytes repeat, the interval tree alone decides.

The contexts of a gram with more than BLOCK places are dealt by what stands beside the gram: a window that holds
it also holds (LEAST - GRAM) / 2 bytes on one of its sides, so equal windows meet under that side's key.

Defined results: a null text has no bytes; rows without an id are left as they are; ids are taken to be unique,
and rows that repeat both id and text are one document; overlapping occurrences in one document count; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, spread_join, table
from arrayloom.llm.recurrence import anchor_table, by_group, candidates, chunks, copies, least_grams, mix64

LEAST, GRAM = 400, 200
#: Bytes of contexts that share one suffix array, about; contexts of one group that meet in one block.
ARRAY_BYTES, BLOCK = 1_000_000, 2_048

LETTERS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_elements():
    return lambda text: LETTERS[np.frombuffer(text.encode(), np.uint8)]


def suffix_array(data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix with the one before) of texts laid end to end, by doubling the compared length from seven.

    ``room`` is how many bytes are left of a byte's text. A text's end is a symbol before all bytes and unlike
    every other end, so a suffix that has ended within the compared length has a rank of its own. A rank is the
    place of a group's first suffix; only groups of several suffixes are sorted again. The ranks by 7, 14, ...
    symbols are kept, and give each common prefix from the longest to the shortest.
    """
    n = len(data)
    padded = np.concatenate([data.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = key << np.uint64(9) | np.where(room > i, padded[i : i + n], np.uint64(0))
    length = 7
    order = np.argsort(key, kind="stable")  # ends stand in the order of their texts
    open_, own, ended = np.arange(n), key[order], room[order] < length
    rank = np.empty(n, np.int32)
    levels = []
    while True:
        new = np.r_[True, (own[1:] != own[:-1]) | ended[1:]]
        rank[order[open_]] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_)), 0))]
        levels.append((length, rank.copy()))
        open_ = open_[~(new & np.r_[new[1:], True])]
        if not len(open_):
            break
        some = order[open_]
        inside = room[some] > length
        after = np.where(inside, rank[np.where(inside, some + length, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
        own = rank[some].astype(np.uint64) << np.uint64(32) | after
        again = np.argsort(own, kind="stable")
        order[open_], own, ended = some[again], own[again], ~inside[again]
        length *= 2
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    most = np.minimum(room[a], room[b])
    near = np.flatnonzero(levels[0][1][a] == levels[0][1][b])  # the others share less than seven symbols
    i, j, own, bound = a[near], b[near], np.zeros(len(near), np.int64), most[near]
    for length, ranks in reversed(levels):
        inside = own + length <= bound
        x, y = np.where(inside, i + own, 0), np.where(inside, j + own, 0)
        own += np.where(inside & (ranks[x] == ranks[y]), length, 0)
    common[near] = own
    for _ in range(6):
        inside = common < most
        x, y = np.where(inside, a + common, 0), np.where(inside, b + common, 0)
        common += inside & (data[x] == data[y])
    return order, np.r_[0, common]


class Texts:
    """Texts laid end to end, with their enhanced suffix array; ``times`` tells how often each stands for, once if it is not given."""

    def __init__(self, texts: list[bytes], times: np.ndarray | None = None):
        self.times = np.ones(len(texts), np.int64) if times is None else times
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts, self.sizes = np.cumsum(sizes) - sizes, sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        room = self.starts[self.owner] + sizes[self.owner] - np.arange(len(self.data))
        self.order, self.common = suffix_array(self.data, room)

    def intervals(self, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
        """(length, first, end) of the maximal repeats: suffixes first to end share that many bytes, no more, and not the byte before.

        A stack holds the open intervals; inner ones come out before those around them.
        """
        before = np.concatenate([[-1], self.data[:-1].astype(np.int64)])
        heads = self.starts[self.sizes > 0]
        before[heads] = -1 - np.arange(len(heads))  # a text's first byte is preceded like no other
        left, common = before[self.order], self.common
        # Runs of suffixes with such a common prefix; a run preceded by one byte throughout has no maximal repeat.
        edges = np.flatnonzero(np.diff(np.r_[False, common[1:] >= least, False].astype(np.int8)))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):  # suffixes lo..hi
            own = left[lo : hi + 1]
            if own[0] >= 0 and (own == own[0]).all():
                continue
            change = np.cumsum(np.r_[0, own[1:] != own[:-1]]).tolist()
            stack: list[tuple[int, int]] = []  # (common prefix, first suffix) of open intervals
            for at, value in enumerate([*common[lo + 1 : hi + 1].tolist(), 0], lo + 1):
                first = at - 1
                while stack and stack[-1][0] > value:
                    length, first = stack.pop()
                    if change[at - 1 - lo] != change[first - lo]:  # preceded by different bytes
                        yield length, first, at
                if value >= least and (not stack or stack[-1][0] < value):
                    stack.append((value, first))

    def covered(self, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
        """(text, start, end) of the runs of bytes that lie in an occurrence of a maximal repeat.

        A suffix's longest such occurrence is that of its innermost interval. The occurrences of nested intervals
        are never listed one by one, as a periodic text has a square of them.
        """
        longest = np.zeros(len(self.order) + 1, np.int64)
        todo: list[tuple[int, int, int]] = sorted(((f, -e, n) for n, f, e in self.intervals(least)))
        open_: list[tuple[int, int]] = []  # (end, length) of the intervals around
        at = 0
        for first, minus, length in [*todo, (len(self.order), 0, 0)]:
            while open_ and open_[-1][0] <= first:
                end, own = open_.pop()
                longest[at:end] = own
                at = max(at, end)
            if open_:
                longest[at:first] = open_[-1][1]
            at = max(at, first)
            open_.append((-minus, length))
        inside = np.flatnonzero(longest[:-1])
        mark = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(mark, self.order[inside], 1)
        np.add.at(mark, self.order[inside] + longest[inside], -1)
        # A text that stands for several is a repeat as it is.
        whole = np.flatnonzero((self.times > 1) & (self.sizes >= least))
        np.add.at(mark, self.starts[whole], 1)
        np.add.at(mark, self.starts[whole] + self.sizes[whole], -1)
        gone = np.cumsum(mark[:-1]) > 0
        # A run ends with its text.
        edge = np.r_[False, self.owner[1:] != self.owner[:-1]] if len(gone) else gone
        begin = np.flatnonzero(gone & (~np.r_[False, gone[:-1]] | edge))
        end = np.flatnonzero(gone & (~np.r_[gone[1:], False] | np.r_[edge[1:], True])) + 1
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            i = int(self.owner[a])
            yield i, a - int(self.starts[i]), b - int(self.starts[i])


    def repeats(self, least: int = LEAST) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """(length, [(text, start)]) of the maximal repeats, with all occurrences; texts that stand for several among them."""
        for length, first, end in self.intervals(least):
            where = self.order[first:end]
            yield length, list(zip(self.owner[where].tolist(), (where - self.starts[self.owner[where]]).tolist(), strict=True))
        for i in np.flatnonzero((self.times > 1) & (self.sizes >= least)).tolist():
            yield int(self.sizes[i]), [(i, 0)]

    def string(self, place: tuple[int, int], length: int) -> bytes:
        at = int(self.starts[place[0]]) + place[1]
        return self.data[at : at + length].tobytes()


def maximal_repeats(texts: list[bytes], least: int = LEAST) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(text, start)]) of every repeat of ``least`` bytes or more that can't be extended at either end by all its occurrences alike."""
    if sum(map(len, texts)) < 2:
        return
    yield from Texts(texts).repeats(least)


def flank_keys(context: bytes, places: np.ndarray) -> set[int]:
    """Hashes of what stands on either side of each place of the gram, as far as every window needs on one side."""
    side = (LEAST - GRAM) // 2
    left = {context[p - side : p] for p in places.tolist() if p >= side}
    right = {context[p + GRAM : p + GRAM + side] for p in places.tolist() if p + GRAM + side <= len(context)}
    return {xxhash.xxh64_intdigest(x, seed=s) >> 1 for s, own in ((1, left), (2, right)) for x in own}


def contexts(found: DataFrame) -> DataFrame:
    """(h, side, again, doc_id, pos, more, context): the bytes around each run of windows with the recurring least gram ``h``.

    Equal contexts of a chunk of documents are one row, with the places of the others in ``more``. ``side`` is 0
    but for grams of many places; ``again`` tells that a context has its gram at two places.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        elements = byte_elements()
        for batch in batches:
            for rows, texts in chunks(batch, elements):
                lengths = np.array([len(t) for t in texts])
                x = np.concatenate(texts)
                v, least = least_grams(x, lengths, GRAM, LEAST)
                if not len(least):
                    continue
                known, often = anchor_table(rows)
                cuts = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1, len(least)]
                runs = np.flatnonzero(np.isin(least[cuts[:-1]], known) & (least[cuts[:-1]] != 0))
                first, last = cuts[runs], cuts[runs + 1] - 1 + LEAST
                hash_ = least[first]
                hot = often[np.searchsorted(known, hash_)] > BLOCK
                data = b"".join((t or "").encode() for t in rows["text"])
                starts = np.cumsum(lengths) - lengths
                row = np.searchsorted(starts, first, side="right") - 1  # the last of those that start there: not an empty one
                ids, pos = rows["doc_id"].to_numpy(np.int64)[row], first - starts[row]
                met: dict[tuple[int, bytes], list[int]] = {}
                for i, key in enumerate(zip(hash_.tolist(), (data[a:b] for a, b in zip(first.tolist(), last.tolist(), strict=True)), strict=True)):
                    met.setdefault(key, []).append(i)
                out = []
                for (h, context), own in met.items():
                    i = own[0]
                    at = np.flatnonzero(v[first[i] : last[i] - GRAM + 1] == np.uint64(h))
                    more = [{"doc_id": int(ids[j]), "pos": int(pos[j])} for j in own[1:]]
                    for side in flank_keys(context, at) if hot[i] else (0,):
                        out.append((h - (h >> 63 << 64), side, len(at) > 1, int(ids[i]), int(pos[i]), more, context))
                yield pd.DataFrame(out, columns=["h", "side", "again", "doc_id", "pos", "more", "context"])

    return found.mapInPandas(run, "h long, side long, again boolean, doc_id long, pos int, more array<struct<doc_id:long,pos:int>>, context binary")


def arrays(rows: pd.DataFrame) -> Iterator[tuple[Texts, list[list[tuple[int, int]]]]]:
    """(texts, the places of each) of whole groups of contexts sorted by (h, side, x, y), as many together as an array holds.

    Equal contexts of a group are one text. A group of one context, at one place and with its gram once, has
    nothing that could repeat.
    """
    held: dict[bytes, set[tuple[int, int]]] = {}
    size = 0
    key = rows[["h", "side", "x", "y"]].to_numpy()
    cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(rows)].tolist()
    columns = [rows[c].tolist() for c in ("context", "doc_id", "pos", "more", "again")]

    def array() -> tuple[Texts, list[list[tuple[int, int]]]]:
        return Texts(list(held), np.array([len(own) for own in held.values()])), [sorted(own) for own in held.values()]

    for start, end in zip(cuts, cuts[1:]):
        group: dict[bytes, set[tuple[int, int]]] = {}
        again = False
        for context, d, p, more, twice in zip(*(c[start:end] for c in columns), strict=True):
            own = group.setdefault(context, set())
            own.add((d, p))
            own.update((m["doc_id"], m["pos"]) for m in more)
            again |= twice
        if len(group) > 1 or again or len(next(iter(group.values()))) > 1:
            for context, own in group.items():  # a context may be in several groups: it is not to meet itself
                held.setdefault(context, set()).update(own)
            size += sum(map(len, group))
        if size >= ARRAY_BYTES:
            yield array()
            held, size = {}, 0
    if held:
        yield array()


def met_contexts(found: DataFrame) -> DataFrame:
    """The contexts in groups that lie together: by gram, by side, and by pairs of blocks where a group holds more than a block.

    Each pair of blocks is a group of its own, so that a passage of any frequency is compared in bounded memory.
    """
    rows = contexts(found)
    often = rows.filter("side <> 0").groupBy("h", "side").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    often = often.select("h", "side", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    hot = rows.filter("side <> 0").join(often, ["h", "side"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("context"), F.col("blocks")).cast("int")  # equal contexts go together
    hot = hot.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    hot = hot.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("blocks", "own", "other")
    none = F.lit(0)
    rows = rows.filter("side = 0").withColumn("x", none).withColumn("y", none).unionByName(hot)
    return rows.repartition("h", "side", "x", "y").sortWithinPartitions("h", "side", "x", "y")


def repeated_strings(found: DataFrame) -> DataFrame:
    """(doc_id, start, end) of the candidate documents' bytes in maximal repeats."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, ["h", "side", "x", "y"], BLOCK):
            for texts, places in arrays(rows):
                out = [(d, p + a, p + b) for i, a, b in texts.covered() for d, p in places[i]]
                yield pd.DataFrame(out, columns=["doc_id", "start", "end"]).astype("int64")

    return met_contexts(found).mapInPandas(run, "doc_id long, start long, end long")


def repeat_groups(docs: DataFrame) -> DataFrame:
    """(repeat, length, doc_id, start): each maximal repeat of LEAST bytes or more, by the digest of its bytes, with all its occurrences.

    Repeats are maximal within the contexts of a gram, of less than two windows; longer ones come in overlapping parts.
    Whole texts are compared, copies of documents too. A periodic text has a square of occurrences.
    """
    docs = docs.filter("doc_id is not null").select("doc_id", "text").dropDuplicates()
    found = candidates(docs, byte_elements, GRAM, LEAST, docs.select("doc_id").filter("false"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, ["h", "side", "x", "y"], BLOCK):
            for texts, places in arrays(rows):
                yield pd.DataFrame(
                    [(hashlib.md5(texts.string(own[0], length)).hexdigest(), length, d, p + a) for length, own in texts.repeats() for i, a in own for d, p in places[i]],
                    columns=["repeat", "length", "doc_id", "start"],
                )

    return met_contexts(found).mapInPandas(run, "repeat string, length long, doc_id long, start long").distinct()


def kept_bytes(text: str | None, spans) -> tuple[int, int, bytes]:
    """Bytes that go, the runs they form, and the bytes that stay."""
    data = (text or "").encode()
    mark = np.zeros(len(data) + 1, np.int64)
    for a, b in spans:
        mark[min(a, len(data))] += 1
        mark[min(b, len(data))] -= 1
    gone = np.cumsum(mark[:-1]) > 0
    runs = int((gone & ~np.r_[False, gone[:-1]]).sum())
    return int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_removed, n_spans, kept) of each document that loses bytes; ``kept`` is the rest of its bytes."""
    text = F.coalesce("text", F.lit(""))
    info = materialise(docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.md5(text).alias("th")).filter(F.col("n_bytes") >= LEAST), "repeats-info")
    later = materialise(copies(info), "repeats-copies")
    found = candidates(docs, byte_elements, GRAM, LEAST, later)
    spans = repeated_strings(found).groupBy("doc_id").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [kept_bytes(t, [(s["start"], s["end"]) for s in own]) for t, own in zip(batch["text"], batch["spans"], strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_removed": [n for n, _, _ in kept], "n_spans": [s for _, s, _ in kept], "kept": [k for _, _, k in kept]})

    cut = found.select("doc_id", "text").join(spans, "doc_id").mapInPandas(run, "doc_id long, n_removed long, n_spans long, kept binary")
    # A text found twice goes as a whole, in each of its documents.
    alike = spread_join(info, info.filter("doc_id is not null").groupBy("th").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).filter("a < b"), "th", "doc_id")
    whole = alike.filter("doc_id is not null").select("doc_id", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")).dropDuplicates(["doc_id"])
    return whole.unionByName(cut.join(whole.select("doc_id"), "doc_id", "left_anti")).dropDuplicates(["doc_id"])


def op6_common_prefix_intervals(spark, sf_dir):
    """Every document without the bytes of strings that are found elsewhere too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = without_repeats(docs).select("doc_id", "n_removed", "n_spans", F.sha2("kept", 256).alias("cut_sha256"))
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("sha256"))
    out = base.join(cut, "doc_id", "left")
    none = F.lit(0).cast("long")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("cut_sha256", "sha256").alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 800)) AS h FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 399)) AS p FROM d WHERE length(x) >= 800)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
g AS (SELECT doc_id, p, sum(CASE WHEN p - before > 400 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS span
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM r)),
s AS (SELECT doc_id, span, min(p) AS a, max(p) + 400 AS b FROM g GROUP BY doc_id, span),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS last, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) = 1 AS final FROM s),
c AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
  string_agg(substr(x, 2 * last + 1, 2 * (a - last)) || CASE WHEN final THEN substr(x, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS kept FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id)
"""
