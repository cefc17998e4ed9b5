"""Repeated passages of words, by automata of recurring phrases.

All documents are read for phrases of PHRASE words that are found at two places of the corpus; a window of WINDOW
words can only recur around one. The windows that share such a phrase, in whichever documents, lie in one shard.
Each shard confirms which windows recur, compiles them into an Aho-Corasick automaton, and streams all its text
through it, which locates every occurrence word by word: the first of a window stays, the words of all later ones
go. Hashes only bring texts together. A text is streamed by the shards whose phrases it holds, and there only as
far as the phrase's windows reach, so the work grows with the corpus and not with the number of its shards.

Defined results: a null text has no words; rows without an id, and texts of fewer words than a window, are left
as they are; ids are taken to be unique, and rows that repeat both id and text are one document, not copies of
each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrayloom.llm.common import materialise, table
from arrayloom.llm.recurrence import anchor_table, by_group, candidates, chunks, copies, grams, least_grams, mix64

WINDOW, PHRASE = 20, 8
#: Words of a shard, which has one automaton, about.
SHARD = 200_000
#: Places of a phrase beyond which its windows are dealt out one by one.
HOT = 2_048
KEPT_WORDS = 300_000


def word_hashes():
    kept: dict[bytes, int] = {}

    class Hashes(dict):
        def __missing__(self, word):
            if len(self) > KEPT_WORDS:
                self.clear()
            self[word] = h = xxhash.xxh64_intdigest(word)
            return h

    kept = Hashes()

    def elements(text: str) -> np.ndarray:
        words = text.encode().split()  # of bytes: at ASCII blanks only
        return np.fromiter(map(kept.__getitem__, words), np.uint64, len(words))

    return elements


def coded(numbers: np.ndarray) -> str:
    """Three letters for each number below 2**54, each place with letters of its own, so that matches can't straddle words."""
    numbers = np.asarray(numbers, np.int64)
    out = np.empty((len(numbers), 3), "<u4")
    for place in range(3):
        out[:, place] = 0x10000 + (place << 18) + (numbers >> (18 * place) & (1 << 18) - 1)
    return out.tobytes().decode("utf-32-le")


def letters(numbers: np.ndarray) -> tuple[str, int]:
    """A text of the numbers, and its letters a number: one while there are enough of them, else three."""
    if len(numbers) and int(numbers.max()) >= 0x10FF00 - 0x900:
        return coded(numbers), 3
    codes = numbers + 0x100
    return (codes + np.where(codes >= 0xD800, 0x800, 0)).astype("<u4").tobytes().decode("utf-32-le"), 1


def occurrences(text: str, automaton) -> np.ndarray:
    """Places, in words, of every phrase of PHRASE words of the automaton in a coded text."""
    return np.fromiter((end + 1 for end, _ in automaton.iter(text)), np.int64) // 3 - PHRASE


def compiled(text: str, each: int, starts: np.ndarray) -> ahocorasick.Automaton:
    """The automaton of the windows that start there, each under its own number."""
    automaton = ahocorasick.Automaton()
    for p in starts.tolist():
        window = text[each * p : each * (p + WINDOW)]
        if window not in automaton:
            automaton.add_word(window, len(automaton))
    automaton.make_automaton()
    return automaton


def contexts(found: DataFrame) -> DataFrame:
    """(h, side, doc_id, pos, words, n): the words of each run of windows with the recurring least phrase ``h``, joined by a space.

    Of equal contexts in a chunk of documents only the first is sent on; the ``n`` windows of the others are sure to
    go and have no words. Where a phrase has more than HOT places, each window is a context of its own, under the
    hash of its words as ``side``: equal windows still meet, and no task gets all contexts of the phrase.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        elements = word_hashes()
        for batch in batches:
            for rows, texts in chunks(batch, elements, SHARD):
                lengths = np.array([len(t) for t in texts])
                x = np.concatenate(texts)
                _, least = least_grams(x, lengths, PHRASE, WINDOW)
                if not len(least):
                    continue
                known, often = anchor_table(rows)
                cuts = np.r_[0, np.flatnonzero(least[1:] != least[:-1]) + 1, len(least)]
                runs = np.flatnonzero(np.isin(least[cuts[:-1]], known) & (least[cuts[:-1]] != 0))
                first, end = cuts[runs], cuts[runs + 1]
                hot = often[np.searchsorted(known, least[first])] > HOT
                single = np.concatenate([np.arange(a, b) for a, b in zip(first[hot], end[hot], strict=True)]) if hot.any() else np.empty(0, np.int64)
                first, end = np.r_[first[~hot], single], np.r_[end[~hot], single + 1]
                sides = np.r_[np.zeros(int((~hot).sum()), np.uint64), mix64(grams(x, WINDOW))[single] | np.uint64(1)].view(np.int64)
                starts = np.cumsum(lengths) - lengths
                row = np.searchsorted(starts, first, side="right") - 1
                ids, pos = rows["doc_id"].to_numpy(np.int64)[row], first - starts[row]
                order = np.lexsort((pos, ids))
                held, at, words = {}, -1, []
                out = []
                texts_ = rows["text"].tolist()
                for i in order.tolist():
                    if row[i] != at:
                        at = row[i]
                        words = (texts_[at] or "").encode().split()
                    own = b" ".join(words[pos[i] : pos[i] + end[i] - first[i] + WINDOW - 1])
                    h, place = int(least[first[i]].view(np.int64)), (int(ids[i]), int(pos[i]))
                    known_place = held.setdefault((h, own), place)
                    if known_place is place:
                        out.append((h, int(sides[i]), *place, own, int(end[i] - first[i])))
                    elif known_place != place:  # a repeated row is the same context at the same place
                        out.append((place[0] * 1_000_003 + place[1], 0, *place, None, int(end[i] - first[i])))
                yield pd.DataFrame(out, columns=["h", "side", "doc_id", "pos", "words", "n"])

    return found.mapInPandas(run, "h long, side long, doc_id long, pos int, words binary, n int")


class Numbers(dict):
    """Words by number, in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def located(rows: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(doc_id, start) of the windows that an automaton finds at an earlier place too, among whole groups of contexts sorted by (h, side).

    A shard is as many groups as hold about SHARD words. Windows that are found twice by hash are its recurring
    phrases; its automaton of these streams all the shard's contexts, and its matches alone tell what is equal.
    """
    key = rows[["h", "side"]].to_numpy()
    cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(rows)].tolist()
    ids, pos, contexts_ = rows["doc_id"].to_numpy(np.int64), rows["pos"].to_numpy(np.int64), rows["words"].tolist()
    numbers = Numbers()
    shard: list[int] = []
    held: list[bytes] = []
    sizes: list[int] = []
    count = 0

    def found() -> tuple[np.ndarray, np.ndarray]:
        words = b" ".join(held).split(b" ")
        x, lengths = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), np.array(sizes)
        row = np.repeat(np.arange(len(shard)), lengths)
        begin = np.cumsum(lengths) - lengths
        whole = np.flatnonzero((begin + lengths)[row] - np.arange(len(x)) >= WINDOW)
        hashes = mix64(grams(mix64(x.view(np.uint64) + np.uint64(1)), WINDOW))[whole]
        order = np.argsort(hashes, kind="stable")
        same = hashes[order[1:]] == hashes[order[:-1]]
        new = whole[order[np.flatnonzero(same & ~np.r_[False, same[:-1]])]]
        if not len(new):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        text, each = letters(x)
        automaton = compiled(text, each, new)
        hits = np.fromiter(automaton.iter(text), [("end", "i8"), ("phrase", "i8")])
        at, phrase = (hits["end"] + 1) // each - WINDOW, hits["phrase"]
        inside = at + WINDOW <= (begin + lengths)[row[at]]  # not across two contexts
        at, phrase = at[inside], phrase[inside]
        mine = np.array(shard)[row[at]]
        doc, start = ids[mine], pos[mine] + at - begin[row[at]]
        order = np.lexsort((start, doc, phrase))
        doc, start, phrase = doc[order], start[order], phrase[order]
        opens = np.r_[True, phrase[1:] != phrase[:-1]]
        lead = np.maximum.accumulate(np.where(opens, np.arange(len(phrase)), 0))
        later = (doc != doc[lead]) | (start != start[lead])
        return doc[later], start[later]

    for a, b in zip(cuts, cuts[1:]):
        group = [i for i in range(a, b) if contexts_[i] is not None]
        if len(group) == 1:  # can only repeat itself, and so some word
            own = contexts_[group[0]].split(b" ")
            if len(set(own)) == len(own):
                continue
        shard += group
        held += [contexts_[i] for i in group]
        sizes += [contexts_[i].count(b" ") + 1 for i in group]
        count += sum(sizes[len(sizes) - len(group) :])
        if count >= SHARD:
            yield found()
            numbers, shard, held, sizes, count = Numbers(), [], [], [], 0
    if shard:
        yield found()


def removals(found: DataFrame) -> DataFrame:
    """(doc_id, starts): windows whose words also start earlier in the corpus."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, ["h", "side"], SHARD // WINDOW):
            sure = rows[rows["words"].isna()]
            n = sure["n"].to_numpy(np.int64)
            starts = np.repeat(sure["pos"].to_numpy(np.int64) - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield pd.DataFrame({"doc_id": np.repeat(sure["doc_id"].to_numpy(np.int64), n), "pos": starts.astype(np.int32)})
            for doc, start in located(rows):
                yield pd.DataFrame({"doc_id": doc, "pos": start.astype(np.int32)})

    rows = contexts(found).repartition("h", "side").sortWithinPartitions("h", "side")
    return rows.mapInPandas(run, "doc_id long, pos int").groupBy("doc_id").agg(F.collect_set("pos").alias("starts"))


def kept_words(text: str | None, starts) -> tuple[int, list[bytes]]:
    """How many words go, and those that stay."""
    words = (text or "").encode().split()
    gone = np.zeros(len(words) + 1, np.int64)
    starts = np.asarray(starts, np.int64)
    starts = starts[starts + WINDOW <= len(words)]
    np.add.at(gone, starts, 1)
    np.add.at(gone, starts + WINDOW, -1)
    stays = np.cumsum(gone[:-1]) == 0
    return int((~stays).sum()), [w for w, s in zip(words, stays, strict=True) if s]


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, th, sha256): the words of each text, the digest of the text, and that of its words joined by a space; written once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch["text"]:
                data = (t or "").encode()
                words = data.split()
                out.append((len(words), hashlib.md5(data).digest(), hashlib.sha256(b" ".join(words)).hexdigest()))
            n, th, sha = zip(*out) if out else ((), (), ())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": np.array(n, np.int64), "th": pd.Series(th, dtype=object, index=batch.index), "sha256": pd.Series(sha, dtype=object, index=batch.index)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialise(docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_words long, th binary, sha256 string"), "passages-info")


def without_repeats(docs: DataFrame, info: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each document that loses words; ``kept`` is its remaining words, joined by a space.

    ``info`` is what ``described`` gives of the documents, if it is at hand.
    """
    info = described(docs) if info is None else info
    later = materialise(copies(info.filter(F.col("n_words") >= WINDOW)), "passages-copies")
    found = candidates(docs, word_hashes, PHRASE, WINDOW, later)
    gone = removals(found)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [kept_words(t, s) for t, s in zip(batch["text"], batch["starts"], strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_removed": [n for n, _ in kept], "kept": [b" ".join(w).decode() for _, w in kept]})

    cut = found.select("doc_id", "text").join(gone, "doc_id").mapInPandas(run, "doc_id long, n_removed long, kept string")
    whole = info.join(later, "doc_id").select("doc_id", F.col("n_words").alias("n_removed"), F.lit("").alias("kept"))
    return cut.unionByName(whole).dropDuplicates(["doc_id"])


def op5_repeated_phrases(spark, sf_dir):
    """Every document without the words of windows that also start earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = described(docs)
    cut = without_repeats(docs, base).select("doc_id", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("cut_sha256"))
    out = base.join(cut, "doc_id", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("cut_sha256", "sha256").alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS p, w FROM d WHERE len(w) >= 20),
h AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) AS h FROM s),
r AS (SELECT doc_id, p, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS n FROM h),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM r WHERE n > 1),
e AS (SELECT d.doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT e.doc_id, count(g.p) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY e.p) FILTER (g.p IS NULL), '') AS kept FROM e LEFT JOIN g ON g.doc_id = e.doc_id AND g.p = e.p GROUP BY e.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
