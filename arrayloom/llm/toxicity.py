"""Toxicity by non-negative positive-unlabelled learning, in numpy.

The classifier sees confirmed toxic texts and texts whose labels it is not told. With the class prior p, its risk
is p R+(positive) + max(0, R-(unlabelled) - p R-(positive)): the negative part is what the unlabelled texts say,
less what the toxic ones among them must add, and a batch in which it falls below zero is unlearnt instead of
followed, which keeps it from overfitting.

A text's logit is a bias plus the weights, where above zero, of all its distinct words: calm words don't undo a
toxic one. A word's weight is the sum over its hashed letter n-grams and itself, so unseen forms of a stem are
known by their grams. Nothing but the words
enters: no label, language, source or id.

Defined results: null and empty texts score by the bias alone; repeated rows get equal scores; whole texts are
read; without a positive example every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrayloom.llm.common import Kept, table

FEATURES = 1 << 18
GRAMS = (4, 5)
#: Rows that a classifier is fitted on, at most, and characters of theirs together: these bound the driver's memory, not
#: what is scored.
MOST_POSITIVE, MOST_UNLABELLED, MOST_CHARS = 3_000, 5_000, 50_000_000
#: Words of a generation of those whose weights a task keeps.
KEPT_WORDS = 100_000

#: Letters of a word, at most; longer runs are read in pieces that share as many letters as the longest gram has.
LONGEST = 64
LETTERS = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[int]:
    """Hashed places of a word and its letter n-grams, its two ends marked."""
    marked = f"<{word}>".encode()
    grams = {marked} | {marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g) % FEATURES for g in grams]


def words(text: str | None) -> set[str]:
    step = LONGEST - max(GRAMS)
    return {w[i : i + LONGEST] for w in LETTERS.findall((text or "").lower()) for i in range(0, max(len(w) - max(GRAMS), 1), step)}


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scorer(self):
        """Scores texts; the words' weights are kept for as long as they fit."""
        weights, bias = self.weights, self.bias
        kept = Kept(lambda w: float(weights[features(w)].sum()), KEPT_WORDS)

        def score(text: str | None) -> float:
            found = map(kept.__getitem__, words(text))
            z = bias + math.fsum(v for v in found if v > 0)  # in whatever order the words come
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Corpus:
    """Training texts as distinct words by number, and each word's features, in flat arrays."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        flat, lengths = array("i"), array("i")
        while texts:  # a text is let go once its words are numbered
            own = sorted(numbers.setdefault(w, len(numbers)) for w in words(texts.pop()))
            flat.extend(own)
            lengths.append(len(own))
        self.words = np.frombuffer(flat, np.int32)
        self.rows, self.count = len(lengths), len(numbers)
        self.row = np.repeat(np.arange(self.rows, dtype=np.int32), lengths)
        flat, lengths = array("i"), array("i")
        for w in numbers:
            own = features(w)
            flat.extend(own)
            lengths.append(len(own))
        self.features = np.frombuffer(flat, np.int32)
        self.owner = np.repeat(np.arange(self.count, dtype=np.int32), lengths)

    def word_weights(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.count)
        for at in range(0, len(self.features), 1 << 20):
            part = slice(at, at + (1 << 20))
            first = self.owner[at]
            sums = np.bincount(self.owner[part] - first, weights[self.features[part]])
            out[first : first + len(sums)] += sums
        return out

    def feature_sums(self, by_word: np.ndarray) -> np.ndarray:
        out = np.zeros(FEATURES)
        for at in range(0, len(self.features), 1 << 20):  # in parts, for little memory
            out += np.bincount(self.features[at : at + (1 << 20)], by_word[self.owner[at : at + (1 << 20)]], minlength=FEATURES)
        return out

    def telling(self, by_word: np.ndarray) -> np.ndarray:
        """Places in ``words`` of those with a weight above zero."""
        return np.flatnonzero(by_word[self.words] > 0)


def start(corpus: Corpus, is_positive: np.ndarray) -> np.ndarray:
    """Weights to begin with: each feature's log ratio of its shares of positive and of unlabelled texts, where above zero, over a word's usual number of features."""
    seen = np.zeros((2, FEATURES))
    for side in (0, 1):
        own = np.bincount(corpus.words[is_positive[corpus.row] == side], minlength=corpus.count)
        seen[side] = corpus.feature_sums(own)
    n = max(is_positive.sum(), 1), max((~is_positive).sum(), 1)
    ratio = np.log((seen[1] + 0.05) / n[0]) - np.log((seen[0] + 0.05 * n[1] / n[0] + 0.5) / n[1])
    return np.where(seen[1] >= 2, np.clip(ratio, 0, 3), 0) / 4


def gradient(corpus: Corpus, is_positive: np.ndarray, weights: np.ndarray, bias: float, prior: float) -> tuple[float, float, np.ndarray, float]:
    """(positive part, negative part of the risk, and the slopes by weight and bias that a step goes down).

    They are those of the sum of both parts while the negative one is not below zero, and those of its opposite,
    the negative part alone turned round, where it is.
    """
    by_word = corpus.word_weights(weights)
    used = corpus.telling(by_word)
    z = bias + np.bincount(corpus.row[used], by_word[corpus.words[used]], minlength=corpus.rows)
    up = sigmoid(z)  # loss as a negative; 1 - up: loss as a positive
    slope = up * (1 - up)
    n_positive, n_unlabelled = is_positive.sum(), max((~is_positive).sum(), 1)
    first, negative = prior * (1 - up[is_positive]).mean(), up[~is_positive].mean() - prior * up[is_positive].mean()
    grad = np.zeros(corpus.rows)
    if negative >= 0:
        grad[is_positive] = -2 * prior * slope[is_positive] / n_positive
        grad[~is_positive] = slope[~is_positive] / n_unlabelled
    else:  # below zero: climb out of it
        grad[is_positive] = prior * slope[is_positive] / n_positive
        grad[~is_positive] = -slope[~is_positive] / n_unlabelled
    of_words = np.bincount(corpus.words[used], grad[corpus.row[used]], minlength=corpus.count)
    return float(first), float(negative), corpus.feature_sums(of_words), float(grad.sum())


def fit(positive: list[str], unlabelled: list[str], prior: float, steps: int = 60, rate: float = 0.01, decay: float = 1e-4) -> Model:
    """Minimises the non-negative risk with the sigmoid loss by Adam, over all the rows at each step."""
    n_positive = len(positive)
    corpus = Corpus(unlabelled + positive)  # taken from the end
    is_positive = np.arange(corpus.rows) < n_positive
    weights, bias = start(corpus, is_positive), -2.0
    m, s, mb, sb = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    for step in range(1, steps + 1):
        _, _, g, gb = gradient(corpus, is_positive, weights, bias, prior)
        g += decay * weights / FEATURES
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        fix, fix2 = 1 - 0.9**step, 1 - 0.99**step
        weights -= rate * (m / fix) / (np.sqrt(s / fix2) + 1e-8)
        bias -= rate * (mb / fix) / (np.sqrt(sb / fix2) + 1e-8)
    return Model(weights.astype(np.float32), float(bias))


def held_out(doc_id):
    """Whether a row's label must not be learnt: the checksum of its id leaves 0 by five."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Model | None:
    """A model from the toxic rows of ``labels`` and unlabelled rows of ``docs``, both bounded samples by hash.

    The class prior is the toxic share of the labels that may be learnt. None without a positive example.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    n, toxic = known.agg(F.count(F.lit(1)), F.sum((F.col("toxic") == 1).cast("int"))).first()
    if not toxic:
        return None
    ids = known.filter("toxic = 1").select(F.col("doc_id").alias("__id")).distinct().orderBy(F.xxhash64("__id"), "__id").limit(most_positive)
    share = most_unlabelled / max(docs.count(), 1)
    in_sample = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(int(min(1.0, share) * (1 << 30)))
    # At most ``most_positive`` ids are broadcast.
    rows = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("__id"), "left")
    rows = rows.select("text", F.col("__id").isNotNull().alias("positive"), in_sample.alias("sampled")).filter("positive or sampled")
    # Copies of one text are all in the sample or none. Texts come in the order of their hash, as far as the characters reach.
    rows = rows.withColumn("__h", F.xxhash64("text")).withColumn("__n", F.length(F.coalesce("text", F.lit(""))).cast("long"))
    sizes = rows.select("__h", "__n", "positive").orderBy("__h", "__n", "positive").limit(2 * (most_positive + most_unlabelled)).collect()
    total, bound = 0, None
    for r in sizes:
        total += r["__n"]
        if total > MOST_CHARS:
            break
        bound = r["__h"]
    got = rows.filter(F.col("__h") <= F.lit(bound)).select("text", "positive", "sampled").limit(2 * (most_positive + most_unlabelled)).toPandas()
    got["text"] = got["text"].fillna("")
    positive, unlabelled = (got.loc[got[c], "text"].sort_values().tolist() for c in ("positive", "sampled"))
    del got
    return fit(positive, unlabelled, toxic / n) if positive and unlabelled else None


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability-like score of each whole text."""
    if model is None:
        return docs.withColumn(out, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers, whatever the input

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = shared.value.scorer()
        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype="float64")

    return docs.withColumn(out, of(F.col(text)))


def op1_toxicity_pu(spark, sf_dir):
    """Every document's toxicity, learnt from the labels of four rows in five."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
