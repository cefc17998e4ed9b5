"""Byte-pair encoding and decoding with a published vocabulary, by a contiguous rank array for each word.

A word's parts lie in one array, with the merge rank of each adjacent pair in another. The least rank is found
by a scan, the boundary behind it is deleted, and the two neighbouring ranks are refreshed, until no pair has a
rank. Scans are cheap for short words; words beyond ``LONG`` parts keep the same order of merges in a heap.

Defined results: a null text is an empty one and has no tokens; special tokens' strings in a text are those
tokens; repeated rows are encoded each; other columns pass through where asked for; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from arrayloom.llm.common import Kept, table

LONG = 256
#: Words of a generation of those whose tokens a task keeps.
KEPT_WORDS = 90_000
#: Characters of texts whose ids a task holds at once, about.
PART_CHARS = 1_000_000


def _characters(ranges: str) -> str:
    return "".join(chr(c) for a, _, b in (r.partition("-") for r in ranges.split()) for c in range(int(a, 16), int(b or a, 16) + 1))


# The tokenizers library (0.23) has Unicode 9 in its NFC, 17 in its lower case and 16 in its pattern's classes,
# and takes whatever is later as a plain symbol. Where unicodedata and regex know other versions, these tell.
#: Later characters that are reordered or composed in newer versions.
UNORDERED = _characters(
    "5c8-5c9 7fd 897-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1af0 1df6-1dfa a82c 105c0-105f3 10d24-10d27 10d69-10d6d 10eab-10eac 10ecb-10ecf 10ef0-10efb"
    " 10efd-10eff 10f46-10f50 10f82-10f85 11070 1133b 11380-113e2 1145e 11839-1183a 11930-11943 119e0 11a34 11a47 11a99 11d42-11d45 11d97 11f41-11f42"
    " 16100-16139 16d40-16d79 16ff0-16ff1 1d127-1d128 1d250-1d252 1d25b-1d25c 1d25f 1d280-1d281 1e08f 1e130-1e136 1e2ae 1e2ec-1e2ef 1e4ec-1e4ef 1e5ee-1e5ef"
    " 1e6e3 1e6e6 1e6ee-1e6ef 1e6f5"
)
#: Later letters and numbers.
UNCLASSED = _characters(
    "558 58b-58c 88f c5c cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d 107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f"
    " 12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda 18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6"
    " 1df1f-1df24 1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed 1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead"
    " 323b0-33479 3d000-3fc3f"
)
#: Capitals of Unicode 16 and 17 and their small letters.
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
#: All of them; a set finds them in a fourteenth of a pattern's time.
LATER = frozenset(UNORDERED + UNCLASSED).union(map(chr, LOWER))
SYMBOLS = dict.fromkeys(map(ord, UNCLASSED), "¤")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where printable, else from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    return letters | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}


class WordBpe:
    """Encoder and decoder of a tokenizer file: BPE with word ends, NFC, blanks to one space, lower case."""

    def __init__(self, spec: bytes | str):
        spec = json.loads(spec)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        #: (left id, right id) -> (rank, id of both)
        self.pairs = {(self.vocab[a], self.vocab[b]): (r, self.vocab[a + b]) for r, (a, b) in enumerate(model["merges"])}
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        (pattern,) = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.word = regex.compile(pattern, regex.V0)
        self.blank = regex.compile(r"\s+")
        self.unordered = regex.compile(f"([{UNORDERED}])")
        self.letters = byte_letters()
        self.kept = Kept(self._texts, KEPT_WORDS)

    def merge(self, ids: list[int]) -> list[int]:
        """The ids left when all merges of a word are done, least rank first, leftmost among equals."""
        if len(ids) > LONG:
            return self._merge_long(ids)
        pairs, none = self.pairs, (1 << 60, -1)
        parts = list(ids)
        ranks = [pairs.get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least is none or least[0] == none[0]:
                break
            i = ranks.index(least)
            parts[i] = least[1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = pairs.get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = pairs.get((parts[i - 1], parts[i]), none)
        return parts

    def _merge_long(self, ids: list[int]) -> list[int]:
        pairs, n = self.pairs, len(ids)
        parts, before, after = list(ids), list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(*pairs[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        heap = [(rank, i, a, b, to) for rank, to, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue  # one of the two has merged meanwhile
            parts[i], parts[j] = to, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (found := pairs.get((parts[left], parts[right]))):
                    heapq.heappush(heap, (found[0], left, parts[left], parts[right], found[1]))
        return [p for p in parts if p is not None]

    def word_ids(self, word: str) -> list[int]:
        letters = [self.letters[b] for b in word.encode()]
        letters[-1] += self.end
        return self.merge([self.vocab[x] for x in letters])

    def _texts(self, word: str) -> tuple[str, str]:
        ids = self.word_ids(word)
        return " ".join(map(str, ids)), " ".join(map(self.names.__getitem__, ids))

    def words(self, text: str) -> list[str]:
        if not text.isascii() and not LATER.isdisjoint(text):
            return self._later_words(text)
        text = self.blank.sub(" ", unicodedata.normalize("NFC", text))
        # Each character is lowered by itself: no final form of sigma.
        return self.word.findall(text.replace("Σ", "σ").lower())

    def _later_words(self, text: str) -> list[str]:
        """The words of a text with characters that the library takes otherwise than unicodedata and regex do."""
        # Nothing is reordered or composed across a plain symbol.
        text = "".join([p if i % 2 else unicodedata.normalize("NFC", p) for i, p in enumerate(self.unordered.split(text))])
        text = self.blank.sub(" ", text).replace("Σ", "σ").lower().translate(LOWER)
        return [text[m.start() : m.end()] for m in self.word.finditer(text.translate(SYMBOLS))]

    def code(self, text: str | None) -> tuple[str, str]:
        """The ids of a text in decimal, and the text that they decode to, both joined by one space."""
        text, kept = text or "", self.kept
        if self.split is None or "<|" not in text:
            found = [kept[w] for w in self.words(text)]
        else:
            found = []
            for piece in self.split.split(text):
                found += [(str(self.special[piece]), piece)] if piece in self.special else [kept[w] for w in self.words(piece)]
        return " ".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def encode(self, text: str | None) -> list[int]:
        return [int(x) for x in self.code(text)[0].split()]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(self.names[i] for i in ids)


#: What ``code`` can return of a document: its type, and how it is had from the ids' and tokens' strings.
OUTPUTS = {
    "n_tokens": ("long", lambda ids, decoded: ids.count(" ") + 1 if ids else 0),
    "ids": ("array<int>", lambda ids, decoded: np.array(ids.split(), np.int32)),  # flat: a batch's ids would be large as objects
    "decoded": ("string", lambda ids, decoded: decoded),
    "ids_sha256": ("string", lambda ids, decoded: hashlib.sha256(ids.encode()).hexdigest()),
    "decoded_sha256": ("string", lambda ids, decoded: hashlib.sha256(decoded.encode()).hexdigest()),
}


def parts(batch: pd.DataFrame, text: str, most: int = PART_CHARS) -> Iterator[pd.DataFrame]:
    """Runs of the rows of about so many characters, as ids take more room than texts while they are objects."""
    start = total = 0
    for i, t in enumerate(batch[text]):
        total += len(t or "")
        if total >= most:
            yield batch.iloc[start : i + 1]
            start, total = i + 1, 0
    if start < len(batch) or not len(batch):
        yield batch.iloc[start:]


def code(docs: DataFrame, outputs: Iterable[str] = ("n_tokens", "ids", "decoded"), vocabulary: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` without its text column and with the asked for OUTPUTS of each text, in one pass without a shuffle."""
    with open(vocabulary or default_vocabulary(), "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # of the vocabulary's size, whatever the input
    outputs = list(outputs)
    docs = docs.select(*[c for c in docs.columns if c not in outputs])
    rest = [f for f in docs.schema.fields if f.name != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rest], *[f"{o} {OUTPUTS[o][0]}" for o in outputs]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = WordBpe(spec.value)
        for batch in batches:
            for part in parts(batch, text):
                out = part.drop(columns=[text])
                coded = [tuple(OUTPUTS[o][1](*pair) for o in outputs) for pair in map(bpe.code, part[text])]
                for i, o in enumerate(outputs):
                    out[o] = pd.Series([c[i] for c in coded], dtype=object if OUTPUTS[o][0] != "long" else "int64", index=out.index)
                yield out

    return docs.mapInPandas(run, schema)


def op3_bpe_codec(spark, sf_dir):
    """Every document's token count and the digests of its ids and of what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return code(docs, ("n_tokens", "ids_sha256", "decoded_sha256"))
