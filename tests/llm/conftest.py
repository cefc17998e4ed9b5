import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, h long, size long, spans string, taken long, target double, component_id long, cell int, key string"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents of (doc_id, text) or (doc_id, text, source), with further columns whose names operators use themselves."""

    def make(rows):
        rows = [(i, t, "en", *(rest or ("a",)), len(t or ""), 5, 5, 5, "x", 5, 5.0, 5, 5, "k") for i, t, *rest in rows]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Invented texts with copies, near copies, shared passages, blanks of all kinds, nothing, one long text."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeéfgh") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: "".join(w + rng.choice([" ", "  ", "\n", "\t", " \x0b"]) for w in rng.choices(words, k=n))
    texts = [text(rng.randint(1, 120)) for _ in range(40)]
    passage = " ".join(rng.choices(words, k=60))
    texts += [f"{text(30)} {passage} {text(20)}" for _ in range(12)]
    base = " ".join(rng.choices(words, k=150)).split()
    for _ in range(15):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    texts += [texts[0], texts[0], texts[41], None, "", "   ", "one", "ONE", "one two three", "a b c d", "a b c d", "x " * 500, text(6_000), " ".join([passage, passage])]
    texts += ["y" * 900, "y" * 399, "y" * 400, "ab" * 450]
    rng.shuffle(texts)
    rows = [(3 * i - 50, t) for i, t in enumerate(texts)]
    return [*rows, rows[4], rows[4], (None, texts[5]), (None, None)]
