"""Small tables for the corpus operators' tests."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n, words="abcdefgh"):
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(2, 7))) for _ in range(n))


def edge_texts(rng):
    """Null, empty, blank, one word, line ends only, a repeat, odd characters, a long text."""
    long = "\n".join(prose(rng, 40) for _ in range(300))
    return [None, "", " \t\n ", "word", "\n\n\n", "same text here", "same text here", "é\x0b\U0001f600 ß\x1c x,. <|endoftext|>", long, long]
