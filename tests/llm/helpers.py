"""Shared bits of the operator tests."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, words: int, alphabet: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 6))) for _ in range(words))


def docs(spark, texts, lang="en", source="s"):
    """A documents table; None texts stay null, ids count from 0."""
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
