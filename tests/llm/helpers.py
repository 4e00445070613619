"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names clash with ones that the operators use inside
CLASH = ("a", "b", "h", "n", "rep", "kept", "bucket", "family", "sketch", "start", "length", "host", "words", "lines", "_id", "score")

SYLLABLES = ["an", "ter", "in", "the", "on", "re", "ou", "sh", "ble", "ti", "ed", "ha"]


def prose(rng: random.Random, n: int, syllables=SYLLABLES) -> str:
    out = []
    for i in range(n):
        w = "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
        out.append(w.capitalize() if i % 9 == 0 else w + ("." if i % 9 == 8 else ""))
        if i % 23 == 22:
            out[-1] += "\n"
    return " ".join(out).replace("\n ", "\n")


def edit(rng: random.Random, text: str, share: float) -> str:
    words = text.split(" ")
    return " ".join("zz" + str(rng.randrange(10**6)) if rng.random() < share else w for w in words)


def documents(spark, rows, clash: bool = False):
    """Frame of documents from (doc_id, text) or (doc_id, text, source[, lang]) rows."""
    full = []
    for r in rows:
        doc, text, *more = r
        full.append((doc, text, more[1] if len(more) > 1 else "en", more[0] if more else "s0", len(text) if text is not None else None))
    df = spark.createDataFrame(full, DOCS)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])
    return df
