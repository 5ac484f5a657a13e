"""Small tables with nulls, empty and long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, Key string"


def documents(spark, texts, sources=None, ids=None):
    rows = []
    for i, text in enumerate(texts):
        source = sources[i] if sources else f"s{i % 3}"
        rows.append((ids[i] if ids else i, text, "en", source, len(text or ""), "extra"))
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    return " ".join(rng.choice(vocabulary) for _ in range(words))


EDGE_TEXTS = [None, "", "   ", "one", "one two", prose(1, 30), prose(1, 30), prose(2, 5000), "a\tb\x0bc\x0cd\r\ne", "é ü ß 漢字 🙂"]
