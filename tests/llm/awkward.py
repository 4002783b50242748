"""Small tables with nulls, empty and very long texts, repeated rows and clashing column names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, digest string, n long, label string"


def documents(seed: int = 5, count: int = 60) -> list[tuple]:
    pick = random.Random(seed)
    words = ["".join(pick.choice("abcdeéß") for _ in range(pick.randint(2, 8))) for _ in range(80)]

    def text(size: int) -> str:
        return " ".join(pick.choice(words) + pick.choice(["", "", ".", ",", "\n"]) for _ in range(size))

    texts = [text(pick.randint(1, 90)) for _ in range(count)]
    texts += [texts[0], texts[1], texts[1].upper(), texts[2] + " more", None, "", "   ", "\n", None, "a" * 30_000, text(6_000)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, None, i, "k", None, 1, "x") for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, texts[4], None, None, None, None, None, None, None, None), (None, None, *[None] * 8)]


def frame(spark, rows: list[tuple], parts: int = 3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
