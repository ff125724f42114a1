"""Small documents with the cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

CLASHING = ("row", "digest", "size", "part", "group", "root", "copies", "score", "slot", "key")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["an", "the", "or", "ing", "tion", "é", "ß", "qu", "Er", "st"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 5))) for _ in range(words))


def documents(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else f"src{(r[0] or 0) % 4}", len(r[1] or ""))
            for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def clashing(docs):
    """The same documents with columns named like the operators' own."""
    return docs.withColumns({name: F.lit(7) for name in CLASHING})


ODD = [
    (1, "the  same\ttext"), (2, "the same text"), (3, " the same text"), (4, None), (5, ""),
    (6, " \n\t"), (7, "one"), (7, "one"), (None, "the same text"), (None, None), (None, "alone"),
    (8, prose(8, 4000)), (9, "x" * 20000), (10, "a <|endoftext|> b\n\n  c"), (-3, "one"),
]
