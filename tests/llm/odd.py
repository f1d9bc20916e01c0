"""Small tables with every awkward row: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random

PROSE = "the fox ran over a hill and saw the river below it turn east before the old town"


def prose(seed: int, words: int = 120) -> str:
    draw = random.Random(seed)
    pool = [f"w{draw.randrange(400)}" for _ in range(60)] + PROSE.split()
    return " ".join(draw.choices(pool, k=words))


LONG = prose(99, 60_000)
ROWS = [
    (1, PROSE),
    (2, PROSE),
    (3, PROSE.replace(" ", "\t\n ")),
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (None, "a row without a key"),
    (None, None),
    (7, prose(7)),
    (8, prose(7).replace("w1", "w2", 1)),
    (9, LONG),
    (10, LONG + " end"),
    (11, "repeated row"),
    (11, "repeated row"),
    (12, "Ünï 日本 😀 'quoted' <|endoftext|>  two  spaces \n\n x"),
    (13, "a b"),
]
CLASHES = ["digest", "points", "keep_id", "kept", "text_key", "found", "score", "row", "c0"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]


def odd_documents(spark, rows=ROWS):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{name} string" for name in CLASHES
    )
    full = [(i, t, "en", None, len(t or ""), *[f"{n}!" for n in CLASHES]) for i, t in rows]
    return spark.createDataFrame(full, schema)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def no_documents(spark):
    return odd_documents(spark, [])
