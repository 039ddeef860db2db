"""Small corpora for the tests of this folder."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CONVERSATIONS = "conv_id long, turn long, role string, text string"
EMBEDDINGS = "vec_id long, embedding array<float>, label int"
LABELS = "doc_id long, quality int, toxic int"


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def words(rng: random.Random, count: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def edited(rng: random.Random, text: str, changes: int) -> str:
    parts = text.split()
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


def awkward():
    """Nulls in every column, empty and blank texts, a very long one, ties and repeated rows."""
    long = "lorem ipsum dolor " * 20_000
    return [
        (1, "alpha beta gamma delta", "en", "s1", 22), (1, "alpha beta gamma delta", "en", "s1", 22),
        (1, "another text under the same id", "en", None, None), (2, None, None, None, None), (3, "", "en", "s1", 0),
        (4, " \t\n ", "en", "s2", 4), (5, long, "en", "s2", len(long)), (None, "no id here", "de", "s1", 10),
        (None, None, None, None, None), (6, "ALPHA beta gamma delta", "en", "s2", 22), (-7, "é 🙂 ß token = abcdef123456", "fr", "é", 25),
    ]


def write_tables(spark, folder, rows, clashing=False):
    """A folder of tables around these documents; `clashing` adds columns named like the operators' own."""
    frame = spark.createDataFrame(rows, DOCUMENTS)
    vectors = [(i, [float((i * 7 + d) % 5) / 8 - 0.25 for d in range(6)], 0) for i in range(120)] if rows else []
    vectors += [(130, None, 0), (131, [1.0, None], 0), (132, [float("nan")], 0), (None, [1.0], 0), (3, [0.5] * 6, None)] if rows else []
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "</s>"), (None, 2, None, "x"), (2, None, "system", "[INST]")]
    tables = {
        "documents": frame,
        "labels": spark.createDataFrame([(r[0], 1, None if r[0] == 5 else int((r[0] or 0) % 2)) for r in rows], LABELS),
        "conversations": spark.createDataFrame(turns if rows else [], CONVERSATIONS),
        "embeddings": spark.createDataFrame(vectors, EMBEDDINGS),
    }
    for name, table in tables.items():
        if clashing:
            for extra in ("row", "key", "size", "rank", "slot", "group", "place", "node", "token", "at", "spans", "hits", "range"):
                from pyspark.sql import functions as F

                table = table.withColumn(extra, F.lit(extra))
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
