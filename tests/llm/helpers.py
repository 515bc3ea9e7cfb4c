"""Small brute-force models shared by the tests."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def documents(spark, rows, **extra):
    """A documents table of ``(doc_id, text)`` or ``(doc_id, text, source)`` rows, with columns whose names clash with inner ones."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, 7, "x") for r in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, bucket int, row string")


def prose(rng: random.Random, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def write(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")


ODD_TEXTS = [None, "", " \n ", "one", "two words", "Ärger über Öl", "a" * 5000, "the " * 3000]
