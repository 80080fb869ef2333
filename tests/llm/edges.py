"""A small table with the awkward rows that every operator has to take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, cluster_name string"


def words(seed, n, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def document_rows():
    plain = " ".join(words(1, 120))
    near = plain.replace(" ", "  ", 3).upper() + " tail"
    rows = [
        (1, plain, "en", "a"), (2, near, "en", "a"), (3, plain, "de", None), (4, None, "en", "a"), (5, "", "fr", "b"), (6, " \n\t ", None, "b"),
        (7, "one two", "en", "b"), (8, "ONE two", "en", "b"), (9, " ".join(words(2, 30_000)), "es", "c"), (10, "x" * 50_000, "en", "c"),
        (11, " ".join(words(3, 200)), "en", "a"), (11, " ".join(words(3, 200)), "en", "a"), (None, plain, "en", "a"), (None, None, None, None),
        (12, "mail a.b@c.example and +1 (523) 555-1055, 10.0.0.255 é 4111 1111 1111 1111", "en", "b"), (13, "é ü " * 40, "fr", "a"),
    ]
    return [(i, t, lang, s, len(t or ""), 0.5, "k", "c") for i, t, lang, s in rows]


def documents(spark, rows=None):
    rows = document_rows() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int") if rows else spark.createDataFrame(
        [], "doc_id long, quality int, toxic int")


def by_id(df, key="doc_id"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append(r.asDict())
    return out


def many(spark, texts, source=None):
    """Documents numbered from 0 with the given texts."""
    return documents(spark, [(i, t, "en", (source or (lambda i: f"s{i % 5}"))(i), len(t or ""), 0.0, "", "") for i, t in enumerate(texts)])


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


__all__ = ["F", "by_id", "document_rows", "documents", "labels", "many", "same", "words"]
