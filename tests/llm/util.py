"""Inputs and brute-force versions shared by the tests of the training-text operators."""

import re

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)


def documents(spark, *rows):
    """Documents from texts, or from tuples of id, text, language and source."""
    full = []
    for i, row in enumerate(rows):
        if not isinstance(row, tuple):
            row = (i, row)
        row = (*row, "en", "web")[:4] if len(row) < 4 else row
        full.append((*row, len(row[1] or "")))
    return spark.createDataFrame(full, DOCUMENTS)


def words(text, lower=False):
    raw = (text or "").encode()
    return (re.sub(rb"[A-Z]", lambda m: m[0].lower(), raw) if lower else raw).split()


def prose(rnd, n, vocabulary=400):
    """``n`` random words, most of them common."""
    return " ".join(f"w{int(vocabulary * rnd.random() ** 3)}" for _ in range(n))
