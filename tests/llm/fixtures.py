"""Frames of documents with everything that operators must bear."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("row", T.StringType()),
    ]
)


def frame(spark, rows, lang="xx"):
    """Documents of (doc_id, text), with extra columns named as results are."""
    return spark.createDataFrame(
        [(i, t, lang, None, len(t) if t is not None else None, 7, "c", "r") for i, t in rows], SCHEMA
    )


def odd_rows():
    """Nulls, empty and very long texts, repeated rows and ids, ties, other scripts."""
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "One two"),
        (4, "One two"),
        (4, "another text under the same id"),
        (None, "a document without an id"),
        (None, None),
        (5, "x" * 5000),
        (6, "ключ 日本語 İstanbul ǅ é 😀 <|endoftext|> it's WE'LL"),
        (7, " ".join(f"word{k}" for k in range(6000))),
        (8, "1 " * 3000),
    ]


def prose(seed, words, vocabulary=400):
    chance = random.Random(seed)
    return [f"w{chance.randrange(vocabulary)}" for _ in range(words)]
