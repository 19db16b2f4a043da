"""From raw documents to packed training sequences, in stages.

Each stage gets the documents that its predecessor kept, as a written table. All but the last return
the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import decontaminate, frames, ngramjoin, packing, pii, toxicity

TOKENIZER = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of documents."""
    labels = frames.table(spark, sf_dir, "labels")
    model = toxicity.fit(toxicity.labelled_texts(docs, labels))
    scored = toxicity.toxicity(docs, model, rows=True)
    return scored.filter("predicted = 0").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near duplicates stays."""
    return ngramjoin.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of a benchmark item go."""
    items = frames.table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items, rows=True).filter("not contaminated").select("row.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows. Null texts stay null."""
    found = pii.personal_data(docs, pii.fit(docs), rows=True)
    changed = {
        "text": F.when(F.col("row.text").isNotNull(), F.col("redacted")),
        "n_chars": F.when(
            F.col("redacted") != F.col("text"), F.length("redacted").cast("long")
        ).otherwise(F.col("row.n_chars"))
        if "n_chars" in docs.columns
        else None,
    }
    return found.select(
        *(
            (changed[name] if name in changed else F.col(f"row.`{name}`")).alias(name)
            for name in docs.columns
        )
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as sequences of at most 2048 tokens, one row per piece."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("packing", pack),
]

#: Models and similarity groups have no SQL form; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = frames.table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = frames.written(docs)
    return docs
