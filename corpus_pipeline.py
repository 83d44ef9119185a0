"""From raw documents to packed training sequences, one operator after the other.

Each stage takes what its predecessor left, as a table in the shared folder, and decides on
every row of it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daysync.llm import exact, minhash, packing, pii, quality
from daysync.llm.common import fresh, scratch, stored, table
from daysync.llm.queries import VOCABULARY

#: Documents of a lower score go.
LEAST_SCORE = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from ``labels`` do not reject; empty ones are scored too."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    (score,) = fresh(docs.columns, "score")
    scored = quality.scored(docs, model, score_column=score)
    return scored.where(F.col(score) >= LEAST_SCORE).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, the one with the largest id; null and empty texts are one text."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8, the smallest id.

    Rows without id stay, as do those without words.
    """
    found = minhash.near_duplicates(docs, words=5, percent=80)
    (name,) = fresh(docs.columns, "gone")
    gone = stored(found.where("id is not null and not kept").select(F.col("id").alias(name)).distinct())
    return docs.join(gone, docs["doc_id"].cast("long") == gone[name], "left_anti")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with placeholders for personal data and ``n_chars`` to match."""
    clean = pii.redacted(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences; a null text is an empty document."""
    return packing.pack(packing.cut(docs, VOCABULARY)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact),
    ("packing", pack),
]

#: Rule learning, the field and byte-level BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        with scratch(spark):  # what a stage keeps for itself goes when its result is written
            docs = stored(stage(spark, docs, sf_dir), lasting=True)
    return docs
