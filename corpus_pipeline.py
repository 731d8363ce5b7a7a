"""From documents to packed batches: toxicity, near duplicates, repeated passages, secrets, packing.

Each stage works on all rows that the one before kept; all but the last return the columns of documents.

In every stage null texts count as empty and stay null unless they go; rows of equal or null doc_id are documents each for
itself; an empty table gives an empty table. Empty texts are never toxic, are copies of nothing, hold no passage and no
secret and are packed with length 0. Columns beside those of documents are carried along by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.llm import neardup, packing, runtime, secrets, substring, toxicity


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.clean(docs, toxicity.fit(docs, runtime.labels(spark, sf_dir)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates one row stays: one with the least doc_id (null: larger than all), of several the
    one with the least fingerprint of its set, then with the least text. Rows without words all stay, but equal rows once."""
    return neardup.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words covered by a window that a smaller doc_id also has are taken out; rows of one doc_id take nothing from each other."""
    return substring.remove(docs).withColumn("n_chars", F.length("text").cast("long"))


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document left."""
    return packing.report(docs)


STAGES = [
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets_redacted),
    ("packing", packed),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage returned is a table in the shared folder until the next one is written."""
    docs, last = runtime.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = runtime.save(stage(spark, docs, sf_dir), name)
        if last is not None:
            runtime.discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
