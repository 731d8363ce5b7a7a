"""The training rows of the two classifiers: a bounded sample of labelled rows, with a part held out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS, HELD_OUT = 4, 2
#: Longer texts (bytes) are not learned from, so that the sample is bounded in bytes, too; they are scored as all others.
LONGEST = 1 << 17


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 4; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % FOLDS


def sample(documents: DataFrame, labels: DataFrame, label: str, most: int, by_class: bool) -> tuple[pa.Array, np.ndarray]:
    """(texts, labels) of at most ``most`` rows (with ``by_class``, of each class) that are not held out, in an order
    that depends on doc_id alone. Only these rows reach the driver, and of them those of at most LONGEST bytes; an id that
    repeats among the documents gives one row, its least text."""
    rows = labels.where((fold() != HELD_OUT) & F.col(label).isin(0, 1)).select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("y")).distinct()
    order = [F.xxhash64("__id"), "__id"]
    parts = [rows.where(F.col("y") == k) for k in (0, 1)] if by_class else [rows]
    few = [p.orderBy(*order).limit(most) for p in parts]
    chosen = few[0].unionByName(few[1]) if by_class else few[0]
    got = documents.where(F.octet_length(F.coalesce("text", F.lit(""))) <= LONGEST).select(F.col("doc_id").alias("__id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "__id")
    got = got.groupBy("__id", "y").agg(F.min("text").alias("text")).toArrow()
    got = got.take(pa.compute.sort_indices(got, [("__id", "ascending"), ("y", "ascending")])) if got.num_rows else got
    return got["text"].combine_chunks(), got["y"].to_numpy()
