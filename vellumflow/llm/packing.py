"""Operator 4: batches by optimal length buckets.

A document's length is its number of words. From the histogram of all lengths, dynamic programming chooses at most
BUCKETS bucket boundaries so that the padding of all documents to their bucket's length is the least possible (of equal
choices, the one with the earliest boundaries). Within a bucket of length L, batches hold max(1, BUDGET // L) documents,
so a batch has at most BUDGET padded words unless a single document is longer.

The driver holds one count for each distinct length. Texts are read once, for their lengths. Documents are numbered in one order
at every size, by (bucket, doc_id, length): ranges of that order go to partitions, and a document's number is its place in its
range and the counts of the ranges before. Rows that are alike in all three are told apart by their place in the input, so
even these are dealt to several ranges.

Null texts count as empty (length 0), null ids as larger than all. Rows of equal doc_id are packed each for itself.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import runtime

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS, BUDGET = 8, 16384


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The largest length of each bucket: least total padding, by dynamic programming over sorted distinct lengths.

    Best split points move right with the end of the range, so each of the ``buckets`` layers is filled by divide and
    conquer, in n log n steps over n lengths. All sums are exact integers.
    """
    n = len(lengths)
    if n == 0:
        return []
    count = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    mass = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.int64)
    cost = count[1:] * lengths - mass[1:]  # the first j + 1 lengths in one bucket
    choice = [np.zeros(n, np.int64)]
    for _ in range(1, min(buckets, n)):
        best, split = cost.copy(), np.zeros(n, np.int64)
        todo = [(1, n - 1, 1, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j) + 1)
            value = cost[i - 1] + (count[j + 1] - count[i]) * lengths[j] - (mass[j + 1] - mass[i])
            k = int(value.argmin())
            if value[k] < best[j]:
                best[j], split[j] = value[k], i[k]
            at = int(i[k])
            todo += [(lo, j - 1, a, at), (j + 1, hi, at, b)]
        cost = best
        choice.append(split)
    ends, j = [], n - 1
    for split in reversed(choice):
        if split[j]:  # else a layer more brings nothing
            ends.append(int(lengths[j]))
            j = int(split[j]) - 1
    return sorted([*ends, int(lengths[j])])


def _packed(sized: DataFrame, key: str, buckets: int, budget: int) -> DataFrame:
    """``sized`` (with n_words) with bucket, bucket_length, batch and slot."""
    rows = sized.groupBy("n_words").agg(F.count("*").alias("n")).collect()
    rows.sort(key=lambda r: r["n_words"])
    ends = boundaries(np.array([r["n_words"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64), buckets) or [0]
    bucket = F.lit(len(ends) - 1)
    for k in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("n_words") <= ends[k], F.lit(k)).otherwise(bucket)
    first, k = [0], 0
    for end in ends[:-1]:
        while k < len(rows) and rows[k]["n_words"] <= end:
            k += 1
        first.append(sum(r["n"] for r in rows[:k]))
    order = ("bucket", F.col(key).asc_nulls_last(), "n_words", "__tie")
    ranged = sized.withColumn("bucket", bucket).repartitionByRange(runtime.partitions(sized.sparkSession), *order).sortWithinPartitions(*order)
    ranged = runtime.save(ranged.withColumn("__at", F.monotonically_increasing_id()), "ranged")
    place = ranged.withColumn("__range", F.shiftright("__at", 33)).withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    before = place.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", (F.sum("__n").over(Window.orderBy("__range")) - F.col("__n")).alias("__before"))
    of = lambda values: F.get(F.array(*(F.lit(v).cast("long") for v in values)), F.col("bucket"))
    out = place.join(F.broadcast(before), "__range").withColumn("bucket_length", of(ends))  # one row for each range
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_length"), F.lit(1))))
    at = F.col("__at") + F.col("__before") - of(first)
    out = out.withColumn("batch", F.floor(at / room).cast("long")).withColumn("slot", (at % room).cast("long"))
    return out.drop("__range", "__at", "__before", "__tie")


MADE = ("n_words", "bucket", "bucket_length", "batch", "slot")


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``df`` with n_words, bucket (from 0), bucket_length, batch (within the bucket, from 0) and slot (within the batch).
    A column of ``df`` that has one of these names is replaced."""
    n_words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sized = runtime.save(df.drop(*MADE).withColumn("n_words", n_words).withColumn("__tie", F.monotonically_increasing_id()), "sized")
    return _packed(sized, key, buckets, budget)


def report(df: DataFrame) -> DataFrame:
    """doc_id, n_words, bucket, bucket_length, batch, slot of every document."""
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = runtime.save(df.select("doc_id", n_words.alias("n_words"), F.monotonically_increasing_id().alias("__tie")), "sized")
    return _packed(sized, "doc_id", BUCKETS, BUDGET).select("doc_id", *MADE)
