"""Operator 5: a quality classifier with learned subword embeddings.

Features of a document are its words, the 2- to 4-grams of characters inside them and whether a word repeats the one before, hashed
into 2**16 rows of an embedding table. A document is the mean of its features' embeddings; a softmax over two classes stands on top. Both
are learned by stochastic gradient descent in numpy, on at most MOST labelled rows that are not held out. As the model
is linear above the table, each row's part in the difference of the two classes is a single number, so every whole text
is scored by a mean of numbers looked up.

Null, empty and blank texts have no features; their score is that of the bias alone. Without labels of both classes
all scores are 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled, runtime
from .textscan import Prefix, column_bytes, parts, word_bounds

BITS, DIMENSIONS, GRAMS = 16, 8, (2, 3, 4)
MOST = 3000
THRESHOLD = 0.7
#: The buckets of a word that differs from the one before, and of one that repeats it.
SAME = np.array([40503, 20261])
EPOCHS, RATE, BATCH = 12, 0.4, 32


def features(part: np.ndarray, cuts: np.ndarray, before: int = -1):
    """For each kind of feature (buckets, first byte) of a part; ``before`` is the bucket of the word before it."""
    s, e = word_bounds(part, cuts)
    if not len(s):
        return
    h = Prefix(part)
    word = h.buckets(s, e - s, BITS, 1)
    yield word, s
    document = np.searchsorted(cuts, s, side="right")
    again = np.zeros(len(s), np.int64)
    again[0] = word[0] == before
    again[1:] = (word[1:] == word[:-1]) & (document[1:] == document[:-1])
    yield SAME[again], s
    letters = np.flatnonzero((part & 0xC0) != 0x80)  # where characters begin
    ends = np.append(letters, len(part))
    low, high = np.searchsorted(letters, s), np.searchsorted(letters, e)
    size = high - low
    offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at, left = np.repeat(low, size) + offset, np.repeat(size, size) - offset
    for n in GRAMS:
        k = at[left >= n]
        yield h.buckets(letters[k], ends[k + n] - letters[k], BITS, 10 + n), letters[k]


def scan(column: pa.Array):
    """(buckets, document) for part after part of a column."""
    raw, at = column_bytes(column)
    before = -1
    for first, last, lo, hi in parts(raw, at):
        found = list(features(raw[lo:hi], at[first:last] - lo, before if lo > at[first] else -1))
        before = int(found[0][0][-1]) if found else before
        for f, pos in found:
            yield f, (first + np.searchsorted(at[first : last + 1], pos + lo, side="right") - 1 if last - first > 1 else np.full(len(f), first))


class Model:
    """For each bucket its part in the logit of class 1, and the bias."""

    def __init__(self, parts_of: np.ndarray, bias: float):
        self.parts_of, self.bias = parts_of, bias

    def scores(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        total, count = np.zeros(n), np.zeros(n)
        for f, doc in scan(column):
            total += np.bincount(doc, self.parts_of[f], n)
            count += np.bincount(doc, minlength=n)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + self.bias, -40, 40)))


def train(texts: pa.Array, y: np.ndarray) -> Model | None:
    """Learns from whole texts and their labels; None without both classes."""
    n = len(y)
    if len(set(y.tolist())) < 2:
        return None
    keys, weights = [], []
    for k in range(0, n, 200):
        got = [doc * np.int64(1 << BITS) + f for f, doc in scan(texts.slice(k, 200))]
        if got:
            u, c = np.unique(np.concatenate(got), return_counts=True)
            keys.append(u + np.int64(k << BITS))
            weights.append(c)
    if not keys:
        return None
    key, count = np.concatenate(keys), np.concatenate(weights).astype(np.float32)
    doc, bucket = (key >> BITS).astype(np.int32), (key & ((1 << BITS) - 1)).astype(np.int32)
    del key, keys, weights
    count /= np.bincount(doc, count, n)[doc].astype(np.float32)
    begin = np.searchsorted(doc, np.arange(n + 1))
    rng = np.random.Generator(np.random.PCG64(11))
    table = rng.uniform(-0.5, 0.5, (1 << BITS, DIMENSIONS)).astype(np.float32)
    top, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    steps = EPOCHS * max(1, n // BATCH)
    done = 0
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(n), max(1, n // BATCH)):
            rate = RATE * (1 - done / steps)
            done += 1
            at = np.concatenate([np.arange(begin[d], begin[d + 1]) for d in batch])
            who = np.repeat(np.arange(len(batch)), [begin[d + 1] - begin[d] for d in batch])
            f, c = bucket[at], count[at]
            rows = table[f]
            mean = np.stack([np.bincount(who, c * rows[:, j], len(batch)) for j in range(DIMENSIONS)], 1)
            z = mean @ top + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = p.copy()
            g[np.arange(len(batch)), y[batch]] -= 1
            back = g @ top.T
            top -= rate * mean.T @ g / len(batch) * 4
            bias -= rate * g.mean(0)
            pull = np.clip(rate * 40 * c[:, None] * back[who], -1, 1)
            for j in range(DIMENSIONS):
                table[:, j] -= np.bincount(f, pull[:, j], 1 << BITS).astype(np.float32)
    return Model((table @ (top[:, 1] - top[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST) -> Model | None:
    return train(*labelled.sample(documents, labels, label, most, by_class=False))


def score(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row."""
    spark = df.sparkSession
    runtime.tune(spark)
    held = spark.sparkContext.broadcast(None if model is None else (model.parts_of, model.bias))
    rows = df.select(F.col(text).alias("__text"), key)

    def run(batches):
        m = None if held.value is None else Model(*held.value)
        for b in batches:
            s = np.full(b.num_rows, 0.5) if m is None else m.scores(b.column(0))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(s)], [key, "score"])

    return rows.mapInArrow(runtime.lean(run), f"`{key}` {rows.schema[key].dataType.simpleString()}, score double")


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(documents, labels)
    return score(documents, model).select("doc_id", (labelled.fold() == labelled.HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
