"""Operator 2: toxicity by multiple-instance learning.

A document is a bag of sentences (ends: . ! ? at the end of a word, or a line end). A sentence's score is a logistic
function of the summed weights of hashed features of its words (the word without outer punctuation, in lower case, and
its prefixes); weights are not negative, so harmless words never outweigh an offence. The document's score is the noisy-or of its sentences' scores. Weights are learned from labels of whole
documents by AdaGrad in numpy, on at most MOST labelled rows of each class that are not held out; then the sentence
scores tell where the offence lies. Every whole text is scored.

Null, empty and blank texts have no sentence and the score 0. Without labels of both classes all scores are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled, runtime
from .textscan import Prefix, column_bytes, lowered, parts, word_bounds

BITS = 18
PREFIXES = (5, 6, 7, 8)
MOST, SLICE = 2000, 200
THRESHOLD = 0.3
SENTENCE_THRESHOLD = 0.3
EPOCHS, RATE, BATCH, LEAST_DOCS = 20, 1.0, 64, 3
START = -7.0
#: How much a clean document counts against a toxic one (classes are drawn evenly), and the pull of each weight to 0.
CLEAN_WEIGHT, SHRINK = 2.0, 0.0
_OUTER = np.zeros(256, bool)
_OUTER[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True


def sentences(part: np.ndarray, cuts: np.ndarray):
    """(features [word, kind] (-1: none), sentence of each word, first and last byte of each sentence) of a part."""
    s, e = word_bounds(part, cuts)
    if not len(s):
        none = np.zeros(0, np.int64)
        return np.zeros((0, 1 + len(PREFIXES)), np.int64), none, none, none
    low = lowered(part)
    ends = _STOP[part[e - 1]]
    lines = np.concatenate([[0], np.cumsum(part == 10)])
    follow = np.empty(len(s), bool)
    follow[0] = True
    follow[1:] = ends[:-1] | (lines[s[1:]] > lines[e[:-1]])
    follow |= np.isin(s, cuts) | (np.searchsorted(cuts, s, side="right") != np.searchsorted(cuts, np.concatenate([[-1], s[:-1]]), side="right"))
    sentence = np.cumsum(follow) - 1
    a, b = s.copy(), e.copy()
    for _ in range(4):
        a += (a < b) & _OUTER[low[np.minimum(a, len(low) - 1)]]
        b -= (a < b) & _OUTER[low[b - 1]]
    h = Prefix(low)
    size = b - a
    kinds = [np.where(size > 0, h.buckets(a, size, BITS, 1), -1)]
    for k in PREFIXES:
        full = size >= k
        kinds.append(np.where(full, h.buckets(a, np.where(full, k, 0), BITS, 100 + k), -1))
    last = np.flatnonzero(np.concatenate([follow[1:], [True]]))
    return np.stack(kinds, 1), sentence, s[follow], e[last]


def scan(column: pa.Array):
    """(features, sentence, sentence starts, ends, document of each sentence) for part after part of a column."""
    raw, at = column_bytes(column)
    for first, last, lo, hi in parts(raw, at):
        f, sentence, a, b = sentences(raw[lo:hi], at[first:last] - lo)
        if len(a):
            yield f, sentence, a + lo, b + lo, first + np.searchsorted(at[first : last + 1], a + lo, side="right") - 1


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    """Weights of features and the intercept."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.padded = np.append(weights, np.float32(0))

    def sentence_scores(self, features: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """0 without any evidence, so that the length of a document alone never makes it toxic."""
        value = self.padded[features].sum(1, dtype=np.float64)
        none = _sigmoid(np.array(self.bias))
        return np.maximum(0, (_sigmoid(self.bias + np.bincount(sentence, value, n)) - none) / (1 - none))


def train(texts: pa.Array, y: np.ndarray) -> Model | None:
    """Learns from whole texts and their labels; None without both classes."""
    if len(set(y.tolist())) < 2:
        return None
    flats, owners, sents, sizes = [], [], [], np.zeros(len(y), np.int64)
    met = np.zeros(1 << BITS, np.int64)
    for k in range(0, len(y), SLICE):
        for f, sentence, _, _, doc in scan(texts.slice(k, SLICE)):
            local = np.arange(len(doc)) - np.searchsorted(doc, doc) + sizes[k + doc]
            np.add.at(sizes, k + doc, 1)
            on = f.ravel() >= 0
            flat = f.ravel()[on].astype(np.int32)
            owner = np.repeat((k + doc[sentence]).astype(np.int32), f.shape[1])[on]
            met += np.bincount(np.unique(owner.astype(np.int64) << BITS | flat) & ((1 << BITS) - 1), minlength=1 << BITS)
            flats.append(flat)
            owners.append(owner)
            sents.append(np.repeat(local[sentence].astype(np.int32), f.shape[1])[on])
    if not flats:
        return None
    keep = [met[x] >= LEAST_DOCS for x in flats]
    flat, owner, sent = (np.concatenate([x[m] for x, m in zip(xs, keep)]) for xs in (flats, owners, sents))
    del flats, owners, sents, keep
    begin = np.searchsorted(owner, np.arange(len(y) + 1))
    w, g2, bias, b2 = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6), START, 1e-6
    rng = np.random.Generator(np.random.PCG64(7))
    for epoch in range(EPOCHS):
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // BATCH)):
            fi = np.concatenate([flat[begin[d] : begin[d + 1]] for d in batch])
            count = sizes[batch]
            start = np.cumsum([0, *count])
            if not start[-1]:
                continue
            si = np.concatenate([sent[begin[d] : begin[d + 1]] + k for d, k in zip(batch, start)])
            p = _sigmoid(bias + np.bincount(si, w[fi], start[-1]))
            who = np.repeat(np.arange(len(batch)), count)
            none = np.exp(np.bincount(who, np.log1p(-np.minimum(p, 1 - 1e-9)), len(batch)))
            pull = np.where(y[batch] == 1, -none / np.maximum(1 - none, 1e-9), CLEAN_WEIGHT)
            gz = p * pull[who]
            grad = np.bincount(fi, gz[si], 1 << BITS) / len(batch)
            on = np.flatnonzero(grad)
            step = grad[on] + SHRINK / len(batch)
            g2[on] += step**2
            w[on] = np.maximum(w[on] - RATE * step / np.sqrt(g2[on]), 0)  # evidence only adds
            gb = gz.sum() / len(batch)
            b2 += gb**2
            bias -= 0.1 * gb / np.sqrt(b2)
    return Model(w.astype(np.float32), float(bias))


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST) -> Model | None:
    return train(*labelled.sample(documents, labels, label, most, by_class=True))


def score(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, score, offending) of every row; offending: start:end of the sentences that score 0.3 or more, in
    code points, comma-joined."""
    spark = df.sparkSession
    runtime.tune(spark)
    held = spark.sparkContext.broadcast(None if model is None else (model.weights, model.bias))
    rows = df.select(F.col(text).alias("__text"), key, *keep)

    def run(batches):
        m = None if held.value is None else Model(*held.value)
        for b in batches:
            n = b.num_rows
            none, found = np.zeros(n), [[] for _ in range(n)]
            if m is not None:
                raw, at = column_bytes(b.column(0))
                points = None
                for f, sentence, first, last, doc in scan(b.column(0)):
                    p = m.sentence_scores(f, sentence, len(first))
                    none += np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), n)
                    hits = np.flatnonzero(p >= SENTENCE_THRESHOLD)
                    if len(hits) and points is None:  # characters that begin before each byte
                        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                    for k in hits.tolist():
                        begin = points[at[doc[k]]]
                        found[doc[k]].append(f"{points[first[k]] - begin}:{points[last[k]] - begin}")
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(-np.expm1(none)), pa.array([",".join(x) for x in found])], [*b.schema.names[1:], "score", "offending"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(runtime.lean(run), f"{kinds}, score double, offending string")


def clean(df: DataFrame, model: Model | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, with all their columns, whose score is below ``threshold``."""
    runtime.tune(df.sparkSession)
    held = df.sparkSession.sparkContext.broadcast(None if model is None else (model.weights, model.bias))
    place = df.columns.index(text)

    def run(batches):
        m = None if held.value is None else Model(*held.value)
        for b in batches:
            if m is None:
                yield b
                continue
            none = np.zeros(b.num_rows)
            for f, sentence, first, _, doc in scan(b.column(place)):
                none += np.bincount(doc, np.log1p(-np.minimum(m.sentence_scores(f, sentence, len(first)), 1 - 1e-9)), b.num_rows)
            yield b.filter(pa.array(-np.expm1(none) < threshold))

    return df.mapInArrow(runtime.lean(run), df.schema)


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(documents, labels)
    return score(documents, model).select("doc_id", (labelled.fold() == labelled.HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
