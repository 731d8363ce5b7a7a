"""Operator 3: document fingerprints that are homomorphic hashes of the multiset of paragraphs.

A paragraph is a line that holds a word. Its wide vector has 4 lanes modulo 2**64, the digest of its bytes, and 128
lanes modulo 2**32, in which each of its three-word runs (all its words, if fewer) adds 1 or -1 at one lane. A document's
fingerprint is the sum of its paragraphs' vectors, each lane modulo its power of two: the order of paragraphs does
not matter, and paragraphs are inserted or deleted by adding or subtracting vectors. Fingerprints of equal multisets
are equal. The narrow lanes are a linear sketch, so the squared length of a difference estimates how many runs two
documents do not share: likeness is 1 - |a-b|^2 / (|a|^2 + |b|^2), held between 0 and 1; of equal fingerprints, 1.

Null and blank texts have the zero vector. In the order of documents (descending doc_id), rows of equal doc_id follow
in order of the MD5 of their texts and null ids come last. Rows of equal doc_id and text follow one another, so each but the
last of them has its own text as the next; a task folds those that it reads into one row and a number before anything is sent, so
however many there are, a task sends two rows for them (again for each FOLDED different ones).
"""

from __future__ import annotations

import base64
import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime
from .textscan import U64, column_bytes, mix, words

IDENT, LANES, RUN = 4, 128, 3
#: Rows drawn for each partition, whose quantiles cut the order into stretches.
SAMPLE = 64
#: Different repeated rows that a task holds at a time to fold what repeats them.
FOLDED = 256


class Sketch:
    """Fingerprints of n documents: ident uint64[n, 4] and lanes uint32[n, 128], added and subtracted lane by lane."""

    def __init__(self, ident: np.ndarray, lanes: np.ndarray):
        self.ident, self.lanes = ident, lanes

    def __add__(self, other: Sketch) -> Sketch:
        return Sketch(self.ident + other.ident, self.lanes + other.lanes)

    def __sub__(self, other: Sketch) -> Sketch:
        return Sketch(self.ident - other.ident, self.lanes - other.lanes)

    def take(self, rows) -> Sketch:
        return Sketch(self.ident[rows], self.lanes[rows])

    def strings(self) -> list[str]:
        raw = np.concatenate([self.ident.astype("<u8").view(np.uint8), self.lanes.astype("<u4").view(np.uint8)], axis=1)
        return [base64.b64encode(x).decode() for x in raw]

    def likeness(self, other: Sketch) -> np.ndarray:
        long = lambda x: (x.view(np.int32).astype(np.float64) ** 2).sum(1)
        apart, whole = long(self.lanes - other.lanes), long(self.lanes) + long(other.lanes)
        same = (self.ident == other.ident).all(1) & (self.lanes == other.lanes).all(1)
        near = np.clip(1 - apart / np.where(whole > 0, whole, 1), 0, 1)
        return np.where(same, 1.0, np.where(whole > 0, near, 0.0))


def sketch(texts: list[bytes]) -> Sketch:
    """Fingerprints of UTF-8 texts."""
    n = len(texts)
    raw, at = column_bytes(pa.array([t if t.endswith(b"\n") else t + b"\n" for t in texts], pa.binary()))
    lines = np.flatnonzero(raw == 10) + 1
    owner = np.searchsorted(at, lines - 1, side="right") - 1
    hashes, _, _, counts = words(raw, np.concatenate([[0], lines]))
    ident = np.zeros((n, IDENT), U64)
    begin = np.concatenate([[0], lines[:-1]])
    full = np.flatnonzero(counts)
    data = raw.tobytes()
    digests = np.frombuffer(b"".join([hashlib.blake2b(data[a:b], digest_size=8 * IDENT).digest() for a, b in zip(begin[full].tolist(), (lines[full] - 1).tolist())]), "<u8").reshape(-1, IDENT)
    np.add.at(ident, owner[full], digests)

    first = np.cumsum(counts) - counts
    line = np.repeat(np.arange(len(counts)), counts)
    runs = hashes.copy()
    for k in range(1, RUN):
        runs[: len(runs) - k] = runs[: len(runs) - k] * U64(0xC2B2AE3D27D4EB4F) + hashes[k:]
    place = np.arange(len(hashes)) - first[line]
    keep = place <= counts[line] - RUN
    short = np.flatnonzero((counts > 0) & (counts < RUN))
    values, owners = [runs[keep]], [owner[line[keep]]]
    for k in range(1, RUN):
        some = short[counts[short] == k]
        value = hashes[first[some]].copy()
        for j in range(1, k):
            value = value * U64(0xC2B2AE3D27D4EB4F) + hashes[first[some] + j]
        values.append(value + U64(k))
        owners.append(owner[some])
    value, own = mix(np.concatenate(values)), np.concatenate(owners)
    lane = own * LANES + (value >> U64(57)).astype(np.int64)
    total = np.bincount(lane, 1.0 - 2.0 * (value & U64(1)).astype(np.float64), n * LANES)
    return Sketch(ident, total.astype(np.int64).astype(np.uint32).reshape(n, LANES))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many (or all) first code points of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def with_next(df: DataFrame) -> DataFrame:
    """(pid, look, doc_id, text, times) sorted within partitions so that each row (look 0) is followed by the next document. A
    row of look 2 is followed by ``times`` - 1 equal ones and then by one more: it has itself as the next document, that many times.

    The order (descending doc_id, digest of the text) is cut at rows that occur: the very first one, and quantiles of a random
    sample of about SAMPLE rows for each partition. A row that begins a stretch is sent a second time (look 1), to the end of the stretch
    before (the very first: to the last stretch). Stretches are partitions, one each. The driver holds only the sample's
    ids and digests.
    """
    spark = df.sparkSession
    n = runtime.partitions(spark)
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    order = lambda i, d: (i is None, 0 if i is None else ~i, bytes(d))
    ids = rows.select("doc_id", "digest")
    first = [order(*r) for r in ids.orderBy(F.col("doc_id").desc_nulls_last(), "digest").limit(1).collect()]
    part = SAMPLE * n / max(1, rows.count())
    drawn = sorted(order(*r) for r in ids.where(F.rand(7) < part).collect()) if n > 1 else []
    cuts = sorted({*first, *(drawn[k * len(drawn) // n] for k in range(1, n) if drawn)})
    known = np.array([c[1] for c in cuts if not c[0]], np.int64)

    def stretch(found: pa.Array, digests: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(stretch, whether the row is a cut) of each row."""
        null = np.asarray(found.is_null())
        turned = ~found.fill_null(0).to_numpy(zero_copy_only=False)
        pid = np.searchsorted(known, turned, side="right") - 1
        tied = np.flatnonzero(null | (known[np.maximum(pid, 0)] == turned if len(known) else False))
        at_cut = np.zeros(len(null), bool)
        for k in tied.tolist():
            key = (bool(null[k]), 0 if null[k] else int(turned[k]), digests[k].as_py())
            pid[k] = bisect.bisect_right(cuts, key) - 1
            at_cut[k] = cuts[pid[k]] == key
        return pid, at_cut

    def sent(pid: np.ndarray, look: int, own, times: np.ndarray):
        return pa.RecordBatch.from_arrays([pa.array(pid.astype(np.int32)), pa.array(np.full(len(pid), look, np.int32)), *own, pa.array(times.astype(np.int64))], names)

    def fold(b: pa.RecordBatch, seen: dict) -> tuple[pa.RecordBatch, pa.RecordBatch | None]:
        """The rows without those that repeat an earlier one (of the batch or in ``seen``), counted there; and what ``seen`` held if full."""
        keys = list(zip(b.column(0).to_pylist(), b.column(2).to_pylist()))
        if len(set(keys)) == len(keys) and not any(k in seen for k in keys) if seen else len(set(keys)) == len(keys):
            return b, None
        first, keep = {}, []
        for n, k in enumerate(keys):
            if k in seen:
                seen[k][1] += 1
            elif k in first:
                seen[k] = [b.slice(first[k], 1), 1]
            else:
                first[k] = n
                keep.append(n)
        return b.take(pa.array(keep, pa.int64())), (again(seen) if len(seen) > FOLDED else None)

    def again(seen: dict) -> pa.RecordBatch:
        """Rows of look 2 for what was folded, to any stretches."""
        rows = pa.Table.from_batches([x[0] for x in seen.values()]).combine_chunks().to_batches()[0]
        times = np.array([x[1] for x in seen.values()])
        seen.clear()
        return sent(np.arange(len(times)) % len(cuts), 2, (rows.column(0), rows.column(2), rows.column(1)), times)

    def deal(batches):
        seen: dict = {}
        for b in batches:
            b, more = fold(b, seen)
            if more is not None:
                yield more
            pid, at_cut = stretch(b.column(0), b.column(2))
            own = (b.column(0), b.column(2), b.column(1))
            yield sent(pid, 0, own, np.ones(len(pid)))
            where = np.flatnonzero(at_cut)
            where = where[np.unique(pid[where], return_index=True)[1]]  # of equal rows one is enough
            if len(where):
                yield sent(np.where(pid[where] == 0, len(cuts) - 1, pid[where] - 1), 1, [c.take(pa.array(where)) for c in own], np.ones(len(where)))
        if seen:
            yield again(seen)

    names = ["pid", "look", "doc_id", "digest", "text", "times"]
    dealt = rows.mapInArrow(runtime.lean(deal), "pid int, look int, doc_id long, digest binary, text string, times long")
    return dealt.repartitionById(max(1, len(cuts)), "pid").sortWithinPartitions("look", F.col("doc_id").desc_nulls_last(), "digest").drop("digest")


def report(df: DataFrame) -> DataFrame:
    """The fingerprints of every text and of its edited text, and their likeness; the edited text's is made from the
    text's by deleting the paragraphs from the first changed one on and inserting the new ones."""
    runtime.tune(df.sparkSession)

    def finish(held, marks: Sketch):
        """Rows for all of ``held`` but the last, which waits for what follows it."""
        rows = [k for k in range(len(held) - 1) if held[k][1] == 0 and held[k][0] == held[k + 1][0]]
        itself = [k for k in range(len(held) - 1) if held[k][1] == 2]
        if not rows and not itself:
            return None
        after = [k + 1 for k in rows] + itself
        rows += itself
        old, new, sha, n = [], [], [], []
        for k, then in zip(rows, after):
            text, following = held[k][3], held[then][3]
            changed = edited(text, following)
            cut = len(text) - len(text) // 3
            line = text.rfind("\n", 0, cut) + 1
            old.append(text[line:].encode())
            new.append(changed[line:].encode())
            sha.append(hashlib.sha256(changed.encode()).hexdigest())
            n.append(len(text))
        own, following = marks.take(rows), marks.take(after)
        other = own - sketch(old) + sketch(new)
        arrays = [pa.array([held[k][2] for k in rows], pa.int64()), pa.array(n, pa.int64()), pa.array(sha), pa.array(own.strings()), pa.array(other.strings()), pa.array(own.likeness(other)), pa.array(own.likeness(following)), pa.array([held[k][4] for k in rows], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, [*COLUMNS, "times"])

    def run(batches):
        held: list[tuple] = []
        marks = None
        for b in batches:
            fresh = list(zip(*(b.column(k).to_pylist() for k in range(5))))
            for first in range(0, len(fresh), 250):
                part = fresh[first : first + 250]
                made = sketch([x[3].encode() for x in part])
                held = held + part
                marks = made if marks is None else Sketch(np.concatenate([marks.ident, made.ident]), np.concatenate([marks.lanes, made.lanes]))
                if (out := finish(held, marks)) is not None:
                    yield out
                held, marks = held[-1:], marks.take([-1])
        if held and held[-1][1] == 2 and (out := finish([*held, held[-1]], marks)) is not None:
            yield out

    done = with_next(df).mapInArrow(runtime.lean(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, times long")
    return done.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(COLUMNS)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
