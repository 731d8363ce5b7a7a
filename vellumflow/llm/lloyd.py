"""Operator 11: vectors as codes of their parts, with codebooks learned by Lloyd's rounds over heaps of bounds.

A component x becomes the integer floor(SCALE * x); a vector is cut into PARTS equal consecutive parts. The codebook of a part
position starts as that part of the ENTRIES first vectors by (vec_id, components); each of ROUNDS rounds assigns every part to the
nearest entry (squared Euclidean distance, ties to the lower index) and moves every entry to the componentwise floor of the mean
of its parts. An entry without parts stays. At last all parts are assigned once more.

Vectors live in blocks, rows of a table that a task makes of what it reads, so no vector is ever shuffled. A block keeps a heap for
each part position and entry: of the parts assigned to that entry, keyed by their slack, the lower bound on the distance to any
other entry less the upper bound on that to their own. Moving entries can shrink a slack by no more than the way of the entry
itself and the longest way of another. So a heap holds slacks plus what its entry's ways had come to when the part was scanned,
and only parts whose key does not exceed what they have come to since are popped, scanned against all entries and pushed again.
All others keep their entry without being looked at. Of every round only the sums of parts that changed their entry leave a task,
PARTS * ENTRIES * (1 + part length) numbers; the driver holds as many, whatever the number of vectors.

Rows whose vector is null or holds a null or non-finite component are dropped. If sizes differ, or are no multiple of PARTS, missing
components count as 0 up to the largest size, rounded up (so empty vectors are zeros). Fewer vectors than ENTRIES make as many entries.
Null vec_ids come last in the order; repeated rows are vectors each for itself. An empty table gives no rows. Distances are exact: in
doubles while they stay below 2**53, beyond that in whole numbers of any size; if a squared distance could pass 2**63 it would not
fit in the result's columns, and that raises a ValueError. Columns besides the three named are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import runtime

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components in a block (4 bytes each): rows of the table of blocks stay about a megabyte.
BLOCK = 1 << 18
#: Parts that are scanned against all entries at a time.
SLICE = 1024


def integers(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v array<double>) of the vectors that take part, with whole components."""
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger ones are whole numbers

    return df.where(F.col(vector).isNotNull()).where(usable).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.transform(vector, whole).alias("v"))


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    at, flat = rows.offsets.to_numpy(), rows.values.to_numpy()
    out, size = np.zeros((len(rows), width), np.int32), np.diff(rows.offsets.to_numpy())
    out[np.repeat(np.arange(len(rows)), size), np.arange(at[0], at[-1]) - np.repeat(at[:-1], size)] = flat[at[0] : at[-1]]
    return out


class Codebooks:
    """Entries of each part position, sums and counts of their parts, and how far the bounds of each entry's parts have drifted."""

    def __init__(self, start: np.ndarray):
        """``start``: the first vectors, as rows."""
        self.k, self.width = start.shape[0], start.shape[1] // PARTS
        self.entries = np.ascontiguousarray(start.reshape(self.k, PARTS, self.width).transpose(1, 0, 2)).astype(object)
        self.totals = np.zeros((PARTS, self.k, 1 + self.width), object)  # count, then sums
        self.drift = np.zeros((PARTS, self.k))

    def move(self, changes: np.ndarray) -> None:
        """Takes the changes of the sums of one round and moves every entry that has parts."""
        self.totals = self.totals + changes.reshape(self.totals.shape)
        count = self.totals[:, :, :1]
        moved = np.where(count > 0, self.totals[:, :, 1:] // np.where(count > 0, count, 1), self.entries)
        way = np.sqrt(((moved - self.entries) ** 2).sum(2).astype(float))
        self.entries = moved
        if self.k > 1:
            order = np.sort(way, 1)
            self.drift += way + np.where(way == order[:, -1:], order[:, -2:-1], order[:, -1:])

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def scan(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For parts as rows: index of the nearest entry (ties: the lower), and by how much the second nearest is farther away."""
    nearest, slack = np.empty(len(x), np.int64), np.full(len(x), np.inf)
    square = (entries * entries).sum(1)
    for first in range(0, len(x), SLICE):
        some = x[first : first + SLICE]
        d = (some * some).sum(1)[:, None] - 2 * (some @ entries.T) + square
        rows = np.arange(len(some))
        own = d.argmin(1)
        nearest[first : first + len(some)] = own
        if len(entries) > 1:
            best = np.sqrt(d[rows, own].astype(float))
            d[rows, own] = d.max() + 1
            slack[first : first + len(some)] = np.sqrt(d.min(1).astype(float)) - best
    return nearest, slack


class Block:
    """Vectors, the entry of each of their parts, and the heaps of (slack and drift at the time of the scan, row)."""

    def __init__(self, x: np.ndarray, k: int, packed: tuple[bytes, bytes, bytes, bytes] | None = None):
        self.x, self.k, n = x, k, len(x)
        self.own = np.zeros((PARTS, n), np.uint8)
        self.heaps = [[[] for _ in range(k)] for _ in range(PARTS)]
        if packed:
            self.own = np.frombuffer(packed[0], np.uint8).reshape(PARTS, n).copy()
            keys, rows, at = np.frombuffer(packed[1]).tolist(), np.frombuffer(packed[2], np.int32).tolist(), 0
            for m, (p, e) in zip(np.frombuffer(packed[3], np.int32).tolist(), np.ndindex(PARTS, k)):
                self.heaps[p][e] = list(zip(keys[at : at + m], rows[at : at + m]))
                at += m
        self.fresh = packed is None

    def packed(self) -> tuple[bytes, bytes, bytes, bytes]:
        flat = [item for part in self.heaps for heap in part for item in heap]
        sizes = [len(heap) for part in self.heaps for heap in part]
        keys, rows = zip(*flat) if flat else ((), ())
        return self.own.tobytes(), np.array(keys, float).tobytes(), np.array(rows, np.int32).tobytes(), np.array(sizes, np.int32).tobytes()

    def popped(self, part: int, drift: np.ndarray) -> np.ndarray:
        """Rows whose slack may be used up by now (with a margin for the rounding of square roots)."""
        if self.fresh:
            return np.arange(len(self.x))
        out = []
        for heap, bar in zip(self.heaps[part], (drift * (1 + 1e-9) + 1e-6).tolist()):
            while heap and heap[0][0] <= bar:
                out.append(heapq.heappop(heap)[1])
        return np.sort(np.array(out, np.int64))

    def assign(self, entries: np.ndarray, drift: np.ndarray, changes: np.ndarray, kind: type) -> int:
        """Brings every part to its nearest entry and adds what that changes to ``changes``; returns how many were scanned."""
        width, scanned = entries.shape[2], 0
        for p in range(PARTS):
            rows = self.popped(p, drift[p])
            x = self.x[rows, p * width : (p + 1) * width]
            now, slack = scan(x.astype(kind), entries[p])
            scanned += len(rows)
            before = self.own[p, rows]
            new = np.ones(len(rows), bool) if self.fresh else now != before
            whole = np.concatenate([np.ones((len(rows), 1), np.int64), x], 1)[new]
            np.add.at(changes[p], now[new], whole)
            if not self.fresh:
                np.subtract.at(changes[p], before[new], whole)
            self.own[p, rows] = now
            order = np.argsort(now, kind="stable")
            keys, rows, now = (slack + drift[p][now])[order].tolist(), rows[order].tolist(), now[order]
            ends = np.searchsorted(now, np.arange(self.k + 1)).tolist()
            for e in np.unique(now).tolist():
                self.heaps[p][e].extend(zip(keys[ends[e] : ends[e + 1]], rows[ends[e] : ends[e + 1]]))
                heapq.heapify(self.heaps[p][e])
        self.fresh = False
        return scanned

    def errors(self, entries: np.ndarray) -> np.ndarray:
        """Squared distances to the own entries, summed over the parts."""
        width, out = entries.shape[2], 0
        for p in range(PARTS):
            out = out + ((self.x[:, p * width : (p + 1) * width].astype(entries.dtype) - entries[p][self.own[p]]) ** 2).sum(1)
        return out.astype(np.int64)


STATE = ["vec_ids", "labels", "x", "own", "keys", "rows", "sizes", "scanned", "moved"]


def _kinds(df: DataFrame) -> tuple[str, str]:
    return df.schema["vec_id"].dataType.simpleString(), df.schema["label"].dataType.simpleString()


def _lists(values: pa.Array) -> pa.Array:
    """One list of all values."""
    return pa.LargeListArray.from_arrays(pa.array([0, len(values)], pa.int64()), values).cast(pa.list_(values.type))


def _blocks_of(batches, width: int):
    """(ids, labels, vectors) of some vectors at a time, in blocks."""
    most = max(1, BLOCK // max(1, width))
    held: list[pa.RecordBatch] = []
    for b in batches:
        while b.num_rows:
            room = most - sum(x.num_rows for x in held)
            held.append(b.slice(0, room))
            b = b.slice(room)
            if sum(x.num_rows for x in held) == most:
                t = pa.Table.from_batches(held).combine_chunks()
                held = []
                yield t["vec_id"].chunk(0), t["label"].chunk(0), _matrix(t["v"].chunk(0), width)
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t["vec_id"].chunk(0), t["label"].chunk(0), _matrix(t["v"].chunk(0), width)


def _read(batches, k: int, width: int):
    """(ids, labels, block) of the rows of a table of blocks."""
    for b in batches:
        for r in range(b.num_rows):
            x, *packed = (b.column(n)[r].as_py() for n in STATE[2:7])
            x = np.frombuffer(x, np.int32)
            n = len(b.column(0)[r])
            yield b.column(0)[r].values, b.column(1)[r].values, Block(x.reshape(n, PARTS * width), k, tuple(packed))


def _round(source: DataFrame, kinds: tuple[str, str], sent, fresh: bool) -> DataFrame:
    """One assignment of all blocks: their rows of state, and one row a task with the changes of the sums."""
    schema = f"vec_ids array<{kinds[0]}>, labels array<{kinds[1]}>, x binary, own binary, keys binary, rows binary, sizes binary, scanned long, moved array<long>"

    def run(batches):
        entries, drift, kind = sent.value
        _, k, width = entries.shape
        changes, ids, labels = np.zeros((PARTS, k, 1 + width), np.int64), None, None
        made = ((i, j, Block(x, k)) for i, j, x in _blocks_of(batches, PARTS * width)) if fresh else _read(batches, k, width)
        for ids, labels, block in made:
            scanned = block.assign(entries, drift, changes, kind)
            own = [pa.array([x], pa.binary()) for x in (block.x.tobytes(), *block.packed())]
            yield pa.RecordBatch.from_arrays([_lists(ids), _lists(labels), *own, pa.array([scanned]), pa.array([None], pa.list_(pa.int64()))], STATE)
        if ids is not None:
            none = [pa.array([None], pa.list_(ids.type)), pa.array([None], pa.list_(labels.type)), *[pa.array([None], pa.binary())] * 5]
            yield pa.RecordBatch.from_arrays([*none, pa.array([None], pa.int64()), pa.array([changes.reshape(-1)], pa.list_(pa.int64()))], STATE)

    return source.mapInArrow(runtime.lean(run), schema)


def _results(state: DataFrame, kinds: tuple[str, str], sent) -> DataFrame:
    """(vec_id, label, code, error) after the last assignment."""

    def run(batches):
        entries, drift, kind = sent.value
        _, k, width = entries.shape
        for ids, labels, block in _read(batches, k, width):
            block.assign(entries, drift, np.zeros((PARTS, k, 1 + width), np.int64), kind)
            code = [bytes(c).hex() for c in np.ascontiguousarray(block.own.T)]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code, pa.string()), pa.array(block.errors(entries))], ["vec_id", "label", "code", "error"])

    return state.mapInArrow(runtime.lean(run), f"vec_id {kinds[0]}, label {kinds[1]}, code string, error long")


def _changes(state: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' rows of changes: ``size`` numbers."""
    got = state.where("moved IS NOT NULL").select(F.posexplode("moved").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size, np.int64)
    out[got["k"].to_numpy()] = got["n"].to_numpy()
    return out


def fit(rows: DataFrame) -> tuple[Codebooks, DataFrame, type] | None:
    """Codebooks after all rounds, the saved table of blocks as the last round left it, and the kind of number that is exact
    (None: no vectors). ``rows`` as integers() gives them."""
    spark, kinds = rows.sparkSession, _kinds(rows)
    runtime.tune(spark)
    size, most = rows.agg(F.max(F.size("v")), F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))).first()
    if size is None:
        return None
    width, most = -(-size // PARTS) * PARTS, int(most)
    if width * (2 * most) ** 2 >= 1 << 63:
        raise ValueError("components too large: a squared distance would not fit in a long")
    kind = float if 4 * width * (most + 1) ** 2 < 1 << 53 else object
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).toArrow()
    books = Codebooks(_matrix(first["v"].combine_chunks(), width))
    state = None
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((books.entries.astype(kind), books.drift, kind))
        source = rows if state is None else state.where("moved IS NULL")
        step = runtime.save(_round(source, kinds, sent, state is None), "blocks")
        sent.destroy()
        if state is not None:
            runtime.discard(state)
        state = step
        books.move(_changes(state, books.totals.size))
    return books, state, kind


def report(df: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part."""
    spark, rows = df.sparkSession, integers(df)
    kinds = _kinds(rows)
    if (found := fit(rows)) is None:
        return spark.createDataFrame([], f"vec_id {kinds[0]}, code string, error long, label_error long, codebooks_sha256 string")
    books, state, kind = found
    sent = spark.sparkContext.broadcast((books.entries.astype(kind), books.drift, kind))
    out = runtime.save(_results(state.where("moved IS NULL"), kinds, sent), "codes")
    sent.destroy()
    runtime.discard(state)
    sums = out.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return out.join(sums, out["label"].eqNullSafe(sums["__label"])).select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def sql() -> str:
    """For vectors of one size that is a multiple of PARTS, and vec_ids that differ."""
    rounds, square = [], "list_inner_product({0}, {0})"
    for r in range(ROUNDS + 1):
        pairs = f"SELECT p.vec_id, p.k, p.x, min({{'d': {square.format('p.x')} - 2 * list_inner_product(p.x, c.c) + {square.format('c.c')}, 'j': c.j}}) AS b FROM p JOIN c{r} c ON c.k = p.k GROUP BY p.vec_id, p.k, p.x"
        rounds.append(f"a{r} AS MATERIALIZED ({pairs})")
        if r < ROUNDS:
            means = f"SELECT k, j, list(m ORDER BY i) AS c FROM (SELECT k, b.j AS j, i, floor(sum(x[i]) / count(*)) AS m FROM a{r}, range(1, (SELECT max(len(x)) FROM p) + 1) t(i) GROUP BY ALL) GROUP BY k, j"
            rounds.append(f"c{r + 1} AS MATERIALIZED (SELECT o.k, o.j, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN ({means}) n ON n.k = o.k AND n.j = o.j)")
    steps = ",\n".join(rounds)
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, k, v[k * len(v) // {PARTS} + 1:(k + 1) * len(v) // {PARTS}] AS x FROM e, range({PARTS}) t(k)),
c0 AS MATERIALIZED (SELECT k, row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1 AS j, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM e ORDER BY vec_id LIMIT {ENTRIES})),
{steps},
r AS (SELECT vec_id, string_agg(printf('%02x', b.j::INTEGER), '' ORDER BY k) AS code, sum(b.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY k, j)) AS codebooks_sha256 FROM c{ROUNDS})
SELECT r.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r JOIN e ON e.vec_id = r.vec_id, h"""
