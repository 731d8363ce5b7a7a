"""Operator 6: token ids in compressed shard files, each a wavelet matrix.

Documents are dealt to partitions by ranges of doc_id and sorted, encoded, and gathered into shards of about
``SHARD_TOKENS`` ids (a document is never divided). A shard file holds one bit-plane per bit of the largest id, from
the highest down; every plane lists that bit of all ids after a stable partition by the bits above it. Each plane is
stored in blocks of 8 KB, each compressed for itself, with the counts of ones before every block in the file: a rank
expands and counts one block at most, whatever the length of the shard. From rank follow access, counting and
occurrence lookup. Ids from 0 to 2**32-1 can be held.

Shard files are rows (part, shard, ..., file binary) of a parquet folder, so that any store that Spark writes will
do. Only their short headers are needed to place a shard in the whole sequence.

Null texts count as empty: they still get their end id. Rows of equal doc_id stay together, in order of the first HEAD_CHARS code
points of their texts, then of a hash of them, equal ones as they are read; a range may end between any two of them, so an id that
repeats is spread over as many partitions as its texts fill.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime
from .bpe import END, ForcedBoundaryBPE, byte_letters
from .pieces import Recent, is_plain, pieces_of
from .wordtable import Table, divide

SHARD_TOKENS = 1 << 20
BLOCK = 1 << 16
MAGIC, HEAD = b"VWM2", "<4sIQQQ"
#: Pieces and chunks whose ids a worker keeps (chunks take some 50 bytes each).
CACHE_ENTRIES, CHUNKS = 400_000, 1_000_000
#: Plain pieces that the library is asked for in one text.
ASKED = 20_000
HEAD_CHARS = 64


def build(ids: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> bytes:
    """The file of one shard: ids of documents in sequence, their lengths and keys."""
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    rest = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    blocks = -(-len(ids) // BLOCK)
    pack = zstandard.ZstdCompressor(1).compress
    sizes, ones, parts = np.zeros((bits, blocks), "<u4"), np.zeros((bits, blocks + 1), "<u4"), []
    for level in range(bits):
        bit = (rest & rest.dtype.type(1 << (bits - 1 - level))) != 0
        high, low = np.flatnonzero(bit), np.flatnonzero(~bit)
        raw = np.packbits(bit).tobytes()
        own = [pack(raw[k : k + BLOCK // 8]) for k in range(0, len(raw), BLOCK // 8)]
        sizes[level] = [len(x) for x in own]
        ones[level] = np.searchsorted(high, np.minimum(np.arange(blocks + 1) * BLOCK, len(ids)))
        parts += own
        rest = np.concatenate([rest[low], rest[high]])
    docs = pack(lengths.astype("<i8").tobytes() + keys.astype("<i8").tobytes())
    head = struct.pack(HEAD, MAGIC, bits, len(ids), len(lengths), len(docs))
    return b"".join([head, sizes.tobytes(), ones.tobytes(), docs, *parts])


class Shard:
    """Reads one shard file; blocks are expanded when they are needed, and a few are kept."""

    KEPT = 256

    def __init__(self, file: bytes):
        magic, self.bits, self.n, n_docs, docs = struct.unpack_from(HEAD, file)
        if magic != MAGIC:
            raise ValueError("not a shard file")
        at, blocks = struct.calcsize(HEAD), -(-self.n // BLOCK)
        sizes = np.frombuffer(file, "<u4", self.bits * blocks, at)
        at += 4 * self.bits * blocks
        self.ones = np.frombuffer(file, "<u4", self.bits * (blocks + 1), at).reshape(self.bits, blocks + 1).astype(np.int64)
        at += 4 * self.bits * (blocks + 1)
        self.unpack = zstandard.ZstdDecompressor().decompress
        raw = self.unpack(file[at : at + docs])
        self.lengths, self.keys = np.frombuffer(raw, "<i8", n_docs), np.frombuffer(raw, "<i8", n_docs, 8 * n_docs)
        self.file = file
        ends = at + docs + np.cumsum(sizes, dtype=np.int64)
        self.spans = np.stack([ends - sizes, ends], 1).reshape(self.bits, blocks, 2)
        self.zeros = [self.n - int(x[-1]) for x in self.ones]
        self.held: dict[tuple[int, int], np.ndarray] = {}

    def block(self, level: int, k: int) -> np.ndarray:
        """The packed bytes of a block."""
        if (level, k) not in self.held:
            if len(self.held) >= self.KEPT:
                self.held.clear()
            a, b = self.spans[level, k].tolist()
            self.held[level, k] = np.frombuffer(self.unpack(self.file[a:b]), np.uint8)
        return self.held[level, k]

    def rank1(self, level: int, pos: int) -> int:
        k, rest = divmod(pos, BLOCK)
        before = int(self.ones[level, k])
        if not rest:
            return before
        part = self.block(level, k)[: -(-rest // 8)].copy()
        if spare := rest % 8:
            part[-1] &= 0xFF << (8 - spare) & 0xFF
        return before + int(np.bitwise_count(part).sum())

    def bit(self, level: int, pos: int) -> int:
        k, rest = divmod(pos, BLOCK)
        return int(self.block(level, k)[rest // 8] >> (7 - rest % 8)) & 1

    def access(self, pos: int) -> int:
        if not 0 <= pos < self.n:
            raise IndexError(pos)
        value = 0
        for level in range(self.bits):
            b = self.bit(level, pos)
            one = self.rank1(level, pos)
            pos = self.zeros[level] + one if b else pos - one
            value = value << 1 | b
        return value

    def _range(self, token: int, first: int, last: int) -> tuple[int, int]:
        if token < 0 or token >> self.bits:
            return 0, 0
        for level in range(self.bits):
            a, b = self.rank1(level, first), self.rank1(level, last)
            if token >> (self.bits - 1 - level) & 1:
                first, last = self.zeros[level] + a, self.zeros[level] + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, first: int = 0, last: int | None = None) -> int:
        """Occurrences of ``token`` in [first, last)."""
        a, b = self._range(token, first, self.n if last is None else last)
        return b - a

    def select(self, level: int, which: int, k: int) -> int:
        """The place of the k-th (from 0) bit of value ``which`` on a level."""
        before = self.ones[level]
        marks = before if which else np.minimum(np.arange(len(before)) * BLOCK, self.n) - before
        block = int(np.searchsorted(marks, k, side="right")) - 1
        bits = np.unpackbits(self.block(level, block), count=min(BLOCK, self.n - block * BLOCK)) == which
        return block * BLOCK + int(np.flatnonzero(bits)[k - int(marks[block])])

    def find(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of ``token``; -1 if there are not so many."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            return -1
        pos = a + k
        for level in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - level) & 1
            pos = self.select(level, one, pos - self.zeros[level] if one else pos)
        return pos

    def all(self) -> np.ndarray:
        """All ids, by undoing the partitions from the lowest plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        rest = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            raw = b"".join([self.unpack(self.file[a:b]) for a, b in self.spans[level].tolist()])
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.n).view(bool)
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~bit)] = rest[: self.zeros[level]]
            out[np.flatnonzero(bit)] = rest[self.zeros[level] :] | kind(1 << (self.bits - 1 - level))
            rest = out
        return rest


class ChunkEncoder:
    """The tokenizers library, asked once for each distinct piece.

    Nothing is ever joined across ASCII white space, so the ids of a text are those of its chunks in sequence, and a plain
    chunk's pieces are encoded each for itself. Of the chunks of a batch each distinct one is looked up once, and what comes
    again in later batches is kept, chunks and pieces; all else are operations on arrays.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.divided = Tokenizer.from_file(path)  # for plain pieces, on which the file's normaliser and splitter do nothing more
        self.divided.no_truncation()
        self.divided.no_padding()
        self.divided.normalizer = None
        self.divided.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = np.array([0x20 if b == 0x20 else ord(x) for b, x in enumerate(byte_letters())], "<u4")  # as the splitter's byte level writes bytes
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.plain = spec["model"].get("end_of_word_suffix") == END and ForcedBoundaryBPE.rules_are_plain(spec)
        self.last = np.zeros(max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1, bool)
        self.last[[i for t, i in spec["model"]["vocab"].items() if t.endswith(END)]] = True
        self.pieces, self.chunks = Recent(CACHE_ENTRIES), Table(CHUNKS)

    def one_by_one(self, texts: list[str]) -> dict[str, bytes]:
        return {p: np.asarray(e.ids, dtype="<u4").tobytes() for p, e in zip(texts, self.tokenizer.encode_batch(texts, add_special_tokens=False))}

    def library(self, plain: list[str], other: list[str]) -> dict[str, bytes]:
        """Plain pieces are asked for in one text; each ends where an id with the end-of-word mark does."""
        out = self.one_by_one(other) if other else {}
        for k in range(0, len(plain), ASKED):
            part = plain[k : k + ASKED]
            joined = self.letters[np.frombuffer(" ".join(part).encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.asarray(self.divided.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.last[ids]) + 1
            if len(stops) == len(part):
                raw, ends = ids.tobytes(), (4 * stops).tolist()
                out.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                out.update(self.one_by_one(part))
        return out

    def learn(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks: of plain ones, those of their pieces; others are left to the library as they are."""
        texts = [c.decode() for c in chunks]
        plain = [is_plain(t) for t in texts]
        flat = pieces_of([t for t, p in zip(texts, plain) if p])
        self.pieces.turn()
        need = {p for p in flat if p != " " and not self.pieces.has(p)}
        got = self.library(list(need), [t for t, p in zip(texts, plain) if not p])
        self.pieces.update((p, got[p]) for p in need)
        pieces, found, own = self.pieces, [], []
        for p in flat:
            if p == " ":
                found.append(b"".join(own))
                own = []
            else:
                own.append(pieces[p])
        found.append(b"".join(own))
        ready = iter(found)
        return [next(ready) if p else got[t] for t, p in zip(texts, plain)]

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in sequence, where each text's end); null texts are empty."""
        if not self.plain:  # another kind of file: whole texts, nothing looked up
            found = [e.ids for e in self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], "<u4"), np.cumsum(list(map(len, found)), dtype=np.int64)
        found = divide(texts)
        begin, size = self.chunks.places(found, self.learn)
        each = size[found.which]
        ends = np.concatenate([[0], np.cumsum(each)])
        ids = self.chunks.ids[np.arange(ends[-1]) + np.repeat(begin[found.which] - ends[:-1], each)]
        return ids, ends[found.of_text[1:]]

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        ids, ends = self.flat(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip([0, *ends.tolist()], ends.tolist())]


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def write(df: DataFrame, folder: str, path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encodes (doc_id, text) with the tokenizer file ``path`` and writes the shard files into ``folder``."""
    spark = df.sparkSession
    runtime.tune(spark)

    def run(batches):
        encode = encoder(path)
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        keys: list[int | None] = []
        held = 0

        def flush():
            nonlocal ids, keys, held, shard, before
            lengths = np.array([len(x) for x in ids], np.int64)
            missing = [k is None for k in keys]
            file = build(np.concatenate(ids), lengths, np.array([0 if k is None else k for k in keys], np.int64))
            row = pa.RecordBatch.from_arrays([pa.array([part]), pa.array([shard]), pa.array([keys[0]], pa.int64()), pa.array([before]), pa.array([held]), pa.array([sum(missing)]), pa.array([file], pa.binary())], NAMES)
            ids, keys, held, shard, before = [], [], 0, shard + 1, before + held
            return row

        for b in batches:
            flat, ends = encode.flat(b.column(1))
            flat = np.insert(flat, ends, np.uint32(end_id))
            ends = (ends + np.arange(1, len(ends) + 1)).tolist()
            for key, first, last in zip(b.column(0).to_pylist(), [0, *ends], ends):
                if ids and held + last - first > shard_tokens:
                    yield flush()
                ids.append(flat[first:last])
                keys.append(key)
                held += last - first
        if ids:
            yield flush()

    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = rows.agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")).first()
    order = ["doc_id"]
    if size["n"] != size["ids"]:
        rows = rows.withColumns({"__head": F.left("text", F.lit(HEAD_CHARS)), "__hash": F.xxhash64("text"), "__row": F.monotonically_increasing_id()})
        order += ["__head", "__hash", "__row"]
    rows = rows.repartitionByRange(runtime.partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(runtime.lean(run), "part long, shard long, first_doc long, before long, n_tokens long, n_null long, file binary").write.parquet(folder)


NAMES = ["part", "shard", "first_doc", "before", "n_tokens", "n_null", "file"]


def read(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files in ``folder``.

    The driver gathers one pair of numbers for each written partition, to add up where the partitions begin.
    """
    files = spark.read.parquet(folder)
    heads = files.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.min("first_doc").alias("first")).collect()
    at, starts = 0, []
    for row in sorted(heads, key=lambda r: r["part"]):
        starts.append((row["part"], at))
        at += row["n"]
    base = dict(starts)

    def run(batches):
        for b in batches:
            for part, before, missing, file in zip(*(b.column(k).to_pylist() for k in range(4))):
                shard = Shard(file)
                ids = shard.all().astype("<u4")
                stops = np.cumsum(shard.lengths)
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (s - n) : 4 * s]) for s, n in zip(stops.tolist(), shard.lengths.tolist())]
                keys = pa.array(shard.keys, pa.int64(), mask=np.arange(len(shard.keys)) < missing)
                yield pa.RecordBatch.from_arrays([keys, pa.array(stops - shard.lengths + before + base[part]), pa.array(shard.lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "before", "n_null", "file").mapInArrow(runtime.lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_files(df: DataFrame, path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shard files of ``df`` (doc_id, text) into the shared folder and reads them back."""
    import uuid

    folder = f"{runtime.shared_dir(df.sparkSession)}/vellumflow/{uuid.uuid4().hex}/shards"
    write(df, folder, path, end_id, shard_tokens)
    return read(df.sparkSession, folder)
