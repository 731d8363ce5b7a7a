"""Operator 7: byte-pair encoding with forced boundaries, and decoding.

A tokenizer file of byte-level BPE with an end-of-word mark defines a set of vocabulary tokens. Two neighbouring
bytes that stand next to each other in no vocabulary token can never be merged, so the place between them is a
certain cut: the fragments between cuts are encoded independently and their ids concatenated.

Texts are first divided at ASCII white space (the file's normaliser and splitter never join anything across it);
the resulting chunks repeat, so their encodings are kept in a bounded table per task.

Null texts count as empty. An empty text has no ids and decodes to the empty string.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime
from .pieces import plain_pieces

CACHE_ENTRIES = 400_000
CACHE_CHARS = 64
END = "</w>"
SHORT, NEVER = 64, 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class ForcedBoundaryBPE:
    """Encodes and decodes as the tokenizer file at ``path`` prescribes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != END or spec.get("decoder") is not None:
            raise ValueError("a BPE file with the end-of-word mark and without a decoder is needed")
        if not self.rules_are_plain(spec):
            raise ValueError("a file whose rules drop white space and split words is needed")
        self.rules = Tokenizer.from_file(path)  # its normaliser and splitter only
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(a, b): r for r, (a, b) in enumerate(pairs)}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.joined: set[tuple[str, str]] = set()
        for token in self.vocab:
            letters = self.letters(token[: -len(END)], True) if token.endswith(END) and len(token) > len(END) else self.letters(token, False)
            self.joined.update(zip(letters, letters[1:]))
        self.plain = all(x.startswith("<|") for x in self.special)
        self.letter = byte_letters()
        self.pieces: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def rules_are_plain(spec: dict) -> bool:
        """Whether the file splits as ``plain_pieces`` does: checked on its rules' own text."""
        kinds = [x["type"] for part, name in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")) for x in (spec.get(part) or {}).get(name, [])]
        return kinds == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"] and "'s|'t|'re|'ve|'m|'ll|'d|" in json.dumps(spec["pre_tokenizer"])

    @staticmethod
    def letters(word: str, ends: bool) -> list[str]:
        out = list(word)
        if ends and out:
            out[-1] += END
        return out

    def fragments(self, letters: list[str]) -> Iterator[list[str]]:
        """The stretches between certain cuts."""
        first = 0
        for k in range(1, len(letters)):
            if (letters[k - 1], letters[k]) not in self.joined:
                yield letters[first:k]
                first = k
        if letters:
            yield letters[first:]

    def merge(self, parts: list[str]) -> list[int]:
        """Merges by lowest rank, then leftmost; long fragments with a heap over a linked list, in n log n."""
        n, ranks = len(parts), self.ranks
        if n <= SHORT:
            of = [ranks.get(x, NEVER) for x in zip(parts, parts[1:])]
            while of and (best := min(of)) != NEVER:
                k = of.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                del of[k]
                if k < len(of):
                    of[k] = ranks.get((parts[k], parts[k + 1]), NEVER)
                if k:
                    of[k - 1] = ranks.get((parts[k - 1], parts[k]), NEVER)
            return [self.vocab[x] for x in parts if x in self.vocab]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, k) for k in range(n - 1) if (r := ranks.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        gone = [False] * n
        while heap:
            rank, k = heapq.heappop(heap)
            if gone[k] or (nxt := after[k]) >= n or ranks.get((parts[k], parts[nxt])) != rank:
                continue
            parts[k] += parts[nxt]
            gone[nxt] = True
            after[k] = after[nxt]
            if after[k] < n:
                before[after[k]] = k
                if (r := ranks.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
            if (p := before[k]) >= 0 and (r := ranks.get((parts[p], parts[k]))) is not None:
                heapq.heappush(heap, (r, p))
        return [self.vocab[parts[k]] for k in range(n) if not gone[k] and parts[k] in self.vocab]

    def word(self, word: str) -> tuple[int, ...]:
        """The ids of one piece of the splitter, given in byte letters."""
        if (found := self.pieces.get(word)) is None:
            found = tuple(i for part in self.fragments(self.letters(word, True)) for i in self.merge(part))
            if len(word) <= CACHE_CHARS:
                if len(self.pieces) >= CACHE_ENTRIES:
                    self.pieces.clear()
                self.pieces[word] = found
        return found

    def chunk(self, chunk: str) -> tuple[int, ...]:
        """The ids of a text without ASCII white space."""
        if self.plain and (pieces := plain_pieces(chunk)) is not None:
            return tuple(i for p in pieces for i in self.word(p if p.isascii() else "".join([self.letter[b] for b in p.encode()])))
        out: list[int] = []
        for part in self.special_cut.split(chunk) if self.special_cut else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                normal = self.rules.normalizer.normalize_str(part)
                for piece, _ in self.rules.pre_tokenizer.pre_tokenize_str(normal):
                    out.extend(self.word(piece))
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        return [i for chunk in chunks(text) for i in self.chunk(chunk)]

    def decode(self, ids) -> str:
        """Without a decoder in the file, the tokens joined by one space."""
        return " ".join(self.tokens[i] for i in ids)


def chunks(text: str | None) -> list[str]:
    return [c for c in re.split("[\t\n\r ]", text or "") if c]


_encoders: dict[str, ForcedBoundaryBPE] = {}


#: For each file, what digests() keeps of chunks: number of ids, ids and tokens joined by one space.
_known: dict[str, dict[str, tuple[int, str, str]]] = {}


def encoder(path: str) -> ForcedBoundaryBPE:
    if path not in _encoders:
        _encoders[path] = ForcedBoundaryBPE(path)
    return _encoders[path]


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row."""
    runtime.tune(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        bpe = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.encode(t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], ["key", "ids"])

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(runtime.lean(run), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, decoded) of every row of ids."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        bpe = encoder(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([bpe.decode(x or ()) for x in b.column(1).to_pylist()], pa.string())], ["key", "decoded"])

    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInArrow(runtime.lean(run), f"key {kind}, decoded string").withColumnRenamed("key", key)


def digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, in one pass.

    Each distinct chunk is encoded, and its ids decoded, once per task and kept as the two strings that the digests
    are made of; both digests join their parts by one space, so parts can be joined without going back to ids.
    """
    runtime.tune(df.sparkSession)

    def run(batches):
        bpe = encoder(path)
        known = _known.setdefault(path, {"": (0, "", "")})
        for b in batches:
            n, ids, text = [], [], []
            for value in b.column(1).to_pylist():
                parts = []
                for c in (value or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
                    if (got := known.get(c)) is None:
                        x = bpe.chunk(c)
                        got = (len(x), " ".join(map(str, x)), bpe.decode(x))
                        if len(c) <= CACHE_CHARS:
                            if len(known) >= CACHE_ENTRIES:
                                known.clear()
                                known[""] = (0, "", "")
                            known[c] = got
                    if got[0]:
                        parts.append(got)
                n.append(sum(p[0] for p in parts))
                ids.append(hashlib.sha256(" ".join([p[1] for p in parts]).encode()).hexdigest())
                text.append(hashlib.sha256(" ".join([p[2] for p in parts]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", "text").mapInArrow(runtime.lean(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
