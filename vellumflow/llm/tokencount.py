"""Operator 13: token counts of texts, kept in a cache by digest.

A count depends on a text's content and on the tokenizer. The content counts by the SHA-256 of its normalised form, the tokenizer by a
digest of its file, its library's version and how it is called. The cache is a table (version, digest, n_tokens) in a folder that
driver and executors share, partitioned by version. Digests of all texts are a narrow table; those that the cache does not know are
found by an anti-join, and of each the row with the least doc_id stands for all its copies: (digest, doc_id) of these few is joined
with the texts, so that copies fall out there and one digest's copies are spread by their ids. Only these texts are encoded; their
counts are appended to the cache, and all rows get theirs from these and from what the cache had. Spark broadcasts the missing digests where they are few
(by its own threshold), so no text is shuffled then; where most are missing, texts are shuffled once.

Inside a text, counts of its pieces between certain cuts (before a space that stands before another character than white space, and at
both ends of white space: the splitter of byte-level files never reaches across) are kept in a bounded table of the process; pieces
that it lacks go to the library, as do whole texts with other white space than tab, line feed, carriage return and space, with a
special string or in other kinds of tokenizer files.

Null texts count as empty: no bytes and no tokens. Equal texts have one entry, whatever their ids (null and repeated ids are rows each
for itself); rows that repeat id and text are encoded at most once in each task. An entry written twice, by two runs at a time, counts
once. An empty table gives no rows and appends nothing. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.scratch import fresh_folder

from . import runtime

LIMIT = 1024
KEPT, LONGEST = 400_000, 64
#: White space that is not cut at here, and characters on whose kind splitters disagree.
ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
#: A space with what follows up to the next white space, or white space but for a last space before something else.
PIECE = re.compile(r" ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+")
CACHE = "version string, digest binary, n_tokens long"


class Counter(dict):
    """Counts the tokens of texts as the library of the file at ``path`` does, without added special tokens."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole, self.special, self.cuts = (lambda text: len(model.encode(text, num_threads=1))), (), False
            return
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        splitter = spec.get("pre_tokenizer") or {}
        self.whole = lambda text: len(model.encode(text, add_special_tokens=False).ids)
        self.special = tuple(t["content"] for t in spec.get("added_tokens", []))
        self.cuts = spec.get("normalizer") is None and splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)

    def __missing__(self, piece: str) -> int:
        n = self.whole(piece)
        if len(piece) <= LONGEST:
            if len(self) >= KEPT:
                self.clear()
            self[piece] = n
        return n

    def count(self, text: str) -> int:
        if not self.cuts or ODD.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        return sum(map(self.__getitem__, PIECE.findall(text)))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def version(path: str) -> str:
    """Digest of the tokenizer: file, library and its version, how it is called."""
    import sentencepiece
    import tokenizers

    with open(path, "rb") as f:
        digest = hashlib.sha256(f.read())
    digest.update(f"|{tokenizers.__version__}|{sentencepiece.__version__}|no added special tokens".encode())
    return digest.hexdigest()


def normalised(text: str = "text") -> Column:
    """What of a text its count depends on: all of it, and null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def stored(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) that the cache holds for a tokenizer, each digest once."""
    return spark.read.schema(CACHE).parquet(cache).where(F.col("version") == tokenizer).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def create(spark: SparkSession, cache: str) -> str:
    """Makes an empty cache at a path where there is none."""
    spark.createDataFrame([], CACHE).write.mode("ignore").partitionBy("version").parquet(cache)
    return cache


def encode(texts: DataFrame, path: str) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows; of equal rows in a row, one."""

    def run(batches):
        tokens, last = counter(path), None
        for b in batches:
            digests, counts = [], []
            for digest, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if digest != last:
                    digests.append(digest)
                    counts.append(tokens.count(text))
                    last = digest
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(runtime.lean(run), "digest binary, n_tokens long")


def counts(df: DataFrame, path: str, cache: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; counts that ``cache`` (see create()) lacks are appended to it."""
    spark, tokenizer, text = df.sparkSession, version(path), normalised()
    runtime.tune(spark)
    digest = F.unhex(F.sha2(text, 256))
    rows = runtime.save(df.select("doc_id", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")), "digests")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    needed = runtime.save(rows.groupBy("digest").agg(F.min(key).alias("key")).join(stored(spark, cache, tokenizer), "digest", "left"), "needed")
    missing = runtime.save(needed.where("n_tokens IS NULL").select("digest", "key"), "missing")
    texts = df.select(digest.alias("digest"), key.alias("key"), text.alias("text")).join(missing, ["digest", "key"], "left_semi").select("digest", "text")
    new = runtime.save(encode(texts, path).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "new")
    new.select(F.lit(tokenizer).alias("version"), "digest", "n_tokens").write.mode("append").partitionBy("version").parquet(cache)
    runtime.discard(missing)
    found = rows.join(needed.where("n_tokens IS NOT NULL").select("digest", "n_tokens").unionByName(new), "digest", "left")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def report(df: DataFrame, path: str) -> DataFrame:
    """counts() with an empty cache of its own, which goes when the application ends."""
    spark = df.sparkSession
    return counts(df, path, create(spark, f"{fresh_folder(spark)}/token_counts"))
