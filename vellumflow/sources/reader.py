"""Files and text columns to rows of document items: one Python boundary, errors as data."""

from __future__ import annotations

import gzip
import hashlib
import time

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from vellumflow.sources import formats, html, images, markup, office, xmldocs
from vellumflow.sources.tree import ITEM_FIELDS, Tree

#: For each format its parser and whether that takes text.
PARSERS = {
    "html": (html.parse, True), "md": (markup.markdown, True), "asciidoc": (markup.asciidoc, True), "csv": (markup.separated, True), "vtt": (markup.webvtt, True), "xml_jats": (xmldocs.jats, True), "xml_uspto": (xmldocs.patent, True),
    "json_tree": (xmldocs.saved, True), "docx": (office.docx, False), "pptx": (office.pptx, False), "xlsx": (office.xlsx, False), "ofd": (xmldocs.ofd, False), "mets_gbs": (xmldocs.mets, False), "image": (images.parse, False),
}
#: Bytes of documents that a Python worker gets at a time.
BATCH_BYTES = 32 << 20
#: Items that a worker makes before it hands them on: a batch of many small documents is many items.
BATCH_ITEMS = 2048
#: Formats that need a parser of the caller's.
PLUGGED = ("pdf", "audio")
TOO_LATE = "document timeout exceeded"


def parse(kind: str, content: bytes | str, base: str | None = None, parsers: dict | None = None) -> Tree:
    """``parsers``: for a format a function from content to a Tree, of the caller's; it comes before the library's own."""
    if parsers and kind in parsers:
        return parsers[kind](content)
    if kind not in PARSERS:
        raise ValueError(f"no parser for {kind}" + (": it has to be plugged in" if kind in PLUGGED else ""))
    parser, text = PARSERS[kind]
    if text and isinstance(content, bytes):
        content = content.decode("utf-8", "replace")
    return parser(content, base) if kind == "html" else parser(content)


def files(spark: SparkSession, path: str, patterns: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length, content) of the files below a folder; office lock files are left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if patterns:
        reader = reader.option("pathGlobFilter", patterns)
    return reader.load(path).where(~F.regexp_extract("path", r"([^/]+)$", 1).startswith("~$"))


#: What of a file is looked at to find its format: its first bytes, and of an archive the last ones, where its index is.
HEAD, TAIL = 8192, 256 << 10


def looked_at(content: str) -> tuple[str, str]:
    """SQL of the first bytes of a content, and of the last ones if it is an archive (else null)."""
    return f"substring({content}, 1, {HEAD})", f"CASE WHEN substring({content}, 1, 2) = X'504B' THEN substring({content}, greatest(octet_length({content}) - {TAIL}, 0) + 1, {TAIL}) END"


def kinds(name: pd.Series, head: pd.Series, tail: pd.Series) -> pd.Series:
    """The formats of files, by their names and what looked_at() gives."""
    return pd.Series([formats.detect(n, bytes(h if h is not None else b""), None if t is None else bytes(t)) for n, h, t in zip(name, head, tail)])


def inputs(found: DataFrame, allowed: tuple[str, ...] | None = None, max_size: int | None = None) -> DataFrame:
    """(doc_id, hash, path, file, format, filesize, status, error, content) of files: what is not allowed is skipped, what is
    too large or of no known format fails; the content of neither is hashed or read on, and of too large files nothing is read.

    ``hash`` is that of the content, ``doc_id`` that of path and content: equal files are documents each for itself."""

    rows = found.select("path", "length", "content")
    if max_size is not None:
        small, large = F.col("length") <= max_size, F.col("length") > max_size
        rows = rows.where(small).unionByName(found.select("path", "length").where(large).withColumn("content", F.lit(None).cast("binary")))
    rows = rows.withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1)).withColumn("format", F.pandas_udf(kinds, "string")("file", *map(F.expr, looked_at("content"))))
    large = F.col("length") > max_size if max_size is not None else F.lit(False)
    barred = ~F.col("format").isin(*allowed) if allowed is not None else F.lit(False)
    status = F.when(large, "failure").when(F.col("format").isNull(), "failure").when(barred, "skipped").otherwise("pending")
    error = F.when(large, "file too large").when(F.col("format").isNull(), "format unknown").when(barred, "format not allowed")
    live = F.col("status") == "pending"
    rows = rows.withColumn("status", status).withColumn("error", error).withColumn("hash", F.when(live, F.sha2("content", 256)))
    return rows.select(F.when(live, F.sha2(F.concat_ws(":", "hash", "path"), 256)).alias("doc_id"), "hash", "path", "file", F.when(large, F.lit(None)).otherwise(F.col("format")).alias("format"), F.col("length").alias("filesize"), "status", "error", F.when(live, F.col("content")).alias("content"))


def items(df: DataFrame, kind: str | None = None, content: str = "content", key: str = "doc_id", base: str | None = None, timeout: float | None = None, parsers: dict | None = None) -> DataFrame:
    """(key, error, items...) rows of each document: a document that cannot be parsed gives one row with its error.

    ``kind`` is the format of all rows, or that of a column named format. Each Arrow batch is parsed on its own, so
    tasks stay narrow and no row is shuffled. A document that took longer than ``timeout`` seconds keeps its items and
    gets one more row that says so.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    rows = df.select(F.col(key).alias("key"), F.col(content).alias("content"), (F.lit(kind) if kind else F.col("format")).alias("format"), (F.col(base) if base else F.lit(None).cast("string")).alias("base"))
    schema = StructType.fromDDL(f"key {df.schema[key].dataType.simpleString()}, error string, {ITEM_FIELDS}")
    arrow, names = to_arrow_schema(schema), schema.names

    def made(out: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in out], schema=arrow)

    def run(batches):
        for b in batches:
            out: list[dict] = []
            for n in range(b.num_rows):
                if len(out) >= BATCH_ITEMS:
                    yield made(out)
                    out = []
                k, c, f, u = (b.column(j)[n].as_py() for j in range(4))
                began = time.monotonic()
                try:
                    if c is None:
                        raise ValueError("no content")
                    got = parse(f, c, u, parsers).rows()
                except Exception as e:  # a bad document is a row, not a failed task
                    out.append({"key": k, "error": f"{type(e).__name__}: {e}"[:300]})
                    continue
                for r in got:
                    row = dict(zip(names[2:], r), key=k, error=None)
                    if row["cells"] is not None:
                        row["cells"] = [dict(zip(("r0", "r1", "c0", "c1", "text", "column_header", "row_header"), x)) for x in row["cells"]]
                    out.append(row)
                if timeout is not None and time.monotonic() - began > timeout:
                    out.append({"key": k, "error": TOO_LATE})
            yield made(out)

    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def archive_bytes(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def document_hash(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()
