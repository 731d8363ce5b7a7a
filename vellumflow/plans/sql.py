"""The parsers and text functions for use in SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vellumflow.sources import reader
from vellumflow.sources.tree import ITEM_FIELDS, Tree


def _width() -> int:
    """Columns of an item row."""
    probe = Tree()
    probe.add("text")
    return len(probe.rows()[0])


class ParseDocument:
    """parse_document(format, content): the items of a document as rows; a bad one gives a row with its error."""

    def eval(self, kind: str, content):
        try:
            for row in reader.parse(kind, bytes(content) if isinstance(content, (bytes, bytearray)) else content).rows():
                yield None, *row
        except Exception as e:  # a bad document is a row
            yield f"{type(e).__name__}: {e}"[:300], *[None] * _width()


def register(spark: SparkSession) -> None:
    """parse_document as a table function, detect_format as a function, of which only the ends of a content go to Python."""
    spark.udtf.register("parse_document", F.udtf(ParseDocument, returnType=f"error string, {ITEM_FIELDS}"))
    spark.udf.register("detect_format_of", F.pandas_udf(reader.kinds, "string"))
    head, tail = reader.looked_at("content")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION detect_format(name STRING, content BINARY) RETURNS STRING RETURN detect_format_of(name, {head}, {tail})")
