"""Pages as rows for training on text and picture: what a page says, as text, Markdown and tagged text, its cells and its segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.plans import serialize

#: Labels of segments; containers and groups are none.
SEGMENTS = ("title", "document_index", "section_header", "checkbox_selected", "checkbox_unselected", "page_header", "page_footer", "caption", "footnote", "table", "formula", "list_item", "code", "picture", "text")


def _sized(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(..., bbox) with the box on a page of size one."""
    bbox = F.array(F.col("l") / F.col("width"), F.col("t") / F.col("height"), F.col("r") / F.col("width"), F.col("b") / F.col("height"))
    return rows.join(sizes, "page").withColumn("bbox", bbox)


def segments(items: DataFrame, elements: DataFrame, sizes: DataFrame) -> DataFrame:
    """(doc_id, page, index_in_doc, label, text, bbox, html) of every item of a document tree that has a place on a page: ``items`` with page
    and cid, ``elements`` with their boxes, ``sizes`` (page, width, height). Tables have their HTML."""
    live = items.where(F.col("label").isin(*SEGMENTS) & F.col("cid").isNotNull())
    placed = _sized(live.join(elements.select("page", F.col("cid").cast("long").alias("cid"), *"ltrb"), ["page", "cid"]), sizes)
    return placed.select("doc_id", "page", F.col("ord").alias("index_in_doc"), "label", F.coalesce("text", F.lit("")).alias("text"), "bbox", F.when(F.col("label") == "table", serialize.table_html("cells")).alias("html"))


def page_rows(items: DataFrame, elements: DataFrame, cells: DataFrame, sizes: DataFrame, hashes: DataFrame) -> DataFrame:
    """(doc_id, page, contents, contents_md, contents_dt, cells, segments, page_hash, width, height) of every page that has items.

    ``contents`` are the texts of its body in order, a space after each; ``cells`` have their box on a page of size one; ``page_hash`` is the
    SHA-256 of the document's hash (``hashes``: doc_id, hash), a colon and the page's number."""
    on_page = items.withColumn("key", F.struct("doc_id", "page")).where("page IS NOT NULL")
    said = on_page.where((F.col("layer") == "body") & (F.length("text") > 0))
    contents = said.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: F.concat(x["text"], F.lit(" "))), "").alias("contents"))
    seen = segments(items, elements, sizes).withColumn("key", F.struct("doc_id", "page"))
    listed = seen.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("index_in_doc", "label", "text", "bbox", "html"))).alias("segments"))
    placed = _sized(cells, sizes).groupBy("page").agg(F.array_sort(F.collect_list(F.struct("idx", "text", "bbox", F.col("from_ocr").alias("ocr"), "confidence"))).alias("cells"))
    rows = on_page.select("key").distinct()
    for part in (contents, serialize.markdown(on_page, "key").withColumnRenamed("markdown", "contents_md"), serialize.tagged(on_page, "key").withColumnRenamed("tagged", "contents_dt"), listed):
        rows = rows.join(part, "key", "left")
    rows = rows.select("key.*", *(F.coalesce(c, F.lit("")).alias(c) for c in ("contents", "contents_md", "contents_dt")), "segments").join(sizes, "page").join(placed, "page", "left").join(hashes, "doc_id")
    return rows.withColumn("page_hash", F.sha2(F.concat_ws(":", "hash", F.col("page").cast("string")), 256)).drop("hash")
