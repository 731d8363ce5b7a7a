"""Queries that parse: pages of HTML, and other formats made from the plain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumflow.plans import serialize
from vellumflow.registry import query, table
from vellumflow.sources import reader


def page_items(spark, folder):
    return reader.items(table(spark, folder, "pages"), "html", "html", "page_id", "url")


@query("html_items_by_layer")
def html_items_by_layer(spark, folder):
    return page_items(spark, folder).groupBy("layer", "label").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("html_items")
def html_items(spark, folder):
    return page_items(spark, folder).select("page_id", "ord", "parent", "depth", "label", "level", "layer", "text", "style", "link")


@query("html_to_markdown")
def html_to_markdown(spark, folder):
    return serialize.markdown(page_items(spark, folder), "page_id")


@query("html_outline")
def html_outline(spark, folder):
    return serialize.outline(page_items(spark, folder).where("error IS NULL"), "page_id")


@query("parse_titles_match", "SELECT count(*)::BIGINT AS pages, count(*)::BIGINT AS with_title, 0::BIGINT AS errors FROM pages")
def parse_titles_match(spark, folder):
    """Every page parses and has its title as furniture."""
    title = (F.col("label") == "title") & (F.col("layer") == "furniture")
    return page_items(spark, folder).agg(F.count_distinct("page_id").alias("pages"), F.count_if(title).alias("with_title"), F.count("error").alias("errors"))


@query("csv_tables", "SELECT n_regionkey AS doc_id, count(*)::BIGINT * 3 AS cells, count(*)::BIGINT - 1 AS last_row FROM (SELECT n_regionkey FROM nation UNION ALL SELECT r_regionkey FROM region) GROUP BY 1")
def csv_tables(spark, folder):
    """A file of separated values for each region: its header and its nations."""
    line = F.concat_ws(";", F.col("n_nationkey").cast("string"), F.concat(F.lit('"'), "n_name", F.lit(';"')), F.lit("x"))
    files = table(spark, folder, "nation").groupBy(F.col("n_regionkey").alias("doc_id")).agg(F.concat(F.lit("key;name;note\n"), F.array_join(F.sort_array(F.collect_list(line)), "\n")).alias("content"))
    cell = reader.items(files, "csv").select("doc_id", F.explode("cells").alias("c"))
    return cell.groupBy("doc_id").agg(F.count("*").alias("cells"), F.max("c.r0").cast("long").alias("last_row"))


@query("vtt_cues", "SELECT conv_id AS doc_id, count(*)::BIGINT AS cues FROM conversations WHERE turn % 5 <> 4 GROUP BY 1")
def vtt_cues(spark, folder):
    """Conversations as subtitle files with invalid cues between; the valid ones are found."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    begin, end = F.col("turn") * 2, F.when(F.col("turn") % 5 == 4, F.col("turn") * 2).otherwise(F.col("turn") * 2 + 2)
    cue = F.concat(F.lit("00:"), two(begin), F.lit(".000 --> 00:"), two(end), F.lit(".000\n<v "), "role", F.lit(">"), F.regexp_replace("text", r"\s+|-->|<|>", " "))
    files = table(spark, folder, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("c")))), lambda x: x["c"]), "\n\n")).alias("content"))
    return reader.items(files, "vtt").where("label = 'section'").groupBy("doc_id").agg(F.count("*").alias("cues"))


@query("markdown_items", "SELECT r_regionkey AS doc_id, 1::BIGINT AS titles, 1::BIGINT AS headings, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey)::BIGINT AS list_items, 1::BIGINT AS tables FROM region")
def markdown_items(spark, folder):
    """A Markdown file for each region: title, heading, list of nations, table."""
    n = table(spark, folder, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("- **"), "n_name", F.lit("**")))), "\n").alias("list"))
    files = n.join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_regionkey").alias("doc_id"), F.concat(F.lit("# "), "r_name", F.lit("\n\ntext _of_ it\n\n## Nations\n\n"), "list", F.lit("\n\n| a | b |\n|---|---|\n| 1 | 2 |\n")).alias("content"))
    n = lambda x: F.count_if(F.col("label") == x)
    return reader.items(files, "md").groupBy("doc_id").agg(n("title").alias("titles"), n("section_header").alias("headings"), n("list_item").alias("list_items"), n("table").alias("tables"))


@query("asciidoc_items", "SELECT r_regionkey AS doc_id, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey)::BIGINT AS list_items, 1::BIGINT AS captions, 1::BIGINT AS texts FROM region")
def asciidoc_items(spark, folder):
    n = table(spark, folder, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit("* "), "n_name"))), "\n").alias("list"))
    files = n.select(F.col("n_regionkey").alias("doc_id"), F.concat(F.lit("= Region\n\nsome text\nover lines\n\n== Nations\n\n"), "list", F.lit("\n\n.Numbers\n|===\n|a|b\n|1|2\n|===\n")).alias("content"))
    n = lambda x: F.count_if(F.col("label") == x)
    return reader.items(files, "asciidoc").groupBy("doc_id").agg(n("list_item").alias("list_items"), n("caption").alias("captions"), n("text").alias("texts"))
