"""Deterministic fixtures made from the plain tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.registry import table

PER_PAGE = 15
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")

CELLS = f"""cells AS (SELECT l_orderkey // {PER_PAGE} AS page,
  row_number() OVER (PARTITION BY l_orderkey // {PER_PAGE} ORDER BY {', '.join(KEY)}) - 1 AS idx,
  CASE WHEN l_partkey % 23 = 0 THEN '  ' ELSE 'w' || l_partkey END AS text, 1 - l_discount AS confidence, l_linestatus = 'F' AS from_ocr,
  (l_partkey % 500)::DOUBLE AS l, (l_suppkey % 97 * 8)::DOUBLE AS t, l_partkey % 500 + l_quantity AS r, l_suppkey % 97 * 8 + 10.0::DOUBLE AS b FROM lineitem)"""

LABELS = ("text", "section_header", "table", "picture", "list_item", "form", "formula", "code")
CLUSTERS = f"""clusters AS (SELECT o_orderkey // {PER_PAGE} AS page, o_orderkey AS cid,
  [{', '.join(f"'{x}'" for x in LABELS)}][(o_orderkey % {len(LABELS)}) + 1] AS label, (o_orderkey * 37 % 101) / 100.0::DOUBLE AS confidence,
  (o_custkey * 7 % 380)::DOUBLE AS l, (o_custkey * 13 % 700)::DOUBLE AS t,
  (o_custkey * 7 % 380 + 40 + o_custkey % 160)::DOUBLE AS r, (o_custkey * 13 % 700 + 15 + o_custkey % 90)::DOUBLE AS b FROM orders)"""


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Text cells (page, idx, text, confidence, from_ocr, l, t, r, b), about 60 a page at every scale."""
    page = F.floor(F.col("l_orderkey") / PER_PAGE)
    idx = F.row_number().over(Window.partitionBy("page").orderBy(*KEY)) - 1
    left, top = (F.col("l_partkey") % 500).cast("double"), (F.col("l_suppkey") % 97 * 8).cast("double")
    return (
        table(spark, folder, "lineitem")
        .withColumn("page", page)
        .select(
            "page", idx.cast("long").alias("idx"), F.when(F.col("l_partkey") % 23 == 0, "  ").otherwise(F.concat(F.lit("w"), F.col("l_partkey").cast("string"))).alias("text"),
            (1 - F.col("l_discount")).alias("confidence"), (F.col("l_linestatus") == "F").alias("from_ocr"),
            left.alias("l"), top.alias("t"), (left + F.col("l_quantity")).alias("r"), (top + 10.0).alias("b"),
        )
    )


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Layout clusters (page, cid, label, confidence, l, t, r, b), about 15 a page."""
    left, top = (F.col("o_custkey") * 7 % 380).cast("double"), (F.col("o_custkey") * 13 % 700).cast("double")
    return table(spark, folder, "orders").select(
        F.floor(F.col("o_orderkey") / PER_PAGE).alias("page"), F.col("o_orderkey").alias("cid"),
        F.get(F.array(*map(F.lit, LABELS)), (F.col("o_orderkey") % len(LABELS)).cast("int")).alias("label"), ((F.col("o_orderkey") * 37 % 101) / 100.0).alias("confidence"),
        left.alias("l"), top.alias("t"), (left + 40 + F.col("o_custkey") % 160).alias("r"), (top + 15 + F.col("o_custkey") % 90).alias("b"),
    )


PERTURBED = """noisy AS (SELECT doc_id, CASE doc_id % 12
  WHEN 0 THEN replace(text, ' ', chr(160)) WHEN 1 THEN 'GLYPH<1F>' || text WHEN 2 THEN replace(text, ', ', '-' || chr(10))
  WHEN 3 THEN '/a /b ' || text WHEN 4 THEN replace(text, '. ', '.' || chr(10) || chr(10)) WHEN 5 THEN replace(text, 'e', '  e')
  WHEN 6 THEN text || '____________' WHEN 7 THEN replace(text, ' ', chr(8203) || ' ' || chr(8211)) WHEN 8 THEN replace(text, '.', chr(8230) || chr(8217))
  WHEN 9 THEN 'a/b.c/d.e x a/bb.c/d.ee y a/b.c/d.e z a/b.c/d.e ' || text WHEN 10 THEN text || chr(65533) ELSE text END AS text FROM documents)"""


def perturbed(spark: SparkSession, folder: str) -> DataFrame:
    """documents with the troubles that their plain text never has, by doc_id modulo 12."""
    k, t = F.col("doc_id") % 12, F.col("text")
    put = lambda old, new: F.replace(t, F.lit(old), F.lit(new))
    noisy = [put(" ", " "), F.concat(F.lit("GLYPH<1F>"), t), put(", ", "-\n"), F.concat(F.lit("/a /b "), t), put(". ", ".\n\n"), put("e", "  e"), F.concat(t, F.lit("_" * 12)), put(" ", "​ –"), put(".", "…’"), F.concat(F.lit("a/b.c/d.e x a/bb.c/d.ee y a/b.c/d.e z a/b.c/d.e "), t), F.concat(t, F.lit("�"))]
    out = t
    for n, made in enumerate(noisy):
        out = F.when(k == n, made).otherwise(out)
    return table(spark, folder, "documents").select("doc_id", out.alias("text"))


PARTS = ("text", "text", "caption", "table", "text", "picture", "footnote", "list_item", "page_header", "text", "page_footer", "section_header", "text", "caption", "code", "text")
ENDS = (" goes on,", " ends.", " hy-", " so")
ELEMENTS = f"""elements AS (SELECT o_orderkey // {PER_PAGE} // 4 AS doc, o_orderkey // {PER_PAGE} AS page, o_orderkey AS cid, [{', '.join(f"'{x}'" for x in PARTS)}][o_orderkey * 7 % {len(PARTS)} + 1] AS label,
  (CASE WHEN o_custkey % 11 = 0 THEN 40 ELSE 40 + o_custkey % 2 * 280 END)::DOUBLE AS l, (o_custkey * 13 % 700)::DOUBLE AS t, (CASE WHEN o_custkey % 11 = 0 THEN 560 ELSE 220 + o_custkey % 2 * 280 + o_custkey % 60 END)::DOUBLE AS r, (o_custkey * 13 % 700 + 15 + o_custkey % 60)::DOUBLE AS b,
  CASE WHEN o_orderkey % 3 = 0 THEN 'and then ' ELSE 'Some ' END || o_orderkey || [{', '.join(f"'{x}'" for x in ENDS)}][o_orderkey % {len(ENDS)} + 1] AS text FROM orders)"""


def elements(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of pages in two columns, some over both: (doc, page, cid, label, l, t, r, b, text)."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    page, wide, top = F.floor(o / PER_PAGE), c % 11 == 0, (c * 13 % 700).cast("double")
    pick = lambda values, n: F.get(F.array(*map(F.lit, values)), n.cast("int"))
    return table(spark, folder, "orders").select(
        F.floor(page / 4).alias("doc"), page.alias("page"), o.alias("cid"), pick(PARTS, o * 7 % len(PARTS)).alias("label"),
        F.when(wide, 40.0).otherwise(40.0 + c % 2 * 280).alias("l"), top.alias("t"), F.when(wide, 560.0).otherwise(220.0 + c % 2 * 280 + c % 60).alias("r"), (top + 15 + c % 60).alias("b"),
        F.concat(F.when(o % 3 == 0, "and then ").otherwise("Some "), o.cast("string"), pick(ENDS, o % len(ENDS))).alias("text"),
    )


BITMAPS = f"""sizes AS (SELECT DISTINCT page, (CASE WHEN page % 7 = 0 THEN 300.5 ELSE 612 END)::DOUBLE AS width, (CASE WHEN page % 7 = 0 THEN 200 ELSE 792 END)::DOUBLE AS height FROM clusters),
bitmaps AS (SELECT page, l + 0.5 AS l, t, r + 0.5 AS r, b FROM clusters WHERE page % 3 = 1 OR label = 'picture' OR page % 7 = 0 UNION ALL SELECT page, l, t, r, b FROM cells WHERE page % 3 = 2 AND from_ocr)"""


def bitmaps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Bitmaps (page, l, t, r, b), some over the page's edge, and sizes of pages (page, width, height), some small."""
    k, c = clusters(spark, folder), cells(spark, folder)
    small = F.col("page") % 7 == 0
    sizes = k.select("page").distinct().select("page", F.when(small, 300.5).otherwise(612.0).alias("width"), F.when(small, 200.0).otherwise(792.0).alias("height"))
    some = k.where((F.col("page") % 3 == 1) | (F.col("label") == "picture") | small).select("page", (F.col("l") + 0.5).alias("l"), "t", (F.col("r") + 0.5).alias("r"), "b")
    return some.unionByName(c.where((F.col("page") % 3 == 2) & F.col("from_ocr")).select("page", *"ltrb")), sizes


TABLE_WORDS = f"""words AS (SELECT l_orderkey // {PER_PAGE} AS page, row_number() OVER (PARTITION BY l_orderkey // {PER_PAGE} ORDER BY {', '.join(KEY)}) - 1 AS idx, CASE WHEN l_partkey % 23 = 0 THEN '  ' ELSE 'w' || l_partkey END AS text,
  (40 + l_partkey % 8 * 60 + l_suppkey % 5)::DOUBLE AS l, (100 + l_suppkey % 25 * 14)::DOUBLE AS t, 40 + l_partkey % 8 * 60 + l_suppkey % 5 + CASE WHEN l_partkey % 29 = 0 THEN 200 ELSE l_quantity * 1.25 END AS r, (100 + l_suppkey % 25 * 14 + CASE WHEN l_partkey % 31 = 0 THEN 24 ELSE 11 END)::DOUBLE AS b FROM lineitem),
tables AS (SELECT page, k AS cid, (30 + k)::DOUBLE AS l, (80 + k * 180)::DOUBLE AS t, 530.0::DOUBLE AS r, CASE WHEN k = 2 THEN 446.0 ELSE 250.0 + k * 180 END::DOUBLE AS b FROM (SELECT DISTINCT page FROM words), range(3) g(k))"""


def table_words(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Words (page, idx, text, l, t, r, b) of tables and tables (page, cid, l, t, r, b), three a page, the last a thin one."""
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    left, top = (40 + p % 8 * 60 + s % 5).cast("double"), (100 + s % 25 * 14).cast("double")
    rows = table(spark, folder, "lineitem").withColumn("page", F.floor(F.col("l_orderkey") / PER_PAGE))
    words = rows.select(
        "page", (F.row_number().over(Window.partitionBy("page").orderBy(*KEY)) - 1).cast("long").alias("idx"), F.when(p % 23 == 0, "  ").otherwise(F.concat(F.lit("w"), p.cast("string"))).alias("text"),
        left.alias("l"), top.alias("t"), (left + F.when(p % 29 == 0, 200.0).otherwise(F.col("l_quantity") * 1.25)).alias("r"), (top + F.when(p % 31 == 0, 24.0).otherwise(11.0)).alias("b"),
    )
    k = F.col("cid")
    tables = rows.select("page").distinct().select("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("cid"))
    return words, tables.select("page", "cid", (30.0 + k).alias("l"), (80.0 + k * 180).alias("t"), F.lit(530.0).alias("r"), F.when(k == 2, 446.0).otherwise(250.0 + k * 180).alias("b"))
