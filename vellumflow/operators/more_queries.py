"""Further operators: lookups, prompts, triplets, coverage, reading order, replacements, merges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.functions.geometry import Box
from vellumflow.operators import fixtures
from vellumflow.operators.layout_queries import PAGE_HEIGHT, PAGE_WIDTH
from vellumflow.plans.options import OcrOptions
from vellumflow.registry import query, table
from vellumflow.sources.formats import EXTENSIONS, MEDIA_TYPES

C, K = fixtures.CELLS, fixtures.CLUSTERS

# Labels of one layout vocabulary and what they are called in the other.
LAYOUT_LABELS = {
    "title": "title", "table-of-contents": "document_index", "subtitle-level-1": "section_header", "checkbox-selected": "checkbox_selected", "checkbox-unselected": "checkbox_unselected", "caption": "caption",
    "page-header": "page_header", "page-footer": "page_footer", "footnote": "footnote", "table": "table", "formula": "formula", "list-item": "list_item", "code": "code", "figure": "picture", "picture": "picture",
    "reference": "text", "paragraph": "text", "text": "text",
}
_names = list(LAYOUT_LABELS)
_label_values = ", ".join(f"({k}, '{a}', '{b}')" for k, (a, b) in enumerate(LAYOUT_LABELS.items()))


@query("layout_label_map", f"WITH m(k, a, b) AS (VALUES {_label_values}) SELECT b AS label, count(*)::BIGINT AS n FROM part JOIN m ON p_partkey % {len(_names)} = k GROUP BY b")
def layout_label_map(spark, folder):
    given = F.get(F.array(*map(F.lit, _names)), (F.col("p_partkey") % len(_names)).cast("int"))
    mapped = F.create_map(*(F.lit(x) for kv in LAYOUT_LABELS.items() for x in kv))
    return table(spark, folder, "part").groupBy(mapped[given].alias("label")).agg(F.count("*").alias("n"))


_media = [(m, f) for f, ms in MEDIA_TYPES.items() for m in ms]
_ext = [(x, f) for f, xs in EXTENSIONS.items() for x in xs]


@query("media_type_lookup", "SELECT media, string_agg(format, ',' ORDER BY format) AS formats FROM (VALUES " + ", ".join(f"('{m}', '{f}')" for m, f in _media) + ") t(media, format) GROUP BY media")
def media_type_lookup(spark, folder):
    """The formats that a media type may be; one type may be several."""
    return spark.createDataFrame(_media, "media string, format string").groupBy("media").agg(F.array_join(F.sort_array(F.collect_list("format")), ",").alias("formats"))


@query("extension_filter", "SELECT page_id, CASE WHEN page_id % 40 < " + str(len(_ext)) + " THEN ([" + ", ".join(f"'{f}'" for _, f in _ext) + "])[page_id % 40 + 1] END AS format FROM pages")
def extension_filter(spark, folder):
    """Files of a folder by their extension (either case), unknown ones null."""
    name = F.concat(F.col("page_id").cast("string"), F.lit("."), F.upper(F.coalesce(F.try_element_at(F.array(*(F.lit(x) for x, _ in _ext)), (F.col("page_id") % 40 + 1).cast("int")), F.lit("none"))))
    place = F.create_map(*(F.lit(v) for kv in {x: f for x, f in reversed(_ext)}.items() for v in kv))
    order = F.get(F.array(*(F.lit(f) for _, f in _ext)), (F.col("page_id") % 40).cast("int"))
    known = place[F.lower(F.regexp_extract("name", r"^[^.]+\.(.+)$", 1))].isNotNull()
    return table(spark, folder, "pages").withColumn("name", name).select("page_id", F.when(known, order).alias("format"))


@query("layout_prompt", f"""WITH {K} SELECT page, sha256('<layout>' || string_agg('<' || label || '><loc_' || floor(l / {PAGE_WIDTH} * 500)::BIGINT || '><loc_' || floor(t / {PAGE_HEIGHT} * 500)::BIGINT || '><loc_' || floor(r / {PAGE_WIDTH} * 500)::BIGINT || '><loc_' || floor(b / {PAGE_HEIGHT} * 500)::BIGINT || '>', chr(10) ORDER BY cid) || '</layout>') AS prompt_sha, count(*)::BIGINT AS n FROM clusters GROUP BY page""")
def layout_prompt(spark, folder):
    """A page's clusters as tags with places on a grid of 500, put to a model's prompt."""
    at = lambda c, size: F.concat(F.lit("<loc_"), F.floor(F.col(c) / size * 500).cast("string"), F.lit(">"))
    line = F.concat(F.lit("<"), "label", F.lit(">"), at("l", PAGE_WIDTH), at("t", PAGE_HEIGHT), at("r", PAGE_WIDTH), at("b", PAGE_HEIGHT))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cid", line.alias("x")))), lambda x: x["x"]), "\n")
    return fixtures.clusters(spark, folder).groupBy("page").agg(F.sha2(F.concat(F.lit("<layout>"), body, F.lit("</layout>")), 256).alias("prompt_sha"), F.count("*").alias("n"))


@query("table_triplets", "SELECT n_nationkey AS row, 'n_name' AS col, n_name || ', n_name = ' || n_name AS triplet FROM nation UNION ALL SELECT n_nationkey, 'n_regionkey', n_name || ', n_regionkey = ' || n_regionkey FROM nation")
def table_triplets(spark, folder):
    """Table cells as sentences: the row's name, the column's, the value."""
    n = table(spark, folder, "nation")
    cells = F.array(*(F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in ("n_name", "n_regionkey")))
    return n.select(F.col("n_nationkey").alias("row"), "n_name", F.explode(cells).alias("c")).select("row", "c.col", F.concat("n_name", F.lit(", "), "c.col", F.lit(" = "), "c.v").alias("triplet"))


@query("ocr_confidence_filter", f"WITH {C} SELECT page, count(*)::BIGINT AS kept FROM cells WHERE from_ocr AND confidence >= 0.95 AND trim(text) <> '' AND (r - l) * (b - t) > 0 GROUP BY page")
def ocr_confidence_filter(spark, folder):
    """Recognised cells that are sure enough, not blank and not empty."""
    return fixtures.cells(spark, folder).where(F.col("from_ocr") & (F.col("confidence") >= 0.95) & (F.trim("text") != "") & (Box.of().area() > 0)).groupBy("page").agg(F.count("*").alias("kept"))


#: The grid on which coverage is measured: units of a cell, rows, columns, columns in a word of bits.
UNIT, ROWS, COLUMNS, WORD = 4, int(PAGE_HEIGHT) // 4, int(PAGE_WIDTH) // 4, 45


@query("bitmap_coverage", f"""WITH {K}, p AS (SELECT page, greatest(floor(l / {UNIT}), 0)::BIGINT AS c0, least(ceil(r / {UNIT}), {COLUMNS})::BIGINT AS c1, greatest(floor(t / {UNIT}), 0)::BIGINT AS r0, least(ceil(b / {UNIT}), {ROWS})::BIGINT AS r1 FROM clusters WHERE label = 'picture'),
  y AS (SELECT page, c0, c1, unnest(range(r0, r1)) AS y FROM p), x AS (SELECT DISTINCT page, y, unnest(range(c0, c1)) AS x FROM y)
  SELECT page, count(*) / {ROWS * COLUMNS}::DOUBLE AS part, count(*) / {ROWS * COLUMNS}::DOUBLE > {OcrOptions().bitmap_area_threshold} AS ocr FROM x GROUP BY page""")
def bitmap_coverage(spark, folder):
    """The part of each page that its pictures cover together (overlaps once), on a grid; more than a twentieth asks for OCR.
    Each grid row of a picture is a few words of bits, and rows are united by bit_or."""
    low = lambda c: F.greatest(F.floor(F.col(c) / UNIT), F.lit(0))
    high = lambda c, n: F.least(F.ceil(F.col(c) / UNIT), F.lit(n))
    rows = fixtures.clusters(spark, folder).where("label = 'picture'").select("page", low("l").alias("c0"), high("r", COLUMNS).alias("c1"), low("t").alias("r0"), high("b", ROWS).alias("r1")).where("c0 < c1 AND r0 < r1")
    rows = rows.select("page", "c0", "c1", F.explode(F.sequence("r0", F.col("r1") - 1)).alias("y"))
    within = lambda c, w: F.least(F.greatest(F.col(c) - w * WORD, F.lit(0)), F.lit(WORD)).cast("int")
    bits = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), within("c1", w)) - F.call_function("shiftleft", F.lit(1).cast("long"), within("c0", w))
    united = rows.groupBy("page", "y").agg(*(F.bit_or(bits(w)).alias(f"w{w}") for w in range(COLUMNS // WORD)))
    part = F.sum(sum(F.bit_count(f"w{w}") for w in range(COLUMNS // WORD))) / (ROWS * COLUMNS)
    return united.groupBy("page").agg(part.alias("part")).withColumn("ocr", F.col("part") > OcrOptions().bitmap_area_threshold)


@query("longest_first_replacement", "SELECT c_custkey, replace(replace(c_name || ' of Customer', c_name, 'person-1'), 'Customer', 'word-1') AS text FROM customer")
def longest_first_replacement(spark, folder):
    """Names are replaced longest first, so that a short one never breaks a long one."""
    text = F.concat("c_name", F.lit(" of Customer"))
    pairs = F.array_sort(F.array(F.struct((-F.length("c_name")).alias("n"), F.col("c_name").alias("old"), F.lit("person-1").alias("new")), F.struct(F.lit(-8).alias("n"), F.lit("Customer").alias("old"), F.lit("word-1").alias("new"))))
    return table(spark, folder, "customer").select("c_custkey", F.aggregate(pairs, text, lambda acc, x: F.replace(acc, x["old"], x["new"])).alias("text"))


@query("nulls_last_order", "SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END NULLS LAST, event_id)::INTEGER AS place FROM events")
def nulls_last_order(spark, folder):
    """Text boxes by position, those without one last."""
    v = F.when(F.col("event_id") % 3 != 0, F.col("value"))
    return table(spark, folder, "events").select("event_id", F.row_number().over(Window.partitionBy("user_id").orderBy(v.asc_nulls_last(), "event_id")).alias("place"))


@query("first_seen_dedup", "SELECT l_partkey, l_suppkey, min(l_orderkey) AS first FROM lineitem GROUP BY ALL")
def first_seen_dedup(spark, folder):
    """Texts at one place once, at their first."""
    return table(spark, folder, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.min("l_orderkey").alias("first"))


@query("candidate_intersection", f"WITH {K} SELECT page, cid FROM clusters WHERE confidence > 0.3 INTERSECT SELECT page, cid FROM clusters WHERE label <> 'table'")
def candidate_intersection(spark, folder):
    k = fixtures.clusters(spark, folder)
    return k.where("confidence > 0.3").select("page", "cid").intersect(k.where("label <> 'table'").select("page", "cid"))


@query("token_usage", "SELECT conv_id, sum(len(string_split(text, ' ')))::BIGINT AS tokens, count(*)::BIGINT AS calls FROM conversations GROUP BY conv_id")
def token_usage(spark, folder):
    return table(spark, folder, "conversations").groupBy("conv_id").agg(F.sum(F.size(F.split("text", " "))).alias("tokens"), F.count("*").alias("calls"))


@query("citation_flatten", "SELECT p_partkey, rtrim(p_name, '.') || '. ' || p_brand || ' (' || p_size || ')' || CASE WHEN p_partkey % 2 = 0 THEN ' ' || p_type ELSE '' END AS citation FROM part")
def citation_flatten(spark, folder):
    """The parts of a reference in one line, without empty ones and double stops."""
    tail = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))
    return table(spark, folder, "part").select("p_partkey", F.concat(F.rtrim(F.col("p_name"), F.lit(".")), F.lit(". "), F.concat_ws(" ", "p_brand", F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")")), tail)).alias("citation"))
