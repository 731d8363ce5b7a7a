"""Layout post-processing per page: cells into clusters, overlaps, groups, order. Everything joins on the page first."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.functions import text as T
from vellumflow.functions.geometry import Box
from vellumflow.operators import fixtures, layout, spatial
from vellumflow.operators.layout import CHILD_OVERLAP, FULL_PAGE, LEAST_CONFIDENCE, SPECIAL, WRAPPERS, area_sql, assign, groups, labels_sql, overlaps, shared_sql
from vellumflow.registry import query, table

C, K = fixtures.CELLS, fixtures.CLUSTERS

PAGE_WIDTH, PAGE_HEIGHT = 540.0, 800.0
_special_sql, _shared, _area = labels_sql(SPECIAL), shared_sql, area_sql


def _page():
    return Window.partitionBy("page")



ASSIGNED = layout.assign_sql("clusters", "assigned")


@query("cell_cluster_assign", f"WITH {C}, {K}, {ASSIGNED} SELECT page, idx, cid, round(part, 6) AS part FROM assigned")
def cell_cluster_assign(spark, folder):
    return assign(fixtures.cells(spark, folder), fixtures.clusters(spark, folder)).withColumn("part", F.round("part", 6))


@query("unassigned_cells", f"WITH {C}, {K}, {ASSIGNED} SELECT page, idx FROM cells WHERE trim(text) <> '' AND (page, idx) NOT IN (SELECT (page, idx) FROM assigned)")
def unassigned_cells(spark, folder):
    cells = fixtures.cells(spark, folder)
    return cells.where(F.trim("text") != "").join(assign(cells, fixtures.clusters(spark, folder)), ["page", "idx"], "left_anti").select("page", "idx")


@query("orphan_clusters", f"""WITH {C}, {K}, {ASSIGNED}, m AS (SELECT page, max(cid) AS top FROM clusters GROUP BY page)
  SELECT c.page, coalesce(m.top, 0) + row_number() OVER (PARTITION BY c.page ORDER BY idx) AS cid, 'text' AS label, round(confidence, 6) AS confidence, l, t, r, b FROM cells c LEFT JOIN m ON c.page = m.page
  WHERE trim(c.text) <> '' AND (c.page, idx) NOT IN (SELECT (page, idx) FROM assigned)""")
def orphan_clusters(spark, folder):
    """A text cluster for each cell that has none, numbered on from the page's largest number."""
    cells, clusters = fixtures.cells(spark, folder), fixtures.clusters(spark, folder)
    top = clusters.groupBy("page").agg(F.max("cid").alias("top"))
    free = cells.where(F.trim("text") != "").join(assign(cells, clusters), ["page", "idx"], "left_anti").join(top, "page", "left")
    return free.select("page", (F.coalesce("top", F.lit(0)) + F.row_number().over(_page().orderBy("idx"))).alias("cid"), F.lit("text").alias("label"), F.round("confidence", 6).alias("confidence"), *"ltrb")


_values = ", ".join(f"('{k}', {v})" for k, v in LEAST_CONFIDENCE.items())


@query("label_threshold_filter", f"WITH {K}, least_of(label, least_confidence) AS (VALUES {_values}) SELECT page, cid, label, confidence FROM clusters JOIN least_of USING (label) WHERE confidence >= least_confidence")
def label_threshold_filter(spark, folder):
    least = F.create_map(*(F.lit(x) for kv in LEAST_CONFIDENCE.items() for x in kv))
    return fixtures.clusters(spark, folder).where(F.col("confidence") >= least[F.col("label")]).select("page", "cid", "label", "confidence")


@query("empty_cluster_filter", f"WITH {C}, {K}, {ASSIGNED} SELECT page, cid, label FROM clusters WHERE label = 'formula' OR (page, cid) IN (SELECT (page, cid) FROM assigned)")
def empty_cluster_filter(spark, folder):
    """Clusters that hold a cell; formulas stay anyway."""
    clusters = fixtures.clusters(spark, folder)
    full = assign(fixtures.cells(spark, folder), clusters).select("page", "cid").distinct().withColumn("full", F.lit(True))
    return clusters.join(full, ["page", "cid"], "left").where((F.col("label") == "formula") | F.col("full")).select("page", "cid", "label")


@query("full_page_pictures", f"WITH {K} SELECT page, cid FROM clusters k WHERE NOT (label = 'picture' AND {_area('k')} * 30 / {PAGE_WIDTH * PAGE_HEIGHT} > {FULL_PAGE})")
def full_page_pictures(spark, folder):
    """Without pictures that fill the page (boxes are magnified here, so that some do)."""
    return fixtures.clusters(spark, folder).where(~((F.col("label") == "picture") & (Box.of().area() * 30 / (PAGE_WIDTH * PAGE_HEIGHT) > FULL_PAGE))).select("page", "cid")


def children(clusters):
    return layout.children(clusters.where(F.col("label").isin(*SPECIAL)), clusters.where(~F.col("label").isin(*SPECIAL)))


CHILDREN = f"children AS (SELECT r.page, s.cid AS special, s.label AS s_label, s.l AS s_l, s.t AS s_t, s.r AS s_r, s.b AS s_b, r.* EXCLUDE (page) FROM clusters r JOIN clusters s ON r.page = s.page WHERE r.label NOT IN {_special_sql} AND s.label IN {_special_sql} AND {_shared('r', 's')} / {_area('r')} > {CHILD_OVERLAP})"


@query("special_children", f"WITH {K}, {CHILDREN} SELECT page, special, cid FROM children")
def special_children(spark, folder):
    return children(fixtures.clusters(spark, folder)).select("page", "special", "cid")


@query("adopted_cluster_removal", f"WITH {K}, {CHILDREN} SELECT page, cid FROM clusters WHERE (page, cid) NOT IN (SELECT (page, cid) FROM children)")
def adopted_cluster_removal(spark, folder):
    clusters = fixtures.clusters(spark, folder)
    return clusters.join(children(clusters), ["page", "cid"], "left_anti").select("page", "cid")


@query("form_bounds", f"WITH {K}, {CHILDREN} SELECT page, special AS cid, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM children WHERE s_label IN ('form', 'key_value_region') GROUP BY page, special")
def form_bounds(spark, folder):
    """Forms and key-value regions are as large as what they hold."""
    held = children(fixtures.clusters(spark, folder)).where(F.col("s_label").isin("form", "key_value_region"))
    return held.groupBy("page", F.col("special").alias("cid")).agg(F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))


SAME = layout.overlaps_sql("clusters", "same")
GROUPS = layout.groups_sql("same", "grouped")


@query("cluster_overlap_pairs", f"WITH {K}, {SAME} SELECT page, x, y FROM same")
def cluster_overlap_pairs(spark, folder):
    return overlaps(fixtures.clusters(spark, folder))


def grouped(clusters):
    """(page, cid, grp) of all clusters: connected groups of overlapping ones; the others stand alone."""
    return clusters.join(groups(overlaps(clusters)), ["page", "cid"], "left").select(*clusters.columns, F.coalesce("grp", "cid").alias("grp"))


@query("cluster_components", f"WITH RECURSIVE {K}, {SAME}, {GROUPS} SELECT k.page, k.cid, coalesce(g.grp, k.cid) AS grp FROM clusters k LEFT JOIN grouped g ON g.page = k.page AND g.cid = k.cid")
def cluster_components(spark, folder):
    return grouped(fixtures.clusters(spark, folder)).select("page", "cid", "grp")


@query("cluster_best", f"""WITH RECURSIVE {K}, {SAME}, {GROUPS}, members AS (SELECT k.*, coalesce(g.grp, k.cid) AS grp FROM clusters k LEFT JOIN grouped g ON g.page = k.page AND g.cid = k.cid), {layout.chosen_sql('members', 'regular', 'best')}
  SELECT b.page, b.cid, b.n::BIGINT AS members, k.label FROM best b JOIN clusters k ON k.page = b.page AND k.cid = b.cid""")
def cluster_best(spark, folder):
    """The cluster that stands for each group."""
    rows = fixtures.clusters(spark, folder)
    return layout.chosen(grouped(rows), "regular").join(rows.select("page", "cid", "label"), ["page", "cid"]).select("page", "cid", F.col("n").alias("members"), "label")


def _kinds():
    return ("picture", ("picture",)), ("wrapper", WRAPPERS)


_of_kind = lambda kind, labels: f"{kind}s AS (SELECT * FROM clusters WHERE label IN {labels_sql(labels)}), {layout.overlaps_sql(f'{kind}s', f'{kind}_pairs')}, {layout.groups_sql(f'{kind}_pairs', f'{kind}_groups')}, {kind}_members AS (SELECT k.*, g.grp FROM {kind}s k JOIN {kind}_groups g ON g.page = k.page AND g.cid = k.cid), {layout.chosen_sql(f'{kind}_members', kind, f'{kind}_best')}"


@query("special_best", f"WITH RECURSIVE {K}, {', '.join(_of_kind(*x) for x in _kinds())} " + " UNION ALL ".join(f"SELECT '{kind}' AS kind, page, grp, cid, n FROM {kind}_best" for kind, _ in _kinds()))
def special_best(spark, folder):
    """Who stands for each group of overlapping pictures and of overlapping wrappers, each by the thresholds of its kind."""
    rows, parts = fixtures.clusters(spark, folder), []
    for kind, labels in _kinds():
        own = rows.where(F.col("label").isin(*labels))
        parts.append(layout.chosen(own.join(groups(overlaps(own)), ["page", "cid"]), kind).select(F.lit(kind).alias("kind"), "page", "grp", "cid", "n"))
    return parts[0].unionByName(parts[1])


@query("cross_type_overlaps", f"WITH {K} SELECT page, cid FROM clusters w WHERE label IN {labels_sql(WRAPPERS)} AND NOT EXISTS (SELECT 1 FROM clusters t WHERE t.page = w.page AND t.cid <> w.cid AND t.label = 'table' AND {_shared('w', 't')} / {_area('w')} > {layout.TABLE_OVERLAP} AND w.confidence - t.confidence < {layout.TABLE_GAP})")
def cross_type_overlaps(spark, folder):
    """Wrappers without those that are nearly all inside a table and not clearly more confident."""
    rows = fixtures.clusters(spark, folder)
    wrappers = rows.where(F.col("label").isin(*WRAPPERS))
    return wrappers.join(layout.like_tables(wrappers, rows.where("label = 'table'")), ["page", "cid"], "left_anti").select("page", "cid")


@query("layout_postprocess", layout.postprocess_sql(PAGE_WIDTH * PAGE_HEIGHT, f"{C}, {K}"))
def layout_postprocess(spark, folder):
    """The whole chain from cells and clusters to the final ones in their order."""
    return layout.postprocess(fixtures.cells(spark, folder), fixtures.clusters(spark, folder), PAGE_WIDTH * PAGE_HEIGHT)


@query("cluster_bounds", f"""WITH {C}, {K}, {ASSIGNED}, u AS (SELECT a.page, a.cid, min(c.l) AS l, min(c.t) AS t, max(c.r) AS r, max(c.b) AS b FROM assigned a JOIN cells c ON a.page = c.page AND a.idx = c.idx GROUP BY a.page, a.cid)
  SELECT k.page, k.cid, CASE WHEN label = 'table' THEN least(k.l, u.l) ELSE u.l END AS l, CASE WHEN label = 'table' THEN least(k.t, u.t) ELSE u.t END AS t,
  CASE WHEN label = 'table' THEN greatest(k.r, u.r) ELSE u.r END AS r, CASE WHEN label = 'table' THEN greatest(k.b, u.b) ELSE u.b END AS b FROM clusters k JOIN u ON k.page = u.page AND k.cid = u.cid""")
def cluster_bounds(spark, folder):
    """Boxes shrink or grow to the cells they hold; a table never shrinks."""
    cells, clusters = fixtures.cells(spark, folder), fixtures.clusters(spark, folder)
    held = assign(cells, clusters).select("page", "idx", "cid")
    full = clusters.join(held, ["page", "cid"], "left_semi")
    return layout.fitted(full, held, cells).select("page", "cid", *"ltrb")


@query("cluster_sort", f"""WITH {C}, {K}, {ASSIGNED}, f AS (SELECT page, cid, min(idx) AS first FROM assigned GROUP BY page, cid)
  SELECT k.page, k.cid, row_number() OVER (PARTITION BY k.page ORDER BY coalesce(first, 2147483647), t, l, k.cid)::INTEGER AS by_id, row_number() OVER (PARTITION BY k.page ORDER BY t, l, k.cid)::INTEGER AS tblr,
  row_number() OVER (PARTITION BY k.page ORDER BY l, t, k.cid)::INTEGER AS lrtb FROM clusters k LEFT JOIN f ON k.page = f.page AND k.cid = f.cid""")
def cluster_sort(spark, folder):
    """Places of the clusters in the three reading orders."""
    clusters = fixtures.clusters(spark, folder)
    first = assign(fixtures.cells(spark, folder), clusters).groupBy("page", "cid").agg(F.min("idx").alias("first"))
    place = lambda *by: F.row_number().over(_page().orderBy(*by, "cid"))
    rows = clusters.join(first, ["page", "cid"], "left").withColumn("first", F.coalesce("first", F.lit(2147483647)))
    return rows.select("page", "cid", place("first", "t", "l").alias("by_id"), place("t", "l").alias("tblr"), place("l", "t").alias("lrtb"))


@query("ocr_anti_join", f"WITH {C} SELECT page, idx FROM cells o WHERE from_ocr AND NOT EXISTS (SELECT 1 FROM cells p WHERE p.page = o.page AND NOT p.from_ocr AND o.l <= p.r AND o.r >= p.l AND o.t <= p.b AND o.b >= p.t)")
def ocr_anti_join(spark, folder):
    """Recognised cells that touch no printed one."""
    cells = fixtures.cells(spark, folder)
    printed = cells.where(~F.col("from_ocr")).select(F.col("page").alias("p_page"), *(F.col(x).alias(f"p_{x}") for x in "ltrb"))
    return cells.where("from_ocr").join(printed, (F.col("page") == F.col("p_page")) & Box.of().touches(Box.of("p_")), "left_anti").select("page", "idx")


@query("ocr_union_reindex", f"WITH {C} SELECT page, idx AS old, row_number() OVER (PARTITION BY page ORDER BY from_ocr, idx) - 1 AS idx FROM cells")
def ocr_union_reindex(spark, folder):
    """Printed cells, then recognised ones, numbered anew."""
    cells = fixtures.cells(spark, folder)
    both = cells.where(~F.col("from_ocr")).unionByName(cells.where("from_ocr"))
    return both.select("page", F.col("idx").alias("old"), (F.row_number().over(_page().orderBy("from_ocr", "idx")) - 1).cast("long").alias("idx"))


@query("text_in_rect", f"WITH {C}, {K} SELECT k.page, k.cid, sha256(string_agg(c.text, ' ' ORDER BY c.idx)) AS text_sha, count(*)::BIGINT AS n FROM clusters k JOIN cells c ON k.page = c.page WHERE {_shared('c', 'k')} / {_area('c')} > 0.5 GROUP BY k.page, k.cid")
def text_in_rect(spark, folder):
    cells = fixtures.cells(spark, folder)
    rect = fixtures.clusters(spark, folder).select("page", "cid", *(F.col(x).alias(f"k_{x}") for x in "ltrb"))
    hits = cells.join(rect, "page").where(Box.of().overlaps(Box.of("k_"))).where(Box.of().inside(Box.of("k_")) > 0.5)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ")
    return hits.groupBy("page", "cid").agg(F.sha2(text, 256).alias("text_sha"), F.count("*").alias("n"))


DENSE = 40


@query("dense_page_overlaps", f"""WITH {C}, {K}, few AS (SELECT * FROM clusters WHERE label = 'text') SELECT k.page // {DENSE} AS page, k.cid, count(*)::BIGINT AS n, sum({_shared('c', 'k')})::DOUBLE AS shared FROM few k JOIN cells c ON k.page // {DENSE} = c.page // {DENSE} AND c.l < k.r AND c.r > k.l AND c.t < k.b AND c.b > k.t GROUP BY ALL""")
def dense_page_overlaps(spark, folder):
    """Clusters with the cells that they meet, on pages of thousands of cells: joined tile by tile."""
    page = F.floor(F.col("page") / DENSE)
    cells = fixtures.cells(spark, folder).withColumn("page", page)
    few = fixtures.clusters(spark, folder).where("label = 'text'").select(page.alias("page"), "cid", *(F.col(x).alias(f"k_{x}") for x in "ltrb"))
    return spatial.meeting(cells, few, "k_").groupBy("page", "cid").agg(F.count("*").alias("n"), F.sum(Box.of().shared(Box.of("k_"))).alias("shared"))


@query("interval_stabbing", f"WITH {K} SELECT a.page, a.cid, count(*)::BIGINT AS holders FROM clusters a JOIN clusters b ON a.page = b.page AND a.cid <> b.cid AND (a.l + a.r) / 2 BETWEEN b.l AND b.r GROUP BY a.page, a.cid")
def interval_stabbing(spark, folder):
    """How many others' horizontal intervals contain a cluster's middle."""
    a = fixtures.clusters(spark, folder)
    b = a.select("page", F.col("cid").alias("o"), F.col("l").alias("lo"), F.col("r").alias("hi"))
    return a.join(b, "page").where((F.col("cid") != F.col("o")) & ((F.col("l") + F.col("r")) / 2).between(F.col("lo"), F.col("hi"))).groupBy("page", "cid").agg(F.count("*").alias("holders"))


@query("box_metrics", f"""WITH {K} SELECT p.page, p.cid, round({_shared('p', 'q')}, 6) AS shared, round({_shared('p', 'q')} / {_area('p')}, 6) AS part, round({_shared('p', 'q')} / ({_area('p')} + {_area('q')} - {_shared('p', 'q')}), 6) AS iou
  FROM clusters p JOIN clusters q ON p.page = q.page AND q.cid = p.cid + 1""")
def box_metrics(spark, folder):
    a = fixtures.clusters(spark, folder)
    b = a.select("page", (F.col("cid") - 1).alias("cid"), *(F.col(x).alias(f"q_{x}") for x in "ltrb"))
    p, q = Box.of(), Box.of("q_")
    return a.join(b, ["page", "cid"]).select("page", "cid", F.round(p.shared(q), 6).alias("shared"), F.round(p.inside(q), 6).alias("part"), F.round(p.iou(q), 6).alias("iou"))


@query("bbox_rotate", f"""WITH {K}, a AS (SELECT *, (cid % 4) * 90 AS angle, {PAGE_WIDTH}::DOUBLE AS w, {PAGE_HEIGHT}::DOUBLE AS h FROM clusters) SELECT page, cid,
  CASE angle WHEN 0 THEN l WHEN 90 THEN t WHEN 180 THEN w - r ELSE h - b END AS l, CASE angle WHEN 0 THEN t WHEN 90 THEN w - r WHEN 180 THEN h - b ELSE l END AS t,
  CASE angle WHEN 0 THEN r WHEN 90 THEN b WHEN 180 THEN w - l ELSE h - t END AS r, CASE angle WHEN 0 THEN b WHEN 90 THEN w - l WHEN 180 THEN h - t ELSE r END AS b FROM a""")
def bbox_rotate(spark, folder):
    box = Box.of().rotated(F.col("cid") % 4 * 90, F.lit(PAGE_WIDTH), F.lit(PAGE_HEIGHT))
    return fixtures.clusters(spark, folder).select("page", "cid", *box.columns())


@query("bbox_expand_scale_flip", f"WITH {K} SELECT page, cid, round(l - (r - l) * 0.1, 6) AS gl, round(b + (b - t) * 0.1, 6) AS gb, round(l / {PAGE_WIDTH}, 6) AS nl, round(b / {PAGE_HEIGHT}, 6) AS nb, {PAGE_HEIGHT} - b AS ft, {PAGE_HEIGHT} - t AS fb FROM clusters")
def bbox_expand_scale_flip(spark, folder):
    box = Box.of()
    g, n, f = box.grown(0.1), box.scaled(1 / PAGE_WIDTH, 1 / PAGE_HEIGHT), box.flipped(F.lit(PAGE_HEIGHT))
    return fixtures.clusters(spark, folder).select("page", "cid", F.round(g.l, 6).alias("gl"), F.round(g.b, 6).alias("gb"), F.round(n.l, 6).alias("nl"), F.round(n.b, 6).alias("nb"), f.t.alias("ft"), f.b.alias("fb"))


@query("script_and_orientation", "SELECT DISTINCT lang, CASE lang WHEN 'en' THEN 'Latin' WHEN 'fr' THEN 'HanS' WHEN 'de' THEN 'Japanese' ELSE 'Hangul' END AS script, (360 - (doc_id % 4) * 90) % 360 AS angle FROM documents")
def script_and_orientation(spark, folder):
    """Script names as trained data is named, clockwise page turns as counter-clockwise angles."""
    raw = F.when(F.col("lang") == "en", "Latin").when(F.col("lang") == "fr", "Han").when(F.col("lang") == "de", "Katakana").otherwise("Korean")
    return table(spark, folder, "documents").select("lang", T.script_name(raw).alias("script"), T.page_turn(F.col("doc_id") % 4 * 90).alias("angle")).distinct()


@query("picture_area_threshold", f"WITH {K} SELECT page, cid, round({_area('k')} / {PAGE_WIDTH * PAGE_HEIGHT}, 6) AS part FROM clusters k WHERE label = 'picture' AND {_area('k')} / {PAGE_WIDTH * PAGE_HEIGHT} >= 0.01")
def picture_area_threshold(spark, folder):
    """Pictures that take enough of their page to be described."""
    part = Box.of().area() / (PAGE_WIDTH * PAGE_HEIGHT)
    return fixtures.clusters(spark, folder).where((F.col("label") == "picture") & (part >= 0.01)).select("page", "cid", F.round(part, 6).alias("part"))


@query("page_dimensions", f"WITH {C} SELECT page, max(r) - min(l) AS width, max(b) - min(t) AS height FROM cells GROUP BY page")
def page_dimensions(spark, folder):
    return fixtures.cells(spark, folder).groupBy("page").agg((F.max("r") - F.min("l")).alias("width"), (F.max("b") - F.min("t")).alias("height"))


@query("layout_elements", f"""WITH {C}, {K}, {ASSIGNED} SELECT k.page, k.cid, CASE WHEN label IN ('table', 'document_index') THEN 'table' WHEN label = 'picture' THEN 'figure' WHEN label IN ('form', 'key_value_region') THEN 'container' ELSE 'text' END AS kind, count(a.idx)::BIGINT AS n_cells
  FROM clusters k LEFT JOIN assigned a ON k.page = a.page AND k.cid = a.cid GROUP BY ALL""")
def layout_elements(spark, folder):
    """Clusters as elements: tables and figures keep their row even if no structure or class was predicted."""
    cells, clusters = fixtures.cells(spark, folder), fixtures.clusters(spark, folder)
    kind = F.when(F.col("label").isin("table", "document_index"), "table").when(F.col("label") == "picture", "figure").when(F.col("label").isin("form", "key_value_region"), "container").otherwise("text")
    return clusters.join(assign(cells, clusters).select("page", "cid", "idx"), ["page", "cid"], "left").groupBy("page", "cid", kind.alias("kind")).agg(F.count("idx").alias("n_cells"))


@query("element_text", f"""WITH {C}, {K}, {ASSIGNED} SELECT a.page, a.cid, sha256(string_agg(c.text, ' ' ORDER BY c.idx)) AS text_sha FROM assigned a JOIN cells c ON a.page = c.page AND a.idx = c.idx GROUP BY a.page, a.cid""")
def element_text(spark, folder):
    cells = fixtures.cells(spark, folder)
    held = assign(cells, fixtures.clusters(spark, folder)).select("page", "idx", "cid").join(cells.select("page", "idx", "text"), ["page", "idx"])
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ")
    return held.groupBy("page", "cid").agg(F.sha2(text, 256).alias("text_sha"))
