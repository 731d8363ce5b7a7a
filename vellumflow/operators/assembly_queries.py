"""Pages put together: regions to recognise, reading order, captions and footnotes, merged texts, tables out of words."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumflow import scratch
from vellumflow.operators import fixtures, order, regions, tables
from vellumflow.plans import chunk, multimodal, serialize
from vellumflow.registry import query

E = fixtures.ELEMENTS
PLACES = order.reading_order_sql("elements", "places")
ORDERED = f"{PLACES},\nordered AS (SELECT e.*, place FROM elements e JOIN places USING (page, cid))"
OWNED = f"{order.captions_sql('elements', 'capped')},\n{order.footnotes_sql('ordered', 'noted')},\n{order.merges_sql('ordered', 'merged')}"


def _ordered(spark, folder):
    return order.ordered(fixtures.elements(spark, folder))


@query("ocr_regions", regions.ocr_regions_sql(f"{fixtures.CELLS}, {fixtures.CLUSTERS}, {fixtures.BITMAPS}"))
def ocr_regions(spark, folder):
    """Where a page's bitmaps ask for recognition: the whole page, merged regions, or nowhere."""
    return regions.ocr_regions(*fixtures.bitmaps(spark, folder))


@query("precedence", f"WITH {E}, {order.precedence_sql('elements', 'seen')} SELECT page, cid, above FROM seen")
def precedence(spark, folder):
    """What each element sees directly above it."""
    return order.precedence(fixtures.elements(spark, folder))


@query("reading_order", f"WITH RECURSIVE {E}, {PLACES} SELECT page, cid, place FROM places")
def reading_order(spark, folder):
    """Places of elements: a column to its end before the next one, furniture first and last."""
    return order.reading_order(fixtures.elements(spark, folder))


@query("caption_mapping", f"WITH RECURSIVE {E}, {order.captions_sql('elements', 'capped')} SELECT e.page, e.cid, coalesce(c.cid, -1) AS cap FROM elements e LEFT JOIN capped c ON c.page = e.page AND c.owner = e.cid WHERE (e.page, e.cid) NOT IN (SELECT (page, cid) FROM capped)")
def caption_mapping(spark, folder):
    """Elements with the caption that belongs to them; captions that are taken do not stand alone."""
    rows = fixtures.elements(spark, folder)
    taken = order.captions(rows)
    alone = rows.join(taken.select("page", "cid"), ["page", "cid"], "left_anti")
    return alone.join(taken.select("page", F.col("cid").alias("cap"), F.col("owner").alias("cid")), ["page", "cid"], "left").select("page", "cid", F.coalesce("cap", F.lit(-1)).alias("cap"))


@query("footnote_owners", f"WITH RECURSIVE {E}, {ORDERED}, {order.footnotes_sql('ordered', 'noted')} SELECT page, cid, owner FROM noted")
def footnote_owners(spark, folder):
    """Footnotes with the table or picture that they follow."""
    return order.footnotes(_ordered(spark, folder))


@query("text_merge_spans", f"WITH RECURSIVE {E}, {ORDERED}, {order.merges_sql('ordered', 'merged')} SELECT * FROM merged")
def text_merge_spans(spark, folder):
    """Texts that go on over columns and pages: the text that each is a part of, and where it stands in it."""
    return order.merges(order.ordered(order.text_ends(fixtures.elements(spark, folder)).drop("text")))


ITEMS = f"""{ORDERED}, {OWNED},
  joined AS (SELECT head_page AS page, head AS cid, string_agg(e.text, ' ' ORDER BY m.first) AS text, string_agg(m.page || ':' || m.cid || ':' || m.first || '-' || m.last, ',' ORDER BY m.first) AS parts FROM merged m JOIN elements e ON e.page = m.page AND e.cid = m.cid GROUP BY head_page, head),
  caps AS (SELECT page, owner, list(cid ORDER BY cid) AS cids FROM capped GROUP BY page, owner), notes AS (SELECT page, owner, list(cid ORDER BY cid) AS cids FROM noted GROUP BY page, owner),
  items AS (SELECT o.doc, row_number() OVER (PARTITION BY o.doc ORDER BY o.page, place)::INTEGER AS ord, o.page, o.cid, label, CASE WHEN label IN ('page_header', 'page_footer') THEN 'furniture' ELSE 'body' END AS layer, coalesce(j.text, o.text) AS text, coalesce(caps.cids, []) AS caps, coalesce(notes.cids, []) AS notes, coalesce(parts, '') AS parts
  FROM ordered o LEFT JOIN joined j ON j.page = o.page AND j.cid = o.cid LEFT JOIN caps ON caps.page = o.page AND caps.owner = o.cid LEFT JOIN notes ON notes.page = o.page AND notes.owner = o.cid
  WHERE (o.page, o.cid) NOT IN (SELECT (page, cid) FROM capped) AND (o.page, o.cid) NOT IN (SELECT (page, cid) FROM noted) AND (label <> 'text' OR j.cid IS NOT NULL))"""


@query("document_items", f"WITH RECURSIVE {E}, {ITEMS} SELECT doc, ord, page, cid, label, layer, text, array_to_string(caps, ',') AS captions, array_to_string(notes, ',') AS footnotes, parts FROM items")
def document_items(spark, folder):
    """Documents as items in reading order, with captions and footnotes at their owners and merged texts once."""
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    part = lambda x: F.concat(x["page"].cast("string"), F.lit(":"), x["cid"].cast("string"), F.lit(":"), x["first"].cast("string"), F.lit("-"), x["last"].cast("string"))
    rows = order.document_items(fixtures.elements(spark, folder))
    return rows.select("doc", "ord", "page", "cid", "label", "layer", "text", listed("captions"), listed("footnotes"), F.coalesce(F.array_join(F.transform("parts", part), ","), F.lit("")).alias("parts"))


TREE = f"{ITEMS},\n{order.tree_items_sql('items', 'elements', 'tree')}"


def _tree(spark, folder):
    return order.tree_items(order.document_items(fixtures.elements(spark, folder)))


@query("tree_items", f"WITH RECURSIVE {E}, {TREE} SELECT doc AS doc_id, n::INTEGER AS ord, parent::INTEGER AS parent, label, layer, text FROM tree")
def tree_items(spark, folder):
    """Documents as trees: what belongs to a heading, a list or an owner is below it."""
    return _tree(spark, folder).select("doc_id", "ord", "parent", "label", "layer", "text")


MOST_TOKENS = 30
CHUNKS = f"""{TREE},
above AS (SELECT doc, parent, list(text ORDER BY n) AS captions FROM tree WHERE label = 'caption' GROUP BY doc, parent),
own AS (SELECT doc, n AS pos, parent, coalesce(text, '') AS text, n::VARCHAR AS refs FROM tree WHERE layer = 'body' AND label NOT IN ('title', 'section_header', 'section', 'chapter', 'caption', 'list', 'list_item')
  UNION ALL SELECT l.doc, l.n, l.parent, string_agg('- ' || i.text, chr(10) ORDER BY i.n), string_agg(i.n::VARCHAR, ',' ORDER BY i.n) FROM tree l JOIN tree i ON i.doc = l.doc AND i.parent = l.n AND i.label = 'list_item' WHERE l.label = 'list' AND l.layer = 'body' GROUP BY l.doc, l.n, l.parent),
chunks AS (SELECT o.doc AS doc_id, row_number() OVER (PARTITION BY o.doc ORDER BY pos) - 1 AS chunk_no, o.text, coalesce(h.text, '') AS headings, coalesce(array_to_string(a.captions, '|'), '') AS captions, refs, len(list_filter(string_split(replace(o.text, chr(10), ' '), ' '), lambda x: x <> '')) AS n_tokens
  FROM own o LEFT JOIN tree h ON h.doc = o.doc AND h.n = o.parent AND h.label = 'section_header' LEFT JOIN above a ON a.doc = o.doc AND a.parent = o.pos WHERE trim(o.text) <> '' OR a.captions IS NOT NULL)"""


def _shown(chunks):
    listed = lambda c, by: F.array_join(F.transform(c, lambda x: x.cast("string")), by).alias(c)
    return chunks.select("doc_id", "chunk_no", F.sha2("text", 256).alias("text_sha"), listed("headings", "|"), listed("captions", "|"), listed("item_refs", ","), "n_tokens")


@query("chunk_hierarchical", f"WITH RECURSIVE {E}, {CHUNKS} SELECT doc_id, chunk_no::INTEGER AS chunk_no, sha256(text) AS text_sha, headings, captions, refs AS item_refs, n_tokens::INTEGER AS n_tokens FROM chunks")
def chunk_hierarchical(spark, folder):
    """One chunk for each element of a document tree, the items of a list together, with headings and captions."""
    return _shown(chunk.hierarchical(_tree(spark, folder)))


@query("chunk_peers", f"""WITH RECURSIVE {E}, {CHUNKS},
f AS (SELECT doc_id, chunk_no, 0 AS grp, n_tokens AS held, headings, captions FROM chunks WHERE chunk_no = 0
  UNION ALL SELECT c.doc_id, c.chunk_no, CASE WHEN c.headings = f.headings AND c.captions = f.captions AND held + c.n_tokens <= {MOST_TOKENS} THEN grp ELSE grp + 1 END, CASE WHEN c.headings = f.headings AND c.captions = f.captions AND held + c.n_tokens <= {MOST_TOKENS} THEN held + c.n_tokens ELSE c.n_tokens END, c.headings, c.captions
  FROM f JOIN chunks c ON c.doc_id = f.doc_id AND c.chunk_no = f.chunk_no + 1)
SELECT c.doc_id, grp::INTEGER AS chunk_no, sha256(string_agg(text, chr(10) ORDER BY c.chunk_no)) AS text_sha, any_value(c.headings) AS headings, any_value(c.captions) AS captions, string_agg(refs, ',' ORDER BY c.chunk_no) AS item_refs, sum(n_tokens)::INTEGER AS n_tokens FROM chunks c JOIN f USING (doc_id, chunk_no) GROUP BY c.doc_id, grp""")
def chunk_peers(spark, folder):
    """Chunks of a document tree merged with their neighbours of the same headings and captions while they fit."""
    return _shown(chunk.hybrid(chunk.hierarchical(_tree(spark, folder)), MOST_TOKENS))


MARKDOWN = f"""blocks AS (SELECT t.doc, t.n, t.label, t.parent, t.page, CASE WHEN t.label = 'caption' AND p.label IN ('picture', 'table') THEN t.parent - 0.5 ELSE t.n END AS place,
  CASE t.label WHEN 'section_header' THEN '## ' || t.text WHEN 'list_item' THEN '- ' || t.text WHEN 'code' THEN '```' || chr(10) || t.text || chr(10) || '```' WHEN 'picture' THEN '<!-- image -->' WHEN 'table' THEN NULL ELSE t.text END AS block
  FROM tree t LEFT JOIN tree p ON p.doc = t.doc AND p.n = t.parent WHERE t.layer = 'body' AND t.label <> 'list')"""
_said = """(SELECT *, CASE WHEN lag(block) OVER w IS NULL THEN '' WHEN label = 'list_item' AND lag(label) OVER w = 'list_item' AND lag(parent) OVER w = parent THEN chr(10) ELSE chr(10) || chr(10) END AS sep FROM blocks WHERE length(block) > 0 WINDOW w AS (PARTITION BY {0} ORDER BY place, n))"""


@query("document_markdown", f"WITH RECURSIVE {E}, {TREE}, {MARKDOWN} SELECT doc AS doc_id, sha256(string_agg(sep || block, '' ORDER BY place, n)) AS markdown_sha, count(*)::BIGINT AS blocks, count(*) FILTER (label = 'picture')::BIGINT AS pictures FROM {_said.format('doc')} GROUP BY doc")
def document_markdown(spark, folder):
    """Documents out of layout elements as Markdown."""
    tree = scratch.save(_tree(spark, folder), "tree")
    counts = serialize.blocks(tree).groupBy("doc_id").agg(F.count("*").alias("blocks"), F.count_if(F.col("label") == "picture").alias("pictures"))
    return serialize.markdown(tree).join(counts, "doc_id").select("doc_id", F.sha2("markdown", 256).alias("markdown_sha"), "blocks", "pictures")


WIDTH, HEIGHT = 612, 792


def _sizes(elements):
    return elements.select("page").distinct().select("page", F.lit(float(WIDTH)).alias("width"), F.lit(float(HEIGHT)).alias("height"))


@query("page_segments", f"""WITH RECURSIVE {E}, {TREE}
  SELECT t.doc AS doc_id, t.page, t.n::INTEGER AS index_in_doc, t.label, sha256(coalesce(t.text, '')) AS text_sha, round(l / {WIDTH}, 9) AS l, round(t.t / {HEIGHT}, 9) AS t, round(r / {WIDTH}, 9) AS r, round(b / {HEIGHT}, 9) AS b FROM (SELECT tree.*, l, e.t, r, b FROM tree JOIN elements e ON e.page = tree.page AND e.cid = tree.cid WHERE tree.label <> 'list') t""")
def page_segments(spark, folder):
    """Items with their boxes on pages of size one."""
    elements = fixtures.elements(spark, folder)
    rows = multimodal.segments(_tree(spark, folder).withColumn("page", F.col("page").cast("long")), elements, _sizes(elements))
    return rows.select("doc_id", "page", "index_in_doc", "label", F.sha2("text", 256).alias("text_sha"), *(F.round(F.get("bbox", F.lit(k)), 9).alias(x) for k, x in enumerate("ltrb")))


@query("multimodal_rows", f"""WITH RECURSIVE {E}, {fixtures.CELLS}, {TREE}, {MARKDOWN},
  md AS (SELECT doc, page, string_agg(sep || block, '' ORDER BY place, n) AS md FROM {_said.format('doc, page')} GROUP BY doc, page),
  said AS (SELECT doc, page, string_agg(CASE WHEN layer = 'body' AND length(text) > 0 THEN text || ' ' ELSE '' END, '' ORDER BY n) AS contents, count(*) FILTER (label <> 'list') AS n_segments FROM tree GROUP BY doc, page), c AS (SELECT page, count(*) AS n FROM cells GROUP BY page)
  SELECT s.doc AS doc_id, s.page, sha256(contents) AS contents_sha, sha256(coalesce(md, '')) AS md_sha, n_segments::BIGINT AS n_segments, coalesce(c.n, 0)::BIGINT AS n_cells, sha256('doc-' || s.doc || ':' || s.page) AS page_hash FROM said s LEFT JOIN md ON md.doc = s.doc AND md.page = s.page LEFT JOIN c ON c.page = s.page""")
def multimodal_rows(spark, folder):
    """One row a page for training on text and picture: contents, Markdown, segments, cells, hash."""
    tree = scratch.save(_tree(spark, folder).withColumn("page", F.col("page").cast("long")), "tree")
    hashes = tree.select("doc_id").distinct().withColumn("hash", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    elements = fixtures.elements(spark, folder)
    rows = multimodal.page_rows(tree, elements, fixtures.cells(spark, folder), _sizes(elements), hashes)
    many = lambda c: F.greatest(F.size(F.coalesce(c, F.array())), F.lit(0)).cast("long")
    return rows.select("doc_id", "page", F.sha2("contents", 256).alias("contents_sha"), F.sha2("contents_md", 256).alias("md_sha"), many("segments").alias("n_segments"), many("cells").alias("n_cells"), "page_hash")


@query("ref_resolution", f"WITH RECURSIVE {E}, {TREE} SELECT c.doc AS doc_id, c.n::INTEGER AS ord, p.label AS parent_label, coalesce(p.text, '') AS parent_text FROM tree c JOIN tree p ON p.doc = c.doc AND p.n = c.parent")
def ref_resolution(spark, folder):
    """Items with what they are below, by following references."""
    tree = scratch.save(_tree(spark, folder).select("doc_id", "ord", "parent", "label", "text"), "tree")
    up = tree.select("doc_id", F.col("ord").alias("parent"), F.col("label").alias("parent_label"), F.coalesce("text", F.lit("")).alias("parent_text"))
    return tree.select("doc_id", "ord", "parent").join(up, ["doc_id", "parent"]).select("doc_id", "ord", "parent_label", "parent_text")


W = fixtures.TABLE_WORDS


@query("table_cells", f"""WITH {W}, {tables.table_cells_sql('words', 'tables', 'cut')} SELECT page, "table" AS table_id, r0, r1, c0, c1, text FROM cut""")
def table_cells(spark, folder):
    """Cells of tables, with the rows and columns they span, out of the words that lie in them."""
    return tables.table_cells(*fixtures.table_words(spark, folder)).withColumnRenamed("table", "table_id")


@query("table_shapes", f"""WITH {W}, {tables.table_cells_sql('words', 'tables', 'cut')}, s AS (SELECT page, "table" AS cid, max(r1) + 1 AS n_rows, max(c1) + 1 AS n_cols, count(*) AS n_cells FROM cut GROUP BY ALL)
  SELECT t.page, t.cid, 'table' AS kind, coalesce(n_rows, 0)::INTEGER AS n_rows, coalesce(n_cols, 0)::INTEGER AS n_cols, coalesce(n_cells, 0)::BIGINT AS n_cells FROM tables t LEFT JOIN s ON s.page = t.page AND s.cid = t.cid""")
def table_shapes(spark, folder):
    """Page elements with the shape of their tables; a table without cells is an empty one."""
    words, found = fixtures.table_words(spark, folder)
    return tables.assembled(found.withColumn("label", F.lit("table")), tables.table_cells(words, found))
