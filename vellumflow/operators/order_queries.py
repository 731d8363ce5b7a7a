"""Operators that depend on order: counters, headings, paragraphs, merges, chunks, stable ids."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.operators import fixtures
from vellumflow.operators.folds import folded
from vellumflow.registry import query, table

C = fixtures.CELLS
LIST_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"
ITEMS = f"""items AS (SELECT l_orderkey // 15 AS doc, row_number() OVER (PARTITION BY l_orderkey // 15 ORDER BY {LIST_KEY}) AS ord,
  CASE WHEN l_partkey % 5 = 0 THEN 'heading' WHEN l_partkey % 5 < 4 THEN 'list_item' ELSE 'text' END AS kind, (l_suppkey % 3 + 1)::INTEGER AS level, 't' || l_partkey AS text FROM lineitem)"""


def items(spark, folder):
    """A document tree as rows in reading order: (doc, ord, kind, level, text)."""
    k = F.col("l_partkey") % 5
    return (
        table(spark, folder, "lineitem").withColumn("doc", F.floor(F.col("l_orderkey") / 15))
        .select("doc", F.row_number().over(Window.partitionBy("doc").orderBy(*LIST_KEY.split(", "))).cast("long").alias("ord"), F.when(k == 0, "heading").when(k < 4, "list_item").otherwise("text").alias("kind"),
                (F.col("l_suppkey") % 3 + 1).cast("int").alias("level"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("text"))
    )


def _doc():
    return Window.partitionBy("doc").orderBy("ord")


@query("list_markers", f"""WITH {ITEMS}, g AS (SELECT *, sum(CASE WHEN kind <> 'list_item' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY ord) AS grp FROM items)
  SELECT doc, ord, grp::BIGINT AS grp, (row_number() OVER (PARTITION BY doc, grp ORDER BY ord) - 1 + doc % 4 + 1) || '.' AS marker FROM g WHERE kind = 'list_item'""")
def list_markers(spark, folder):
    """Consecutive list items share a list; an item's marker is the list's start plus the items before it."""
    run = F.sum(F.when(F.col("kind") != "list_item", 1).otherwise(0)).over(_doc())
    number = F.row_number().over(Window.partitionBy("doc", "grp").orderBy("ord")) - 1 + F.col("doc") % 4 + 1
    return items(spark, folder).withColumn("grp", run).where("kind = 'list_item'").select("doc", "ord", "grp", F.concat(number.cast("string"), F.lit(".")).alias("marker"))


@query("numbered_headings", f"""WITH RECURSIVE {ITEMS}, h AS (SELECT doc, ord, level, row_number() OVER (PARTITION BY doc ORDER BY ord) AS k FROM items WHERE kind = 'heading'),
  f AS (SELECT doc, k, ord, level, CASE level WHEN 1 THEN [1, 0, 0] WHEN 2 THEN [1, 1, 0] ELSE [1, 1, 1] END AS n FROM h WHERE k = 1
    UNION ALL SELECT h.doc, h.k, h.ord, h.level, CASE h.level WHEN 1 THEN [n[1] + 1, 0, 0] WHEN 2 THEN [greatest(n[1], 1), n[2] + 1, 0] ELSE [greatest(n[1], 1), greatest(n[2], 1), n[3] + 1] END FROM f JOIN h ON h.doc = f.doc AND h.k = f.k + 1)
  SELECT doc, ord, array_to_string(n[1:level], '.') AS number FROM f""")
def numbered_headings(spark, folder):
    """Numbers 1.2.3 of headings: a heading counts up on its level and resets the deeper ones; an upper level that was
    never met counts as 1. So a level's number is the count of its headings since the last shallower one, and one more if a
    deeper one came before all of them there: window functions only."""
    h = items(spark, folder).where("kind = 'heading'").select("doc", "ord", "level")
    w = Window.partitionBy("doc").orderBy("ord")
    h = h.withColumn("s1", F.sum(F.when(F.col("level") == 1, 1).otherwise(0)).over(w))
    h = h.withColumn("s2", F.sum(F.when(F.col("level") == 2, 1).otherwise(0)).over(Window.partitionBy("doc", "s1").orderBy("ord")))
    n3 = F.sum(F.when(F.col("level") == 3, 1).otherwise(0)).over(Window.partitionBy("doc", "s1", "s2").orderBy("ord"))
    lead = lambda least, *by: F.min(F.when(F.col("level") >= least, F.struct("ord", "level"))).over(Window.partitionBy(*by))["level"]
    more = lambda c: F.when(c, 1).otherwise(0)
    h = h.select("doc", "ord", "level", (F.col("s1") + more(lead(1, "doc") > 1)).alias("n1"), (F.col("s2") + more(lead(2, "doc", "s1") > 2)).alias("n2"), n3.alias("n3"))
    return h.select("doc", "ord", F.array_join(F.slice(F.array(*(F.col(f"n{k}").cast("string") for k in (1, 2, 3))), F.lit(1), F.col("level")), ".").alias("number"))


@query("heading_path", f"""WITH {ITEMS}, u AS (SELECT *, max(CASE WHEN kind = 'heading' AND level = 1 THEN ord END) OVER w AS h1, max(CASE WHEN kind = 'heading' AND level = 2 THEN ord END) OVER w AS h2, max(CASE WHEN kind = 'heading' AND level = 3 THEN ord END) OVER w AS h3 FROM items WINDOW w AS (PARTITION BY doc ORDER BY ord))
  SELECT doc, ord, coalesce(h1, 0) AS h1, CASE WHEN h2 > coalesce(h1, 0) THEN h2 ELSE 0 END AS h2, CASE WHEN h3 > greatest(coalesce(h1, 0), coalesce(h2, 0)) THEN h3 ELSE 0 END AS h3 FROM u WHERE kind <> 'heading'""")
def heading_path(spark, folder):
    """The headings above each item: the latest of each level, unless a shallower one came later. Window functions only."""
    last = lambda k: F.coalesce(F.max(F.when((F.col("kind") == "heading") & (F.col("level") == k), F.col("ord"))).over(_doc()), F.lit(0))
    rows = items(spark, folder).select("doc", "ord", "kind", *(last(k).alias(f"u{k}") for k in (1, 2, 3)))
    h2, h3 = F.when(F.col("u2") > F.col("u1"), F.col("u2")).otherwise(0), F.when(F.col("u3") > F.greatest("u1", "u2"), F.col("u3")).otherwise(0)
    return rows.where("kind <> 'heading'").select("doc", "ord", F.col("u1").alias("h1"), h2.cast("long").alias("h2"), h3.cast("long").alias("h3"))


@query("page_islands", f"WITH {ITEMS}, f AS (SELECT *, CASE WHEN level > lag(level) OVER (PARTITION BY doc ORDER BY ord) THEN 1 ELSE 0 END AS flip FROM items) SELECT doc, ord, sum(flip) OVER (PARTITION BY doc ORDER BY ord)::BIGINT AS island FROM f")
def page_islands(spark, folder):
    """Groups that end where an item's page is beyond the current one."""
    flip = F.when(F.col("level") > F.lag("level").over(_doc()), 1).otherwise(0)
    return items(spark, folder).withColumn("flip", flip).select("doc", "ord", F.sum("flip").over(_doc()).alias("island"))


@query("paragraph_gap", f"""WITH {C}, p AS (SELECT *, lag(t) OVER w AS pt, lag(b - t) OVER w AS ph, lag(r) OVER w AS pr FROM cells WINDOW w AS (PARTITION BY page ORDER BY t, l, idx))
  SELECT page, idx, sum(CASE WHEN t - pt > greatest(ph, b - t) * 1.4 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY t, l, idx)::BIGINT AS para, CASE WHEN t = pt AND l - pr > greatest(0.6 * (b - t), 0.8) THEN 1 ELSE 0 END AS space FROM p""")
def paragraph_gap(spark, folder):
    """A wide vertical gap begins a paragraph, a wide horizontal one puts a space between: lag and a running sum."""
    w = Window.partitionBy("page").orderBy("t", "l", "idx")
    lag = lambda c: F.lag(c).over(w)
    h = F.col("b") - F.col("t")
    rows = fixtures.cells(spark, folder).withColumn("brk", F.when(F.col("t") - lag("t") > F.greatest(lag(h), h) * 1.4, 1).otherwise(0))
    rows = rows.withColumn("space", F.when((F.col("t") == lag("t")) & (F.col("l") - lag("r") > F.greatest(0.6 * h, F.lit(0.8))), 1).otherwise(0))
    return rows.select("page", "idx", F.sum("brk").over(w).alias("para"), "space")


@query("line_group_fold", f"""WITH RECURSIVE {C}, o AS (SELECT page, idx, t, b, row_number() OVER (PARTITION BY page ORDER BY t, l, idx) AS k FROM cells),
  f AS (SELECT page, idx, k, 0 AS line, t AS low, b - t AS tall FROM o WHERE k = 1
    UNION ALL SELECT o.page, o.idx, o.k, CASE WHEN abs(o.t - low) > greatest(o.b - o.t, tall, 1.0) * 0.6 + 0.8 THEN line + 1 ELSE line END, CASE WHEN abs(o.t - low) > greatest(o.b - o.t, tall, 1.0) * 0.6 + 0.8 THEN o.t ELSE least(low, o.t) END,
      CASE WHEN abs(o.t - low) > greatest(o.b - o.t, tall, 1.0) * 0.6 + 0.8 THEN o.b - o.t ELSE greatest(tall, o.b - o.t) END FROM f JOIN o ON o.page = f.page AND o.k = f.k + 1) SELECT page, idx, line::BIGINT AS line FROM f""")
def line_group_fold(spark, folder):
    """Cells of a page as lines: the height a line tolerates follows the cells it already has, so this is a fold over
    the cells in order of (top, left)."""

    def lines(top, bottom):
        line, low, tall, out = -1, None, 0.0, []
        for t, b in zip(top.tolist(), bottom.tolist()):
            if low is None or abs(t - low) > max(b - t, tall, 1.0) * 0.6 + 0.8:
                line, low, tall = line + 1, t, b - t
            low, tall = min(low, t), max(tall, b - t)
            out.append(line)
        return out

    rows = fixtures.cells(spark, folder).select("page", "t", "l", "idx", "b")
    return folded(rows, ("page",), ("t", "l", "idx"), ("t", "b"), lines, "line").select("page", "idx", F.col("line").cast("long").alias("line"))


#: Cells as they are printed: in order of (top, left).
PRINTED = f"{C}, printed AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY t, l, idx) AS k FROM cells)"


@query("cell_merge_fold", f"""WITH RECURSIVE {PRINTED}, f AS (SELECT page, k, 0 AS line, t AS top, b AS bottom FROM printed WHERE k = 1
    UNION ALL SELECT o.page, o.k, line + CASE WHEN abs(o.t - top) <= 0.5 * (bottom - top) AND abs(o.b - bottom) <= 0.5 * (bottom - top) THEN 0 ELSE 1 END,
      CASE WHEN abs(o.t - top) <= 0.5 * (bottom - top) AND abs(o.b - bottom) <= 0.5 * (bottom - top) THEN least(top, o.t) ELSE o.t END, CASE WHEN abs(o.t - top) <= 0.5 * (bottom - top) AND abs(o.b - bottom) <= 0.5 * (bottom - top) THEN greatest(bottom, o.b) ELSE o.b END
      FROM f JOIN printed o ON o.page = f.page AND o.k = f.k + 1),
  p AS (SELECT o.*, f.line, lag(o.r) OVER w AS pr, lag(o.b - o.t) OVER w AS ph FROM printed o JOIN f USING (page, k) WINDOW w AS (PARTITION BY o.page, f.line ORDER BY o.k)),
  g AS (SELECT *, sum(CASE WHEN l - pr <= (ph + b - t) / 2 THEN 0 ELSE 1 END) OVER (PARTITION BY page ORDER BY k) AS run FROM p)
  SELECT page, run::BIGINT AS idx, trim(string_agg(trim(text), ' ' ORDER BY k) FILTER (trim(text) <> '')) AS text, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM g GROUP BY page, run""")
def cell_merge_fold(spark, folder):
    """Neighbouring cells of a row merged into runs. A row takes the next cell while both its edges differ by at most half the
    row's height so far from the row's (a fold); a run ends where the gap to the cell before is wider than the mean height of
    the two (lag and a running sum). Runs are numbered from 1."""

    def rows_of(top, bottom):
        row, t0, b0, out = -1, 0.0, 0.0, []
        for t, b in zip(top.tolist(), bottom.tolist()):
            if row >= 0 and max(abs(t - t0), abs(b - b0)) <= 0.5 * (b0 - t0):
                t0, b0 = min(t, t0), max(b, b0)
            else:
                row, t0, b0 = row + 1, t, b
            out.append(row)
        return out

    cells = fixtures.cells(spark, folder).select("page", "t", "l", "idx", "r", "b", "text")
    c = folded(cells, ("page",), ("t", "l", "idx"), ("t", "b"), rows_of, "row")
    here = Window.partitionBy("page", "row").orderBy("t", "l", "idx")
    joins = F.col("l") - F.lag("r").over(here) <= (F.lag(F.col("b") - F.col("t")).over(here) + F.col("b") - F.col("t")) / 2
    c = c.withColumn("new", F.when(joins, 0).otherwise(1)).withColumn("run", F.sum("new").over(Window.partitionBy("page").orderBy("t", "l", "idx")))
    said = F.transform(F.array_sort(F.collect_list(F.when(F.trim("text") != "", F.struct("t", "l", "idx", F.trim("text").alias("x"))))), lambda x: x["x"])
    merged = c.groupBy("page", F.col("run").alias("idx")).agg(said.alias("said"), F.min("l").alias("l"), F.min("t").alias("t"), F.max("r").alias("r"), F.max("b").alias("b"))
    return merged.select("page", "idx", F.when(F.size("said") > 0, F.array_join("said", " ")).alias("text"), *"ltrb")


@query("batch_assign", f"WITH {ITEMS} SELECT doc, ord, (ord - 1) // 4 AS batch FROM items")
def batch_assign(spark, folder):
    return items(spark, folder).select("doc", "ord", F.floor((F.col("ord") - 1) / 4).alias("batch"))


@query("page_text_concat", f"WITH {ITEMS} SELECT doc, level AS page_no, sha256(string_agg(text, ' ' ORDER BY ord)) AS text_sha, count(*)::BIGINT AS n FROM items GROUP BY doc, level")
def page_text_concat(spark, folder):
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ")
    return items(spark, folder).groupBy("doc", F.col("level").alias("page_no")).agg(F.sha2(text, 256).alias("text_sha"), F.count("*").alias("n"))


MOST_WORDS = 40


@query("chunk_hybrid", f"""WITH RECURSIVE ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
  w AS (SELECT doc_id, line_no, list_filter(string_split(line, ' '), lambda x: x <> '') AS w FROM ln), p AS (SELECT doc_id, line_no, a, w[a + 1:a + {MOST_WORDS}] AS p FROM (SELECT *, unnest(range(0, len(w), {MOST_WORDS})) AS a FROM w WHERE len(w) > 0)),
  o AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, a) AS k, len(p) AS n, array_to_string(p, ' ') AS text FROM p),
  f AS (SELECT doc_id, k, n AS held, 0 AS chunk_no FROM o WHERE k = 1
    UNION ALL SELECT o.doc_id, o.k, CASE WHEN held + n <= {MOST_WORDS} THEN held + n ELSE n END, CASE WHEN held + n <= {MOST_WORDS} THEN chunk_no ELSE chunk_no + 1 END FROM f JOIN o ON o.doc_id = f.doc_id AND o.k = f.k + 1)
  SELECT doc_id, chunk_no, sum(n)::INTEGER AS n_words, sha256(string_agg(text, chr(10) ORDER BY k)) AS chunk_sha FROM o JOIN f USING (doc_id, k) GROUP BY doc_id, chunk_no""")
def chunk_hybrid(spark, folder):
    """Chunks of at most 40 words: longer lines are split, then shorter neighbours under one heading are merged while
    they fit. The fold sees only the sizes of the ordered pieces of a document."""

    def chunks(sizes):
        chunk, held, out = 0, 0, []
        for n in sizes.tolist():
            if held and held + n > MOST_WORDS:
                chunk, held = chunk + 1, 0
            held += n
            out.append(chunk)
        return out

    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    words = lines.withColumn("w", F.filter(F.split("line", " "), lambda x: x != "")).where(F.size("w") > 0)
    parts = words.select("doc_id", "line_no", F.posexplode(F.transform(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / MOST_WORDS).cast("int")), lambda k: F.slice(F.col("w"), k * MOST_WORDS + 1, F.lit(MOST_WORDS)))).alias("part", "p"))
    pieces = parts.select("doc_id", "line_no", "part", F.size("p").alias("n"), F.array_join("p", " ").alias("text"))
    c = folded(pieces, ("doc_id",), ("line_no", "part"), ("n",), chunks, "chunk_no")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "part", "text"))), lambda x: x["text"]), "\n")
    return c.groupBy("doc_id", "chunk_no").agg(F.sum("n").cast("int").alias("n_words"), F.sha2(text, 256).alias("chunk_sha"))


@query("chunk_overlapping", """WITH w AS (SELECT doc_id, list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM documents), s AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 30, 1), 98)) AS first FROM w WHERE len(w) > 0)
  SELECT doc_id, first // 98 AS chunk_no, sha256(array_to_string(w[first + 1:first + 128], ' ')) AS chunk_sha FROM s""")
def chunk_overlapping(spark, folder):
    """Chunks of 128 words, each beginning with the last 30 of the one before."""
    w = F.filter(F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " "), lambda x: x != "")
    rows = table(spark, folder, "documents").select("doc_id", w.alias("w")).where(F.size("w") > 0)
    firsts = F.sequence(F.lit(0), F.greatest(F.size("w") - 31, F.lit(0)), F.lit(98))
    return rows.select("doc_id", "w", F.explode(firsts).alias("first")).select("doc_id", F.floor(F.col("first") / 98).alias("chunk_no"), F.sha2(F.array_join(F.slice("w", F.col("first") + 1, F.lit(128)), " "), 256).alias("chunk_sha"))


@query("pii_obfuscation", r"SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', 'email', 'g'), '[0-9]{3}-[0-9]{3}-[0-9]{4}', 'phone', 'g')) AS text_sha FROM documents")
def pii_obfuscation(spark, folder):
    c = F.regexp_replace(F.regexp_replace("text", r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "email"), r"[0-9]{3}-[0-9]{3}-[0-9]{4}", "phone")
    return table(spark, folder, "documents").select("doc_id", F.sha2(c, 256).alias("text_sha"))


@query("repetition_runs", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM documents), f AS (SELECT *, CASE WHEN line = lag(line) OVER (PARTITION BY doc_id ORDER BY k) THEN 0 ELSE 1 END AS new FROM l),
  g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM f) SELECT doc_id, min(k)::BIGINT AS first, count(*)::BIGINT AS times FROM g GROUP BY doc_id, run HAVING count(*) >= 2""")
def repetition_runs(spark, folder):
    """Lines that come several times in a row."""
    w = Window.partitionBy("doc_id").orderBy("k")
    l = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))  # noqa: E741
    g = l.withColumn("new", F.when(F.col("line") == F.lag("line").over(w), 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    return g.groupBy("doc_id", "run").agg(F.min("k").cast("long").alias("first"), F.count("*").alias("times")).where("times >= 2").drop("run")


APS = """aps AS (SELECT c_custkey AS doc, unnest(['PATN', 'WKU  ' || c_custkey, 'TTL  ' || c_name, '     ' || c_mktsegment, '     more', 'ABST', 'PAL  bal ' || c_nationkey]) AS line, unnest(range(7)) AS k FROM customer)"""


@query("aps_records", f"""WITH {APS}, p AS (SELECT doc, k, trim(left(line, 5)) AS field, trim(substr(line, 6)) AS value FROM aps), g AS (SELECT *, sum(CASE WHEN field <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY k) AS rec FROM p)
  SELECT doc, rec::BIGINT AS rec, max(field) AS field, trim(string_agg(value, ' ' ORDER BY k)) AS value FROM g GROUP BY doc, rec""")
def aps_records(spark, folder):
    """Two-column records whose values go on over lines without a key."""
    s = lambda a, b: F.concat(F.lit(a), F.col(b).cast("string"))
    made = F.array(F.lit("PATN"), s("WKU  ", "c_custkey"), s("TTL  ", "c_name"), s("     ", "c_mktsegment"), F.lit("     more"), F.lit("ABST"), s("PAL  bal ", "c_nationkey"))
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("doc"), F.posexplode(made).alias("k", "line"))
    w = Window.partitionBy("doc").orderBy("k")
    p = rows.withColumn("field", F.trim(F.left("line", F.lit(5)))).withColumn("value", F.trim(F.substr(F.col("line"), F.lit(6))))
    g = p.withColumn("rec", F.sum(F.when(F.col("field") != "", 1).otherwise(0)).over(w))
    value = F.trim(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]), " "))
    return g.groupBy("doc", "rec").agg(F.max("field").alias("field"), value.alias("value"))


@query("affiliation_join", "SELECT c_custkey, string_agg(DISTINCT n_name || ', ' || r_name, '; ') AS affiliations FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY c_custkey")
def affiliation_join(spark, folder):
    """Authors with what they are affiliated to, unknown references left out."""
    n = F.broadcast(table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    j = table(spark, folder, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("c_custkey").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(", ", "n_name", "r_name"))), "; ").alias("affiliations"))


#: Columns of the table that cells are put into: all line numbers there are.
TABLE_COLUMNS = range(1, 8)


@query("table_pivot", "SELECT l_orderkey AS row, " + ", ".join(f"coalesce(max(CASE WHEN l_linenumber = {k} THEN l_partkey END), -1) AS c{k}" for k in TABLE_COLUMNS) + " FROM lineitem GROUP BY 1")
def table_pivot(spark, folder):
    """Table cells as a rectangular table."""
    p = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("row")).pivot("l_linenumber", list(TABLE_COLUMNS)).agg(F.max("l_partkey"))
    return p.select("row", *(F.coalesce(F.col(str(k)), F.lit(-1)).cast("long").alias(f"c{k}") for k in TABLE_COLUMNS))


@query("document_concat", f"WITH {ITEMS}, n AS (SELECT doc, max(ord) AS size FROM items GROUP BY doc), o AS (SELECT doc, doc // 10 AS joined, sum(size) OVER (PARTITION BY doc // 10 ORDER BY doc) - size AS shift FROM n) SELECT joined, (ord + shift)::BIGINT AS ord, text FROM items JOIN o USING (doc)")
def document_concat(spark, folder):
    """Documents of single pages put into one: items numbered on from the pages before."""
    rows = items(spark, folder)
    n = rows.groupBy("doc").agg(F.max("ord").alias("size")).withColumn("joined", F.floor(F.col("doc") / 10))
    o = n.withColumn("shift", F.sum("size").over(Window.partitionBy("joined").orderBy("doc")) - F.col("size"))
    return rows.join(o, "doc").select("joined", (F.col("ord") + F.col("shift")).alias("ord"), "text")


@query("sheet_bounds", "SELECT l_orderkey // 15 AS sheet, min(l_linenumber)::INTEGER AS row0, max(l_linenumber)::INTEGER AS row1, min(l_suppkey)::BIGINT AS col0, max(l_suppkey)::BIGINT AS col1 FROM lineitem WHERE l_partkey % 5 > 0 GROUP BY 1")
def sheet_bounds(spark, folder):
    """The rectangle of a sheet that holds values."""
    return table(spark, folder, "lineitem").where("l_partkey % 5 > 0").groupBy(F.floor(F.col("l_orderkey") / 15).alias("sheet")).agg(F.min("l_linenumber").alias("row0"), F.max("l_linenumber").alias("row1"), F.min("l_suppkey").alias("col0"), F.max("l_suppkey").alias("col1"))


@query("merged_range_join", "SELECT o_orderkey AS cell, coalesce(min(n_regionkey) + 1, 1)::INTEGER AS row_span FROM orders LEFT JOIN nation ON o_custkey % 50 = n_nationkey GROUP BY 1")
def merged_range_join(spark, folder):
    """The span of a cell by the merged range that starts there, else 1."""
    n = F.broadcast(table(spark, folder, "nation"))
    j = table(spark, folder, "orders").join(n, F.col("o_custkey") % 50 == F.col("n_nationkey"), "left")
    return j.groupBy(F.col("o_orderkey").alias("cell")).agg(F.coalesce(F.min("n_regionkey") + 1, F.lit(1)).alias("row_span"))


@query("file_use_pivot", "SELECT p_size AS page, max(CASE WHEN p_partkey % 3 = 0 THEN p_name END) AS image, max(CASE WHEN p_partkey % 3 = 1 THEN p_name END) AS ocr, max(CASE WHEN p_partkey % 3 = 2 THEN p_name END) AS coord_ocr FROM part GROUP BY 1")
def file_use_pivot(spark, folder):
    """The files of each page of an archive, by their use."""
    use = F.when(F.col("p_partkey") % 3 == 0, "image").when(F.col("p_partkey") % 3 == 1, "ocr").otherwise("coord_ocr")
    return table(spark, folder, "part").withColumn("use", use).groupBy(F.col("p_size").alias("page")).pivot("use", ["image", "ocr", "coord_ocr"]).agg(F.max("p_name"))


@query("top_class", "SELECT l_orderkey, arg_max(l_returnflag, (l_extendedprice, l_partkey)) AS label FROM lineitem GROUP BY 1")
def top_class(spark, folder):
    """The class with the highest confidence."""
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.max_by("l_returnflag", F.struct("l_extendedprice", "l_partkey")).alias("label"))
