"""Queries over text: cleaning, quality, hashes, lines, paragraphs, links, transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.functions import text as T
from vellumflow.operators import fixtures
from vellumflow.plans.options import options_key
from vellumflow.registry import query, table

D = fixtures.PERTURBED
_web = "replace(translate(text, '{a}', '{b}'), chr(8230), '...')"


def _sql_web(c: str) -> str:
    kept = T.WEB_SPACES + T.WEB_HYPHENS + T.WEB_SINGLE_QUOTES + T.WEB_DOUBLE_QUOTES
    to = " " * 2 + "-" * 6 + "''" * 2 + '""'
    return f"replace(translate({c}, '{kept}{T.WEB_REMOVED}', '{to}'), '{T.WEB_ELLIPSIS}', '...')"


@query("clean_unicode", f"WITH {D} SELECT doc_id, sha256({_sql_web('text')}) AS clean_sha, length({_sql_web('text')})::BIGINT AS n FROM noisy")
def clean_unicode(spark, folder):
    c = T.web_clean(F.col("text"))
    return fixtures.perturbed(spark, folder).select("doc_id", F.sha2(c, 256).alias("clean_sha"), F.length(c).cast("long").alias("n"))


@query("pdf_text_normalise", f"WITH {D} SELECT doc_id, sha256(regexp_replace(regexp_replace(translate(text, '{T.PRINT_FROM}', '/''''\"\"·'), '^[\\s\\x{{A0}}\\x{{200A}}]+', ''), '[\\s\\x{{A0}}]+$', '')) AS clean_sha FROM noisy")
def pdf_text_normalise(spark, folder):
    return fixtures.perturbed(spark, folder).select("doc_id", F.sha2(T.print_clean(F.col("text")), 256).alias("clean_sha"))


@query("whitespace_collapse", f"WITH {D} SELECT doc_id, sha256(regexp_replace(text, '[\\s\\x{{A0}}]+', ' ', 'g')) AS clean_sha FROM noisy")
def whitespace_collapse(spark, folder):
    return fixtures.perturbed(spark, folder).select("doc_id", F.sha2(T.collapse(F.col("text")), 256).alias("clean_sha"))


@query("underscore_clamp", f"WITH {D} SELECT doc_id, sha256(regexp_replace(text, '_{{11,}}', '__________', 'g')) AS text_sha FROM noisy")
def underscore_clamp(spark, folder):
    return fixtures.perturbed(spark, folder).select("doc_id", F.sha2(T.clamp_underscores(F.col("text")), 256).alias("text_sha"))


_frag = r"len(regexp_extract_all(text, '\b[A-Za-z](?:/[a-z]{1,3}\.[a-z]{1,3}){2,}\b'))"


@query("text_quality", rf"""WITH {D} SELECT doc_id, round(CASE WHEN contains(text, chr(65533)) OR regexp_matches(text, 'GLYPH<[0-9A-Fa-f]+>') OR regexp_matches(text, '(?:/G[0-9]+){{2,}}')
  OR regexp_matches(text, '^(?:/[\p{{L}}\p{{N}}_]+\s*){{2,}}') THEN 0.0 WHEN {_frag} >= 3 THEN greatest(0.0, 1.0 - 0.1 * {_frag}) ELSE 1.0 END, 6)::DOUBLE AS quality FROM noisy""")
def text_quality(spark, folder):
    return fixtures.perturbed(spark, folder).select("doc_id", F.round(T.quality(F.col("text")), 6).alias("quality"))


@query("doc_hash_dedup", "SELECT sha256(text) AS hash, count(*)::BIGINT AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1")
def doc_hash_dedup(spark, folder):
    return table(spark, folder, "documents").groupBy(F.sha2("text", 256).alias("hash")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))


@query("page_hash", "SELECT page_id, sha256(sha256(html) || ':' || (page_id - 1)) AS page_hash FROM pages")
def page_hash(spark, folder):
    """Page hash of the export rows: of the document's hash, a colon and the page's number from 0."""
    return table(spark, folder, "pages").select("page_id", F.sha2(F.concat_ws(":", F.sha2("html", 256), (F.col("page_id") - 1).cast("string")), 256).alias("page_hash"))


@query("options_hash", "SELECT DISTINCT lang, md5('{\"lang\":\"' || lang || '\",\"source\":\"' || source || '\"}') AS options_hash FROM documents")
def options_hash(spark, folder):
    """The key under which a pipeline with given options is kept: a digest of their names and values in order."""
    return table(spark, folder, "documents").select("lang", options_key(F.struct("lang", "source")).alias("options_hash")).distinct()


LINES = r"""lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM marked)"""
MARKED = """marked AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '= ' || text WHEN 1 THEN replace(text, chr(10), chr(10) || '== ') WHEN 2 THEN replace(text, chr(10), chr(10) || '* ')
  WHEN 3 THEN replace(text, chr(10), chr(10) || '.') WHEN 4 THEN replace(text, chr(10), chr(10) || chr(10)) ELSE replace(text, chr(10), chr(10) || '|===' || chr(10)) END AS text FROM documents)"""


def marked(spark, folder):
    k, t = F.col("doc_id") % 6, F.col("text")
    put = lambda x: F.replace(t, F.lit("\n"), F.lit(x))
    made = F.when(k == 0, F.concat(F.lit("= "), t)).when(k == 1, put("\n== ")).when(k == 2, put("\n* ")).when(k == 3, put("\n.")).when(k == 4, put("\n\n")).otherwise(put("\n|===\n"))
    return table(spark, folder, "documents").select("doc_id", made.alias("text"))


def lines(spark, folder):
    return marked(spark, folder).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def line_kind(line):
    """What a line of an AsciiDoc text is; the first that fits."""
    return (
        F.when(line.rlike(r"^= "), "title").when(line.rlike(r"^==+ +.+"), "section").when(line.rlike(r"^\s*(\*+|-+|\d+\.|\w+\.) .+"), "list_item")
        .when(line.rlike(r"^\|==="), "table_edge").when(line.rlike(r"^\|.*\|"), "table_row").when(line.rlike(r"^image::"), "picture")
        .when(line.rlike(r"^\.\S.+"), "caption").when(T.strip(line) == "", "blank").otherwise("text")
    )


@query("line_classify", rf"""WITH {MARKED}, {LINES} SELECT kind, count(*)::BIGINT AS n, sum(length(line))::BIGINT AS chars FROM (SELECT line, CASE WHEN regexp_matches(line, '^= ') THEN 'title' WHEN regexp_matches(line, '^==+ +.+') THEN 'section'
  WHEN regexp_matches(line, '^\s*(\*+|-+|[0-9]+\.|[a-zA-Z0-9_]+\.) .+') THEN 'list_item' WHEN regexp_matches(line, '^\|===') THEN 'table_edge' WHEN regexp_matches(line, '^\|.*\|') THEN 'table_row'
  WHEN regexp_matches(line, '^image::') THEN 'picture' WHEN regexp_matches(line, '^\.\S.+') THEN 'caption' WHEN trim(line) = '' THEN 'blank' ELSE 'text' END AS kind FROM lines) GROUP BY kind""")
def line_classify(spark, folder):
    return lines(spark, folder).groupBy(line_kind(F.col("line")).alias("kind")).agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("chars"))


@query("paragraph_join", f"""WITH {MARKED}, {LINES}, g AS (SELECT *, sum(CASE WHEN trim(line) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS para FROM lines)
  SELECT doc_id, para::BIGINT AS para, sha256(string_agg(line, ' ' ORDER BY line_no)) AS text_sha, count(*)::BIGINT AS n_lines FROM g WHERE trim(line) <> '' GROUP BY doc_id, para""")
def paragraph_join(spark, folder):
    """Consecutive lines that are not blank, joined by a space."""
    blank = F.trim("line") == ""
    para = F.sum(F.when(blank, 1).otherwise(0)).over(Window.partitionBy("doc_id").orderBy("line_no"))
    rows = lines(spark, folder).withColumn("para", para).where(~blank)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ")
    return rows.groupBy("doc_id", "para").agg(F.sha2(joined, 256).alias("text_sha"), F.count("*").alias("n_lines"))


@query("dehyphenate_lines", rf"""WITH {D}, p AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM noisy), l AS (SELECT doc_id, ls, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS k FROM p),
  j AS (SELECT doc_id, k, CASE WHEN k = len(ls) THEN line WHEN regexp_matches(line, '[\p{{L}}\p{{N}}_]-$') AND regexp_matches(ls[k + 1], '^[\p{{L}}\p{{N}}_]') THEN left(line, length(line) - 1) ELSE line || ' ' END AS part FROM l)
  SELECT doc_id, sha256(string_agg(part, '' ORDER BY k)) AS text_sha FROM j GROUP BY doc_id""")
def dehyphenate_lines(spark, folder):
    """Lines joined: a word broken by a hyphen at the line end is put together, other lines get a space between."""
    ls = F.split("text", "\n")
    nxt = lambda k: F.get(F.col("ls"), k + 1)
    part = F.transform("ls", lambda x, k: F.when(nxt(k).isNull(), x).when(x.rlike(r"[\p{L}\p{N}_]-$") & nxt(k).rlike(r"^[\p{L}\p{N}_]"), F.left(x, F.length(x) - 1)).otherwise(F.concat(x, F.lit(" "))))
    return fixtures.perturbed(spark, folder).withColumn("ls", ls).select("doc_id", F.sha2(F.array_join(part, ""), 256).alias("text_sha"))


@query("html_title", f"SELECT page_id, {_sql_web('''regexp_extract(html, '(?s)<title>(.*?)</title>', 1)''')} AS title FROM pages")
def html_title(spark, folder):
    return table(spark, folder, "pages").select("page_id", T.web_clean(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)).alias("title"))


@query("html_heading_text", "SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[^>]+>', '', 'g')) AS heading FROM pages")
def html_heading_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", F.trim(F.regexp_replace(F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1), r"<[^>]+>", "")).alias("heading"))


SNIFFED = """sniffed AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN html WHEN 1 THEN '<?xml version="1.0"?><!-- c --><html xmlns="http://www.w3.org/1999/xhtml">' || html
  WHEN 2 THEN '<?xml version="1.0"?><!DOCTYPE us-patent-grant SYSTEM "x.dtd">' || html WHEN 3 THEN '<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//NLM//DTD JATS 1.2//EN" "JATS-archivearticle1.dtd">' || html
  ELSE 'PATN' || chr(13) || chr(10) || html END AS content FROM pages)"""


def flavour(content):
    """html, xhtml, xml_uspto, xml_jats, xml or other, from the head of a text (comments do not count)."""
    head = F.ltrim(F.regexp_replace(F.left(content, F.lit(2000)), r"(?s)<!--.*?-->", ""))
    doctype = F.regexp_extract(head, r"<!DOCTYPE\s+([^>]*)>", 1)
    return (
        F.when(content.startswith("PATN\r\n"), "xml_uspto").when(F.lower(doctype).rlike("us-patent|patdoc|pap-v1"), "xml_uspto").when(doctype.rlike("JATS"), "xml_jats")
        .when(head.rlike(r"(?i)^<\?xml") & head.contains("http://www.w3.org/1999/xhtml"), "xhtml").when(head.rlike(r"(?i)^(<!doctype\s+html|<html|<head|<body)"), "html").when(head.rlike(r"(?i)^<\?xml"), "xml").otherwise("other")
    )


@query("format_sniff", rf"""WITH {SNIFFED}, h AS (SELECT page_id, content, ltrim(regexp_replace(left(content, 2000), '(?s)<!--.*?-->', '', 'g')) AS head FROM sniffed), k AS (SELECT *, regexp_extract(head, '<!DOCTYPE\s+([^>]*)>', 1) AS d FROM h)
  SELECT page_id, CASE WHEN starts_with(content, 'PATN' || chr(13) || chr(10)) THEN 'xml_uspto' WHEN regexp_matches(lower(d), 'us-patent|patdoc|pap-v1') THEN 'xml_uspto' WHEN regexp_matches(d, 'JATS') THEN 'xml_jats'
  WHEN regexp_matches(head, '(?i)^<\?xml') AND contains(head, 'http://www.w3.org/1999/xhtml') THEN 'xhtml' WHEN regexp_matches(head, '(?i)^(<!doctype\s+html|<html|<head|<body)') THEN 'html' WHEN regexp_matches(head, '(?i)^<\?xml') THEN 'xml' ELSE 'other' END AS flavour FROM k""")
def format_sniff(spark, folder):
    k, h = F.col("page_id") % 5, F.col("html")
    lead = ['<?xml version="1.0"?><!-- c --><html xmlns="http://www.w3.org/1999/xhtml">', '<?xml version="1.0"?><!DOCTYPE us-patent-grant SYSTEM "x.dtd">', '<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//NLM//DTD JATS 1.2//EN" "JATS-archivearticle1.dtd">', "PATN\r\n"]
    content = h
    for n, x in enumerate(lead):
        content = F.when(k == n + 1, F.concat(F.lit(x), h)).otherwise(content)
    return table(spark, folder, "pages").select("page_id", flavour(content).alias("flavour"))


@query("html_resolve_links", r"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS href FROM pages),
  m AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN href WHEN 1 THEN regexp_replace(href, '^[a-z]+:', '') WHEN 2 THEN regexp_replace(href, '^[a-z]+://[^/]*', '') ELSE '#' || href END AS href FROM a),
  f AS (SELECT *, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS host, regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)', 1) AS dir FROM m),
  r AS (SELECT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN starts_with(href, '#') THEN href WHEN starts_with(href, '//') THEN 'https:' || href WHEN starts_with(href, '/') THEN host || href
    ELSE (CASE WHEN ends_with(dir, '/') THEN dir ELSE dir || '/' END) || href END AS link FROM f) SELECT page_id, link, count(*)::BIGINT AS n FROM r GROUP BY ALL""")
def html_resolve_links(spark, folder):
    a = table(spark, folder, "pages").select("page_id", "url", F.explode(F.regexp_extract_all("html", F.lit(r'<a [^>]*href="([^"]*)"'), F.lit(1))).alias("href"))
    k, h = F.col("page_id") % 4, F.col("href")
    h = F.when(k == 0, h).when(k == 1, F.regexp_replace(h, "^[a-z]+:", "")).when(k == 2, F.regexp_replace(h, "^[a-z]+://[^/]*", "")).otherwise(F.concat(F.lit("#"), h))
    return a.groupBy("page_id", T.resolve_url(h, F.col("url")).alias("link")).agg(F.count("*").alias("n"))


@query("url_protocol_filter", "SELECT page_id, url FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'data:text/plain,' || page_id ELSE 's3://bucket/' || page_id END AS url FROM pages) WHERE regexp_extract(url, '^([a-z0-9]+)://', 1) IN ('http', 'https', 'ftp', 's3', 'gs')")
def url_protocol_filter(spark, folder):
    """Only remote addresses."""
    k, i = F.col("page_id") % 3, F.col("page_id").cast("string")
    url = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("data:text/plain,"), i)).otherwise(F.concat(F.lit("s3://bucket/"), i))
    return table(spark, folder, "pages").select("page_id", url.alias("url")).where(F.regexp_extract("url", "^([a-z0-9]+)://", 1).isin("http", "https", "ftp", "s3", "gs"))


@query("span_attributes", "SELECT DISTINCT l_quantity AS q, CASE WHEN q % 3 = 0 THEN q::BIGINT::INTEGER ELSE 1 END AS span FROM lineitem")
def span_attributes(spark, folder):
    q = F.col("q").cast("long").cast("string")
    raw = F.when(F.col("q") % 3 == 0, F.concat(F.lit(" "), q, F.lit("px"))).when(F.col("q") % 3 == 1, F.concat(F.lit("x"), q)).otherwise("")
    return table(spark, folder, "lineitem").select(F.col("l_quantity").alias("q")).distinct().select("q", T.span_value(raw).alias("span"))


@query("hocr_titles", f"WITH {fixtures.CELLS} SELECT page, idx, l::INTEGER AS x0, t::INTEGER AS y0, r::INTEGER AS x1, b::INTEGER AS y1, round(confidence * 100)::INTEGER / 100.0::DOUBLE AS conf FROM cells")
def hocr_titles(spark, folder):
    """Box and confidence out of the title strings of scanned words."""
    i = lambda c: F.col(c).cast("int").cast("string")
    title = F.concat(F.lit("bbox "), F.concat_ws(" ", i("l"), i("t"), i("r"), i("b")), F.lit("; x_wconf "), F.round(F.col("confidence") * 100).cast("int").cast("string"))
    part = lambda k: F.regexp_extract("title", r"bbox (-?\d+) (-?\d+) (-?\d+) (-?\d+)", k).cast("int")
    return fixtures.cells(spark, folder).withColumn("title", title).select("page", "idx", part(1).alias("x0"), part(2).alias("y0"), part(3).alias("x1"), part(4).alias("y1"), (F.regexp_extract("title", r"x_wconf (\d+)", 1).cast("double") / 100).alias("conf"))


STAMPS = """stamps AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_partkey % 4 WHEN 0 THEN lpad((l_suppkey % 60)::VARCHAR, 2, '0') || ':' || lpad((l_partkey % 60)::VARCHAR, 2, '0') || '.' || lpad((l_orderkey % 1000)::VARCHAR, 3, '0')
  WHEN 1 THEN lpad((l_suppkey % 120)::VARCHAR, 2, '0') || ':' || lpad((l_partkey % 60)::VARCHAR, 2, '0') || ':' || lpad((l_orderkey % 60)::VARCHAR, 2, '0') || '.250'
  WHEN 2 THEN '00:' || lpad((l_partkey % 90)::VARCHAR, 2, '0') || '.000' ELSE 'x' || l_partkey END AS stamp FROM lineitem)"""


@query("vtt_timestamp_seconds", rf"""WITH {STAMPS} SELECT stamp, count(*)::BIGINT AS n, CASE WHEN regexp_matches(stamp, '^(?:([0-9]{{2,}}):)?([0-5][0-9]):([0-5][0-9])\.([0-9]{{3}})$') THEN
  coalesce(nullif(regexp_extract(stamp, '^(?:([0-9]{{2,}}):)?([0-5][0-9]):([0-5][0-9])\.([0-9]{{3}})$', 1), '')::DOUBLE, 0) * 3600 + regexp_extract(stamp, '([0-5][0-9]):([0-5][0-9])\.([0-9]{{3}})$', 1)::DOUBLE * 60
  + regexp_extract(stamp, '([0-5][0-9])\.([0-9]{{3}})$', 1)::DOUBLE + regexp_extract(stamp, '\.([0-9]{{3}})$', 1)::DOUBLE / 1000 END AS seconds FROM stamps GROUP BY stamp""")
def vtt_timestamp_seconds(spark, folder):
    two = lambda c, m: F.lpad((F.col(c) % m).cast("string"), 2, "0")
    k = F.col("l_partkey") % 4
    stamp = (
        F.when(k == 0, F.concat(two("l_suppkey", 60), F.lit(":"), two("l_partkey", 60), F.lit("."), F.lpad((F.col("l_orderkey") % 1000).cast("string"), 3, "0")))
        .when(k == 1, F.concat(F.lpad((F.col("l_suppkey") % 120).cast("string"), F.lit(2), F.lit("0")), F.lit(":"), two("l_partkey", 60), F.lit(":"), two("l_orderkey", 60), F.lit(".250")))
        .when(k == 2, F.concat(F.lit("00:"), two("l_partkey", 90), F.lit(".000"))).otherwise(F.concat(F.lit("x"), F.col("l_partkey").cast("string")))
    )
    return table(spark, folder, "lineitem").groupBy(stamp.alias("stamp")).agg(F.count("*").alias("n")).select("stamp", "n", T.vtt_seconds(F.col("stamp")).alias("seconds"))


@query("asr_to_string", "SELECT conv_id, turn, '[time: ' || (turn * 2) || '.0-' || (turn * 2 + 2) || '.0] [speaker:' || role || '] ' || trim(text) AS line FROM conversations")
def asr_to_string(spark, folder):
    n = lambda x: (F.col("turn") * 2 + x).cast("string")
    return table(spark, folder, "conversations").select("conv_id", "turn", F.concat(F.lit("[time: "), n(0), F.lit(".0-"), n(2), F.lit(".0] [speaker:"), "role", F.lit("] "), F.trim("text")).alias("line"))


@query("asr_status", "SELECT conv_id, CASE WHEN bool_or(turn % 7 = 6) THEN 'failure' WHEN NOT bool_or(trim(t) <> '') THEN 'partial_success' ELSE 'success' END AS status FROM (SELECT conv_id, turn, CASE WHEN conv_id % 5 = 0 THEN ' ' ELSE text END AS t FROM conversations) GROUP BY conv_id")
def asr_status(spark, folder):
    t = F.when(F.col("conv_id") % 5 == 0, " ").otherwise(F.col("text"))
    return table(spark, folder, "conversations").groupBy("conv_id").agg(F.when(F.bool_or(F.col("turn") % 7 == 6), "failure").when(~F.bool_or(F.trim(t) != ""), "partial_success").otherwise("success").alias("status"))


@query("transcript_text", "SELECT conv_id, sha256(string_agg(role || ': ' || text, chr(10) ORDER BY turn, role, text)) AS text_sha, count(*)::BIGINT AS turns FROM conversations GROUP BY conv_id")
def transcript_text(spark, folder):
    """Turns of a conversation in order of their time, one a line."""
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return table(spark, folder, "conversations").groupBy("conv_id").agg(F.sha2(F.array_join(F.transform(ordered, lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n"), 256).alias("text_sha"), F.count("*").alias("turns"))


@query("json_extraction", """WITH e AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN left(props, 5) ELSE props END AS raw FROM events) SELECT event_id, json_valid(raw) AS valid, CASE WHEN json_valid(raw) THEN 'success' ELSE 'failure' END AS status FROM e""")
def json_extraction(spark, folder):
    """Model output as JSON or null, and the page's status."""
    raw = F.when(F.col("event_id") % 9 == 0, F.left("props", F.lit(5))).otherwise(F.col("props"))
    ok = F.expr("try_parse_json(raw)").isNotNull()
    return table(spark, folder, "events").select("event_id", raw.alias("raw")).select("event_id", ok.alias("valid"), F.when(ok, "success").otherwise("failure").alias("status"))


@query("code_fence", r"""WITH f AS (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '```text' || chr(10) || text || '```' || chr(10) WHEN 1 THEN '```' || text || '```' ELSE text END AS t FROM documents)
  SELECT doc_id, sha256(CASE WHEN regexp_matches(t, '(?s)^```(?:\w*\n)?(.*?)```(\n)*$') THEN regexp_extract(t, '(?s)^```(?:\w*\n)?(.*?)```(\n)*$', 1) ELSE t END) AS text_sha FROM f""")
def code_fence(spark, folder):
    k, t = F.col("doc_id") % 3, F.col("text")
    t = F.when(k == 0, F.concat(F.lit("```text\n"), t, F.lit("```\n"))).when(k == 1, F.concat(F.lit("```"), t, F.lit("```"))).otherwise(t)
    return table(spark, folder, "documents").select("doc_id", F.sha2(T.code_fence(t), 256).alias("text_sha"))


@query("language_tag", r"""WITH f AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<_' || lang || '_>  ' || text ELSE text END AS t FROM documents) SELECT doc_id, CASE WHEN regexp_matches(t, '(?s)^<_([^_>]+)_>\s*(.*)') THEN regexp_extract(t, '(?s)^<_([^_>]+)_>\s*(.*)', 1) END AS code_language,
  length(CASE WHEN regexp_matches(t, '(?s)^<_([^_>]+)_>\s*(.*)') THEN regexp_extract(t, '(?s)^<_([^_>]+)_>\s*(.*)', 2) ELSE t END)::BIGINT AS n FROM f""")
def language_tag(spark, folder):
    t = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<_"), "lang", F.lit("_>  "), "text")).otherwise(F.col("text"))
    rest, language = T.language_tag(t)
    return table(spark, folder, "documents").select("doc_id", language.alias("code_language"), F.length(rest).cast("long").alias("n"))


@query("generation_cleanup", r"SELECT doc_id, sha256(regexp_replace(string_split('  ' || text || '<end_of_utterance>junk', '<end_of_utterance>')[1], '^\s+', '')) AS text_sha FROM documents")
def generation_cleanup(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.sha2(T.generated(F.concat(F.lit("  "), "text", F.lit("<end_of_utterance>junk"))), 256).alias("text_sha"))


@query("private_use_stats", "SELECT source, sum(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END)::BIGINT AS private, sum(length(text) + CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END)::BIGINT AS chars FROM documents GROUP BY source")
def private_use_stats(spark, folder):
    t = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(""))).otherwise(F.col("text"))
    return table(spark, folder, "documents").select("source", t.alias("t")).groupBy("source").agg(F.sum(T.private_use(F.col("t"))).alias("private"), F.sum(F.length("t")).alias("chars"))


@query("style_split", r"SELECT p_partkey, regexp_extract(p_type, '^([A-Za-z ]+)', 1) AS style, coalesce(try_cast(regexp_extract(p_brand, '([0-9]+)$', 1) AS INTEGER), 0) AS level FROM part")
def style_split(spark, folder):
    """Name and number of a paragraph style; without a number, 0."""
    return table(spark, folder, "part").select("p_partkey", F.regexp_extract("p_type", "^([A-Za-z ]+)", 1).alias("style"), F.coalesce(F.regexp_extract("p_brand", "([0-9]+)$", 1).try_cast("int"), F.lit(0)).alias("level"))


@query("asciidoc_uri", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'file://host/' || page_id WHEN 2 THEN 'file://abs/' || page_id ELSE 'file://rel/' || page_id END AS uri FROM pages")
def asciidoc_uri(spark, folder):
    k, i = F.col("page_id") % 4, F.col("page_id").cast("string")
    c = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("//host/"), i)).when(k == 2, F.concat(F.lit("/abs/"), i)).otherwise(F.concat(F.lit("rel/"), i))
    return table(spark, folder, "pages").select("page_id", T.asciidoc_uri(c).alias("uri"))


@query("data_uri_images", "SELECT page_id, octet_length(encode(url)) AS n_bytes, sha256(url) AS sha FROM pages WHERE page_id % 2 = 0")
def data_uri_images(spark, folder):
    """Images given inline as base64; remote ones are not fetched."""
    src = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("data:image/png;base64,"), F.base64("url"))).otherwise(F.col("url"))
    data = F.unbase64(F.regexp_replace("src", "^data:image/[a-z+]+;base64,", ""))
    return table(spark, folder, "pages").withColumn("src", src).where(F.col("src").startswith("data:image/")).select("page_id", F.octet_length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("sha"))


@query("table_markdown", r"""WITH w AS (SELECT max(length(n_name)) AS a FROM nation) SELECT n_nationkey, '| ' || rpad(n_name, (SELECT greatest(a, 6) FROM w)::INTEGER, ' ') || ' | ' || lpad(n_regionkey::VARCHAR, 6, ' ') || ' |' AS row FROM nation""")
def table_markdown(spark, folder):
    """Rows of a pipe table: text to the left, numbers to the right, padded to the widest cell."""
    n = table(spark, folder, "nation")
    wide = n.agg(F.greatest(F.max(F.length("n_name")), F.lit(6)).alias("a"))
    return n.join(F.broadcast(wide)).select("n_nationkey", F.concat(F.lit("| "), F.rpad(F.col("n_name"), F.col("a"), F.lit(" ")), F.lit(" | "), F.lpad(F.col("n_regionkey").cast("string"), 6, " "), F.lit(" |")).alias("row"))
