"""Names in texts: mentions by a dictionary, stable ids, texts with the ids instead, spans put together."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumflow.operators import names
from vellumflow.registry import query, table

KINDS = ("Person", "Org. unit", "location-")
#: Long words of the benchmark's texts, and some pairs of words, so that names overlap.
DICTIONARY = f"""words AS (SELECT item_id, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
said AS (SELECT w[k] AS name FROM words, range(1, 200) g(k) WHERE k <= len(w) AND length(w[k]) >= 10 UNION SELECT w[k] || ' ' || w[k + 1] FROM words, range(1, 200) g(k) WHERE k < len(w) AND (item_id + k) % 12 = 0),
dictionary AS (SELECT name, {names.normal_label_sql("['Person', 'Org. unit', 'location-'][length(name) % 3 + 1]")} AS label FROM said),
pattern AS (SELECT string_agg(name, '|' ORDER BY length(name) DESC, name) AS p FROM dictionary)"""
MENTIONS = f"""{DICTIONARY},
cut AS (SELECT doc_id, text, regexp_extract_all(text, p) AS found, string_split_regex(text, p) AS rest FROM documents, pattern),
mentions AS (SELECT doc_id, unnest(found) AS name, unnest(range(len(found))) AS k FROM cut),
first AS (SELECT m.name, label, min((doc_id, k)) AS f FROM mentions m JOIN dictionary USING (name) GROUP BY m.name, label),
ids AS (SELECT name, label, label || '-' || row_number() OVER (PARTITION BY label ORDER BY f, name) AS stable_id FROM first)"""


def dictionary(spark, folder):
    words = table(spark, folder, "benchmark").select("item_id", F.regexp_extract_all("text", F.lit(r"[A-Za-z]+"), 0).alias("w"))
    each = words.select("item_id", F.posexplode("w").alias("k", "name"), "w").withColumn("k", F.col("k") + 1)
    pairs = each.where((F.col("k") < F.size("w")) & ((F.col("item_id") + F.col("k")) % 12 == 0)).select(F.concat_ws(" ", "name", F.get("w", F.col("k"))).alias("name"))
    said = each.where(F.length("name") >= 10).select("name").unionByName(pairs).distinct()
    return said.withColumn("label", names.normal_label(F.get(F.array(*map(F.lit, KINDS)), (F.length("name") % 3).cast("int"))))


def _mentions(spark, folder):
    known = dictionary(spark, folder)
    return names.spans(table(spark, folder, "documents"), known).join(known, "name")


@query("name_mentions", f"WITH {MENTIONS} SELECT m.doc_id, m.name, label, count(*)::BIGINT AS n FROM mentions m JOIN dictionary USING (name) GROUP BY m.doc_id, m.name, label")
def name_mentions(spark, folder):
    """How often each text holds each name of a dictionary: leftmost, then longest."""
    return _mentions(spark, folder).groupBy("doc_id", "name", "label").agg(F.count("*").alias("n"))


@query("pii_stable_ids", f"WITH {MENTIONS} SELECT name, label, stable_id FROM ids")
def pii_stable_ids(spark, folder):
    """Names numbered within their kind, in order of first sight."""
    return names.stable_ids(_mentions(spark, folder), ["doc_id", "begin"])


@query("name_obfuscation", f"""WITH {MENTIONS}, parts AS (SELECT doc_id, unnest(rest) AS x, unnest(range(len(rest))) AS k FROM cut)
  SELECT p.doc_id, count(i.stable_id)::BIGINT AS n, sha256(string_agg(p.x || coalesce(i.stable_id, ''), '' ORDER BY p.k)) AS text_sha FROM parts p LEFT JOIN mentions m ON m.doc_id = p.doc_id AND m.k = p.k LEFT JOIN ids i ON i.name = m.name GROUP BY p.doc_id""")
def name_obfuscation(spark, folder):
    """Texts with the stable ids of names instead of the names."""
    docs, found = table(spark, folder, "documents").select("doc_id", "text"), _mentions(spark, folder)
    n = found.groupBy("doc_id").agg(F.count("*").alias("n"))
    new = names.replaced(docs, found, names.stable_ids(found, ["doc_id", "begin"]))
    return new.join(n, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).alias("n"), F.sha2("text", 256).alias("text_sha"))


@query("label_normalise", f"SELECT event_id, {names.normal_label_sql('event_type || chr(32) || props')} AS label, trim(regexp_replace(props, '\\s+', ' ', 'g')) AS name FROM events")
def label_normalise(spark, folder):
    """Labels and names in their normal forms."""
    return table(spark, folder, "events").select("event_id", names.normal_label(F.concat("event_type", F.lit(" "), "props")).alias("label"), names.normal_name(F.col("props")).alias("name"))


@query("span_merge", """WITH s AS (SELECT user_id, event_type, event_id, event_id AS begin, event_id + (floor(value)::BIGINT % 900) AS stop FROM events), p AS (SELECT *, max(stop) OVER (PARTITION BY user_id, event_type ORDER BY begin, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM s),
  g AS (SELECT *, sum(CASE WHEN begin <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY begin, event_id) AS grp FROM p) SELECT user_id, event_type, min(begin) AS first, max(stop) AS last, count(*)::BIGINT AS merged FROM g GROUP BY user_id, event_type, grp""")
def span_merge(spark, folder):
    """Spans of one label that overlap or touch become one."""
    s = table(spark, folder, "events").select("user_id", "event_type", F.col("event_id").alias("begin"), (F.col("event_id") + F.floor("value") % 900).alias("stop"))
    return names.merged(s, ["user_id", "event_type"]).withColumnsRenamed({"begin": "first", "stop": "last", "n": "merged"})
