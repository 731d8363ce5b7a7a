"""Confidence, profiling, limits and status roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellumflow import scratch
from vellumflow.functions.ranks import SKETCH_ERROR, merged, percentiles, sketched, sketches
from vellumflow.plans import plugins, serialize
from vellumflow.registry import query, table
from vellumflow.streaming import pages

# Where the grades of a score begin.
GRADES = ((0.9, "excellent"), (0.8, "good"), (0.5, "fair"))
PARSE_QUANTILE, LOW_QUANTILE = 0.10, 0.05

SCORES = """scores AS (SELECT l_orderkey // 60 AS doc_id, l_orderkey // 15 AS page, 1 - l_discount AS cell, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_tax * 10 END AS layout,
  CASE WHEN l_linestatus = 'F' THEN 1 - l_tax END AS ocr, CASE WHEN l_orderkey % 5 = 0 THEN l_discount * 9 END AS tab FROM lineitem),
pages_scored AS (SELECT doc_id, page, quantile_cont(cell, 0.1) AS parse, avg(layout) AS layout, avg(ocr) AS ocr, avg(tab) AS tab FROM scores GROUP BY doc_id, page),
rated AS (SELECT *, list_avg(list_filter([parse, layout, ocr, tab], lambda x: x IS NOT NULL)) AS mean, (SELECT quantile_cont(v, 0.05) FROM unnest([parse, layout, ocr, tab]) u(v)) AS low FROM pages_scored)"""


def grade(score):
    out = F.lit("poor")
    for least, name in reversed(GRADES):
        out = F.when(score >= least, name).otherwise(out)
    return F.when(score.isNull(), "unspecified").otherwise(out)


_sql_grade = "CASE WHEN {0} IS NULL THEN 'unspecified' WHEN {0} >= 0.9 THEN 'excellent' WHEN {0} >= 0.8 THEN 'good' WHEN {0} >= 0.5 THEN 'fair' ELSE 'poor' END"


def quantile_of(values, q):
    """Interpolated quantile of the values of an array that are not null."""
    v = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    at = (F.size(v) - 1) * F.lit(q)
    low, high = F.get(v, F.floor(at).cast("int")), F.get(v, F.ceil(at).cast("int"))
    return F.when(F.size(v) > 0, low + (high - low) * (at - F.floor(at)))


def mean_of(values):
    v = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v))


def pages_rated(spark, folder):
    """Scores of a page: a low quantile of its cells' parse scores, means of layout, recognised cells and tables, their
    mean and a low quantile of the four. Missing scores are null, never NaN, and do not count."""
    s = table(spark, folder, "lineitem").select(
        F.floor(F.col("l_orderkey") / 60).alias("doc_id"), F.floor(F.col("l_orderkey") / 15).alias("page"), (1 - F.col("l_discount")).alias("cell"),
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_tax") * 10).alias("layout"), F.when(F.col("l_linestatus") == "F", 1 - F.col("l_tax")).alias("ocr"), F.when(F.col("l_orderkey") % 5 == 0, F.col("l_discount") * 9).alias("tab"),
    )
    p = s.groupBy("doc_id", "page").agg(F.expr(f"percentile(cell, {PARSE_QUANTILE})").alias("parse"), F.avg("layout").alias("layout"), F.avg("ocr").alias("ocr"), F.avg("tab").alias("tab"))
    four = F.array("parse", "layout", "ocr", "tab")
    return p.withColumn("mean", mean_of(four)).withColumn("low", quantile_of(four, LOW_QUANTILE))


@query("confidence_page", f"WITH {SCORES} SELECT doc_id, page, round(parse, 10) AS parse, round(layout, 10) AS layout, round(ocr, 10) AS ocr, round(tab, 10) AS tab, round(mean, 10) AS mean, round(low, 10) AS low, {_sql_grade.format('round(mean, 9)')} AS mean_grade, {_sql_grade.format('round(low, 9)')} AS low_grade FROM rated")
def confidence_page(spark, folder):
    r = lambda c: F.round(c, 10).alias(c)
    return pages_rated(spark, folder).select("doc_id", "page", *map(r, ("parse", "layout", "ocr", "tab", "mean", "low")), grade(F.round("mean", 9)).alias("mean_grade"), grade(F.round("low", 9)).alias("low_grade"))


@query("confidence_doc", f"WITH {SCORES} SELECT doc_id, round(quantile_cont(parse, 0.1), 10) AS parse, round(avg(layout), 10) AS layout, round(avg(ocr), 10) AS ocr, round(avg(tab), 10) AS tab, round(avg(mean), 10) AS mean, round(avg(low), 10) AS low, {_sql_grade.format('round(avg(mean), 9)')} AS grade FROM rated GROUP BY doc_id")
def confidence_doc(spark, folder):
    a = lambda c: F.round(F.avg(c), 10).alias(c)
    return pages_rated(spark, folder).groupBy("doc_id").agg(F.round(F.expr(f"percentile(parse, {PARSE_QUANTILE})"), 10).alias("parse"), *map(a, ("layout", "ocr", "tab", "mean", "low")), grade(F.round(F.avg("mean"), 9)).alias("grade"))


@query("score_coercion", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE round(value, 6) END AS score FROM events")
def score_coercion(spark, folder):
    """Scores out of text: none, nan, null and the empty text are missing."""
    k = F.col("event_id") % 4
    raw = F.when(k == 0, "None").when(k == 1, "NaN").when(k == 2, "").otherwise(F.col("value").cast("string"))
    missing = F.lower(raw).isin("none", "nan", "null", "")
    return table(spark, folder, "events").select("event_id", F.round(F.when(~missing, raw.try_cast("double")), 6).alias("score"))


@query("profiling_stats", "SELECT event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS avg, round(stddev_pop(value), 6) AS std, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.9), 6) AS p90, min(value) AS least, max(value) AS most FROM events GROUP BY event_type")
def profiling_stats(spark, folder):
    """Times of each kind of stage: sums by partial aggregates, quantiles by ranks in ranges of (kind, time), exact at any size."""
    v, rows = "value", table(spark, folder, "events")
    sums = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum(v), 4).alias("total"), F.round(F.avg(v), 6).alias("avg"), F.round(F.stddev_pop(v), 6).alias("std"), F.min(v).alias("least"), F.max(v).alias("most"))
    cuts = percentiles(rows, ["event_type"], v, {"median": 0.5, "p90": 0.9})
    return sums.join(cuts, "event_type", "left").withColumns({c: F.round(c, 6) for c in ("median", "p90")})


@query("profiling_sketch", "SELECT event_type, count(*)::BIGINT AS n, true AS near, min(value) AS least, max(value) AS most FROM events GROUP BY event_type")
def profiling_sketch(spark, folder):
    """The same quantiles from sketches of every hour, merged: near says that the share of values up to each is as stated."""
    rows = table(spark, folder, "events")
    hours = sketches(rows.withColumn("hour", F.date_trunc("hour", "ts")), ["event_type", "hour"], "value")
    kinds = sketched(merged(hours, ["event_type"]), {"low": 0.1, "median": 0.5, "p90": 0.9})
    share = lambda c: F.avg((F.col("value") <= F.col(c)).cast("int"))
    near = (F.abs(share("low") - 0.1) <= SKETCH_ERROR) & (F.abs(share("median") - 0.5) <= SKETCH_ERROR) & (F.abs(share("p90") - 0.9) <= SKETCH_ERROR)
    return rows.join(kinds.drop("n"), "event_type").groupBy("event_type").agg(F.count("*").alias("n"), near.alias("near"), F.min("value").alias("least"), F.max("value").alias("most"))


PAGE_STATUS = "page_status AS (SELECT user_id AS doc_id, event_id, CASE WHEN event_id % 11 = 0 THEN 'failed' ELSE 'ok' END AS page, value > 0.999 * (SELECT max(value) FROM events) AS late FROM events)"


@query("status_rollup", f"WITH {PAGE_STATUS} SELECT doc_id, count(*) FILTER (page = 'ok')::BIGINT AS ok, count(*) FILTER (page = 'failed')::BIGINT AS failed, CASE WHEN bool_or(late) THEN 'partial_success' WHEN count(*) FILTER (page = 'ok') = 0 THEN 'failure' WHEN count(*) FILTER (page = 'failed') > 0 THEN 'partial_success' ELSE 'success' END AS status FROM page_status GROUP BY doc_id")
def status_rollup(spark, folder):
    """A document's status from its pages: late ones make it partial, as does a failed page among sound ones."""
    e = table(spark, folder, "events")
    p = e.select(F.col("user_id").alias("doc_id"), (F.col("event_id") % 11 == 0).alias("bad"), (F.col("value") > 0.999 * e.agg(F.max("value")).scalar()).alias("late"))
    ok, failed = F.count_if(~F.col("bad")), F.count_if("bad")
    return p.groupBy("doc_id").agg(ok.alias("ok"), failed.alias("failed"), F.when(F.bool_or("late"), "partial_success").when(ok == 0, "failure").when(failed > 0, "partial_success").otherwise("success").alias("status"))


@query("batch_counters", f"WITH {PAGE_STATUS}, s AS (SELECT doc_id, CASE WHEN count(*) FILTER (page = 'failed') = 0 THEN 'success' WHEN count(*) FILTER (page = 'ok') = 0 THEN 'failure' ELSE 'partial_success' END AS status FROM page_status GROUP BY doc_id) SELECT count(*) FILTER (status = 'success')::BIGINT AS success, count(*) FILTER (status = 'partial_success')::BIGINT AS partial, count(*) FILTER (status = 'failure')::BIGINT AS failure, count(*) FILTER (status = 'success')::BIGINT AS exported FROM s")
def batch_counters(spark, folder):
    """How many documents of a batch went how; only full successes are exported."""
    bad = F.col("event_id") % 11 == 0
    s = table(spark, folder, "events").groupBy("user_id").agg(F.when(F.count_if(bad) == 0, "success").when(F.count_if(~bad) == 0, "failure").otherwise("partial_success").alias("status"))
    n = lambda x: F.count_if(F.col("status") == x)
    return s.agg(n("success").alias("success"), n("partial_success").alias("partial"), n("failure").alias("failure"), n("success").alias("exported"))


@query("size_limit_status", "SELECT doc_id, CASE WHEN lang = 'es' THEN 'skipped' WHEN octet_length(encode(text)) > 6000 THEN 'failure' WHEN length(text) // 1500 + 1 > 3 THEN 'failure' WHEN length(text) // 1500 + 1 < doc_id % 3 THEN 'failure' ELSE 'success' END AS status, CASE WHEN lang = 'es' THEN 'format not allowed' WHEN octet_length(encode(text)) > 6000 THEN 'file too large' WHEN length(text) // 1500 + 1 > 3 THEN 'too many pages' WHEN length(text) // 1500 + 1 < doc_id % 3 THEN 'first page beyond the end' END AS error FROM documents")
def size_limit_status(spark, folder):
    """Formats that are not allowed are skipped; too large files, too many pages and page ranges beyond the end fail."""
    pages = F.floor(F.length("text") / 1500) + 1
    rules = [(F.col("lang") == "es", "skipped", "format not allowed"), (F.octet_length("text") > 6000, "failure", "file too large"), (pages > 3, "failure", "too many pages"), (pages < F.col("doc_id") % 3, "failure", "first page beyond the end")]
    status, error = F.lit("success"), F.lit(None).cast("string")
    for test, s, e in reversed(rules):
        status, error = F.when(test, s).otherwise(status), F.when(test, e).otherwise(error)
    return table(spark, folder, "documents").select("doc_id", status.alias("status"), error.alias("error"))


@query("page_range_filter", "SELECT l_orderkey AS doc_id, l_linenumber AS page_no, count(*)::BIGINT AS n FROM lineitem WHERE l_linenumber BETWEEN 2 AND 4 GROUP BY ALL")
def page_range_filter(spark, folder):
    """Pages of the range 2 to 4; the predicate reaches the scan."""
    return table(spark, folder, "lineitem").where(F.col("l_linenumber").between(2, 4)).groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page_no")).agg(F.count("*").alias("n"))


@query("timeout_missing_pages", "SELECT o_orderkey AS doc_id, 'document timeout exceeded' AS error FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber >= 3)")
def timeout_missing_pages(spark, folder):
    """Documents of which no third page was completed."""
    done = table(spark, folder, "lineitem").where("l_linenumber >= 3").select("l_orderkey")
    return table(spark, folder, "orders").join(done, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select(F.col("o_orderkey").alias("doc_id"), F.lit("document timeout exceeded").alias("error"))


@query("extraction_status", "SELECT user_id AS doc_id, CASE WHEN count(*) > 0 AND NOT bool_or(event_id % 9 = 0) THEN 'success' ELSE 'failure' END AS status, count(*) FILTER (event_id % 9 = 0)::BIGINT AS errors FROM events GROUP BY user_id")
def extraction_status(spark, folder):
    raw = F.when(F.col("event_id") % 9 == 0, F.left("props", F.lit(5))).otherwise(F.col("props"))
    e = table(spark, folder, "events").select("user_id", raw.alias("raw")).withColumn("bad", F.expr("try_parse_json(raw) IS NULL"))
    return e.groupBy(F.col("user_id").alias("doc_id")).agg(F.when((F.count("*") > 0) & ~F.bool_or("bad"), "success").otherwise("failure").alias("status"), F.count_if("bad").alias("errors"))


@query("content_layer_filter", "SELECT o_orderstatus AS layer, count(*)::BIGINT AS n FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1")
def content_layer_filter(spark, folder):
    """Only the layers asked for, by the exporters' own filter."""
    items = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("layer"), F.lit(None).cast("string").alias("error"))
    return serialize.of_layers(items, ("O", "P")).groupBy("layer").agg(F.count("*").alias("n"))


@query("plugin_origin_filter", "SELECT p_brand, count(*)::BIGINT AS n FROM part WHERE starts_with(p_name, 'part') OR p_size > 40 GROUP BY 1")
def plugin_origin_filter(spark, folder):
    """Plug-ins from outside (of another module than part) stay out unless they are allowed (here: sizes above 40)."""
    p = table(spark, folder, "part")
    return p.where(plugins.admitted(F.col("p_name"), "part", F.col("p_size") > 40)).groupBy("p_brand").agg(F.count("*").alias("n"))


FEED_PAGES, FEED_TIMEOUT, FEED_LATE = 4, 6 * 86400, "1 hour"
FEED = f"""feed AS (SELECT doc_id, page_no, min((ts, ok)) AS p FROM (SELECT user_id // 3 AS doc_id, (event_id % 5 + 1)::INTEGER AS page_no, ts, event_id % 11 <> 0 AS ok FROM events WHERE event_type <> 'view') WHERE page_no <= {FEED_PAGES} GROUP BY doc_id, page_no),
began AS (SELECT doc_id, min(p[1]) + INTERVAL {FEED_TIMEOUT} SECONDS AS due FROM feed GROUP BY doc_id),
held AS (SELECT f.doc_id, due, coalesce(list(page_no) FILTER (p[1] <= due), []) AS there, count(*) FILTER (p[1] <= due AND p[2]) AS ok, count(*) FILTER (p[1] <= due AND NOT p[2]) AS failed FROM feed f JOIN began USING (doc_id) GROUP BY f.doc_id, due),
rolled AS (SELECT *, list_sort(list_filter(range(1, {FEED_PAGES} + 1), lambda x: NOT list_contains(there, x::INTEGER))) AS gone FROM held)
SELECT doc_id, CASE WHEN ok = 0 THEN 'failure' WHEN len(gone) > 0 OR failed > 0 THEN 'partial_success' ELSE 'success' END AS status, ok::INTEGER AS ok, failed::INTEGER AS failed, array_to_string(gone, ',') AS missing, CASE WHEN len(gone) > 0 THEN '{pages.TOO_LATE}' END AS error FROM rolled"""


def _feed(events):
    page = (F.col("event_id") % 5 + 1).cast("int")
    return events.where("event_type <> 'view'").select(F.floor(F.col("user_id") / 3).alias("doc_id"), page.alias("page_no"), F.lit(FEED_PAGES).alias("n_pages"), "ts", (F.col("event_id") % 11 != 0).alias("ok"))


def _fed(documents):
    return documents.select("doc_id", "status", "ok", "failed", F.array_join(F.transform("missing", lambda x: x.cast("string")), ",").alias("missing"), "error")


@query("page_feed", f"WITH {FEED}")
def page_feed(spark, folder):
    """Documents out of their pages, each of which has its time: complete ones, overdue ones with what is missing."""
    return _fed(pages.documents(_feed(table(spark, folder, "events")), FEED_TIMEOUT))


@query("page_feed_stream", f"WITH {FEED} WHERE len(gone) = 0 OR due <= (SELECT max(ts) FROM events WHERE event_type <> 'view' AND event_id % 5 < {FEED_PAGES}) - INTERVAL {FEED_LATE}")
def page_feed_stream(spark, folder):
    """The same from a stream of pages: every document once, when it is complete or the watermark has passed its time."""
    place = scratch.fresh_folder(spark)
    events = spark.readStream.schema(table(spark, folder, "events").schema).parquet(f"{folder}/events.parque[t]")  # a stream's path is a folder or a pattern
    out = pages.documents_stream(_feed(events), FEED_TIMEOUT, FEED_LATE)
    out.writeStream.format("parquet").option("path", f"{place}/documents").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return _fed(spark.read.schema(pages.DOCUMENT).parquet(f"{place}/documents"))
