"""Documents out of pages that arrive one by one: a document leaves once, when all its pages are there or its time is up.

A page is (doc_id, page_no, n_pages, ts, ok): a page that was processed at ``ts``, soundly or not, of a document of ``n_pages`` pages from 1
on. A document's time begins with its earliest page and lasts ``timeout`` seconds. All its pages in time: it is a success, or a partial
success if some failed, or a failure if all did. Else it is overdue: a partial success (a failure without any sound page), and the
pages that are missing, or came too late, are its missing ones. Pages with a null in doc_id, page_no or ts, or with a number that the
document does not have, do not count; of rows that repeat a page the earliest does.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TOO_LATE = "document timeout exceeded"
DOCUMENT = "doc_id long, status string, n_pages int, ok int, failed int, missing array<int>, error string"


def _counting(pages: DataFrame) -> DataFrame:
    rows = pages.select(F.col("doc_id").cast("long"), F.col("page_no").cast("int"), F.col("n_pages").cast("int"), F.col("ts").cast("timestamp"), F.coalesce("ok", F.lit(False)).alias("ok"))
    return rows.where("doc_id IS NOT NULL AND ts IS NOT NULL AND page_no BETWEEN 1 AND n_pages")


def documents(pages: DataFrame, timeout: float, until: object | None = None) -> DataFrame:
    """The documents of a table of pages; with ``until`` (a timestamp column or literal) only those that are complete, or whose time
    was up by then."""
    once = _counting(pages).groupBy("doc_id", "page_no").agg(F.min(F.struct("ts", "ok", "n_pages")).alias("p"))
    of = once.groupBy("doc_id").agg(F.min("p.ts").alias("began"), F.max("p.n_pages").alias("n_pages"), F.collect_list(F.struct("page_no", "p.ts", "p.ok")).alias("pages"))
    due = F.col("began") + F.make_dt_interval(secs=F.lit(timeout))
    timely = of.withColumn("due", due).withColumn("pages", F.filter("pages", lambda p: p["ts"] <= F.col("due")))
    ok, failed = F.size(F.filter("pages", lambda p: p["ok"])), F.size(F.filter("pages", lambda p: ~p["ok"]))
    missing = F.array_except(F.sequence(F.lit(1), F.col("n_pages")), F.transform("pages", lambda p: p["page_no"]))
    rows = timely.withColumns({"ok": ok, "failed": failed, "missing": missing})
    if until is not None:
        rows = rows.where((F.size("missing") == 0) | (F.col("due") <= until))
    late = F.size("missing") > 0
    status = F.when(F.col("ok") == 0, "failure").when(late | (F.col("failed") > 0), "partial_success").otherwise("success")
    return rows.select("doc_id", status.alias("status"), "n_pages", "ok", "failed", "missing", F.when(late, TOO_LATE).alias("error"))


def documents_stream(pages: DataFrame, timeout: float, late: str = "10 minutes", remember: float = 86400.0) -> DataFrame:
    """The same of a stream of pages, each document once: when its last page arrives, or when the watermark (the latest ``ts`` less
    ``late``) has passed its time. What comes after that finds a mark and is left out; marks go when the watermark is ``remember``
    seconds beyond the document's time, and a page that comes later still begins a document of its own. A row that repeats a page
    with an earlier time does not count either once its document has left.

    A document's state is its pages' numbers, times and outcomes, or the mark."""
    wait, kept = int(timeout * 1_000_000), int(remember * 1_000_000)

    def row(key: int, held: dict, seen: dict[int, tuple[int, bool]], due: int) -> pd.DataFrame:
        timely = {p: good for p, (at, good) in seen.items() if at <= due}
        missing = [p for p in range(1, held["n"] + 1) if p not in timely]
        ok = sum(timely.values())
        status = "failure" if not ok else "partial_success" if missing or ok < len(timely) else "success"
        return pd.DataFrame({"doc_id": [key], "status": [status], "n_pages": [held["n"]], "ok": [ok], "failed": [len(timely) - ok], "missing": [missing], "error": [TOO_LATE if missing else None]})

    def mark(held: dict, due: int, state: GroupState) -> None:
        state.update((json.dumps({"n": held["n"], "pages": {}, "done": True}),))
        state.setTimeoutTimestamp(max((due + kept) // 1000, state.getCurrentWatermarkMs() + 1))

    def feed(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {"n": 0, "pages": {}, "done": False}
        if state.hasTimedOut:
            if held["done"]:
                state.remove()
                return
            seen = {int(p): tuple(x) for p, x in held["pages"].items()}
            due = min(at for at, _ in seen.values()) + wait
            yield row(key[0], held, seen, due)
            mark(held, due, state)
            return
        for pdf in batches:
            for page, n, ts, good in zip(pdf["page_no"].tolist(), pdf["n_pages"].tolist(), (pdf["ts"].astype("datetime64[us]").astype("int64")).tolist(), pdf["ok"].tolist()):
                held["n"] = max(held["n"], int(n))
                now = [ts, bool(good)]
                held["pages"][str(page)] = min(held["pages"].get(str(page), now), now)
        if held["done"]:
            state.update((json.dumps(held),))
            return
        seen = {int(p): tuple(x) for p, x in held["pages"].items()}
        due = min(at for at, _ in seen.values()) + wait
        if all(p in seen and seen[p][0] <= due for p in range(1, held["n"] + 1)):
            yield row(key[0], held, seen, due)
            mark(held, due, state)
            return
        state.update((json.dumps(held),))
        state.setTimeoutTimestamp(max(due // 1000, state.getCurrentWatermarkMs() + 1))

    rows = _counting(pages).withWatermark("ts", late)
    return rows.groupBy("doc_id").applyInPandasWithState(feed, DOCUMENT, "held string", "append", GroupStateTimeout.EventTimeTimeout)
