"""Reading order of the elements of pages, captions and footnotes with their owners, texts that go on over columns and pages.

An element is (page, cid, label, l, t, r, b), with the origin at the top left; documents add (doc, text). All but two steps are
relations; the numbering of a page and the matching of its captions are folds of small numbers, an Arrow batch of pages at a time, and what
an element sees above it is a fold over a page's elements as they pass.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from vellumflow.sources.tree import ITEM_FIELDS

# Labels that stand at the edge of a page, that can own captions and footnotes, that merged texts step over.
HEADER, FOOTER = "page_header", "page_footer"
CAPTIONED, FOOTNOTED = ("table", "picture", "code"), ("table", "picture")
OUTSIDE_LISTS, WITHOUT_TEXT = ("table", "picture", "code", "form", "key_value_region", "document_index"), ("table", "picture", "form", "key_value_region", "document_index", "formula", "list")
STEPPED_OVER = (HEADER, FOOTER, "table", "picture", "caption", "footnote")
#: Width of the strips in which one element sees another above it, and the part of an element's width that does not count, at either side.
STRIP, MARGIN = 4, 0.1
#: How far a caption may be from what it belongs to, in points.
CAPTION_GAP = 60

_list = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"


def _body(label: Column) -> Column:
    return ~label.isin(HEADER, FOOTER) & F.col("l").isNotNull() & F.col("t").isNotNull() & F.col("r").isNotNull() & F.col("b").isNotNull()


def _spans() -> list[Column]:
    """The height of an element's centre and the first and last strip of its middle part."""
    width = F.col("r") - F.col("l")
    low = F.floor((F.col("l") + MARGIN * width) / STRIP)
    return [((F.col("t") + F.col("b")) / 2).cast("double").alias("y"), low.alias("low"), F.greatest(low, F.ceil((F.col("r") - MARGIN * width) / STRIP) - 1).alias("high")]


class Sky:
    """Who was seen last in each strip, as runs of strips: as many runs as it takes, however wide an element is."""

    def __init__(self):
        self.starts, self.last = [float("-inf")], [None]

    def put(self, low: int, high: int, name: int | None) -> set[int | None]:
        """Those that ``name`` sees from the strips ``low`` to ``high``, where it is the last from now on."""
        i, j = bisect_right(self.starts, low) - 1, bisect_left(self.starts, high + 1)
        seen = set(self.last[i:j])
        goes_on = j == len(self.starts) or self.starts[j] != high + 1
        i += self.starts[i] < low
        self.last[i:j] = [name, self.last[j - 1]] if goes_on else [name]
        self.starts[i:j] = [low, high + 1] if goes_on else [low]
        return seen


def precedence(elements: DataFrame) -> DataFrame:
    """(page, cid, above): the elements that an element sees above it.

    An element covers the vertical strips of its middle part; in a strip elements stand in order of their centre's height (equal: of
    cid), and each sees the one before. Every such pair runs down the page in that order, so there are no cycles, overlapping
    elements included. Page headers and footers and elements without a box see nothing and are not seen. A page's elements pass one by one
    in that order, and only the runs of its strips are held; no strip is a row."""
    rows = elements.where(_body(F.col("label"))).select("page", "cid", *_spans()).repartition("page").sortWithinPartitions("page", "y", "cid").select("page", "cid", "low", "high")

    def run(batches):
        page, sky = None, Sky()
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for p, cid, low, high in zip(*(b.column(k).to_pylist() for k in range(4))):
                if p != page:
                    page, sky = p, Sky()
                for above in sky.put(low, high, cid):
                    if above is not None:
                        for c, x in zip(out, (p, cid, above)):
                            c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, b.column(min(k, 1)).type) for k, c in enumerate(out)], ["page", "cid", "above"])

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page {kind['page']}, cid {kind['cid']}, above {kind['cid']}").distinct()


def precedence_sql(elements: str, out: str) -> str:
    return f"""{out} AS (SELECT DISTINCT page, cid, above FROM (SELECT page, cid, lag(cid) OVER (PARTITION BY page, strip ORDER BY y, cid) AS above FROM (
  SELECT page, cid, (t + b) / 2 AS y, unnest(range(low, greatest(low, high) + 1)) AS strip FROM (SELECT *, floor((l + {MARGIN} * (r - l)) / {STRIP})::BIGINT AS low, ceil((r - {MARGIN} * (r - l)) / {STRIP})::BIGINT - 1 AS high FROM {elements} WHERE label NOT IN {_list((HEADER, FOOTER))}))) WHERE above IS NOT NULL)"""


def numbered(rows: list[tuple]) -> list[int]:
    """Places (from 1) of (kind, l, t, cid, above) rows of a page: headers, then the body, then footers.

    Of the body's elements whose elements above all have a place, the next is the one below the latest placed (so a column is
    read to its end before the next one begins), of several the leftmost, then the topmost."""
    far = float("inf")
    key = [(far if r[1] is None else r[1], far if r[2] is None else r[2], r[3]) for r in rows]
    edge = lambda kind: sorted((k for k, r in enumerate(rows) if r[0] == kind), key=lambda k: (key[k][1], key[k][0], key[k][2]))
    order = edge(0)
    at = {r[3]: k for k, r in enumerate(rows) if r[0] == 1}
    below: dict[int, list[int]] = {}
    waits = [len(r[4] or ()) for r in rows]
    for k, r in enumerate(rows):
        for above in r[4] or ():
            below.setdefault(at[above], []).append(k)
    free = [(0, key[k], k) for k, r in enumerate(rows) if r[0] == 1 and not waits[k]]
    heapq.heapify(free)
    while free:
        *_, k = heapq.heappop(free)
        order.append(k)
        for j in below.get(k, ()):
            waits[j] -= 1
            if not waits[j]:
                heapq.heappush(free, (-len(order), key[j], j))
    place = [0] * len(rows)
    for n, k in enumerate(order + edge(2), 1):
        place[k] = n
    return place


def _places(kinds: list[int], ls: list, ts: list, cids: list[int], bodies: list[bool], ys: list, lows: list, highs: list) -> list[int]:
    """numbered() of the rows of a page in order of cid: the first row of a cid has its place, those that repeat it minus that."""
    first = [k for k in range(len(cids)) if not k or cids[k] != cids[k - 1]]
    sky, above = Sky(), {}
    for k in sorted((k for k in first if bodies[k]), key=lambda k: (ys[k] != ys[k], ys[k], cids[k])):  # NaN last
        above[k] = sky.put(lows[k], highs[k], cids[k]) - {None}
    of = dict(zip((cids[k] for k in first), numbered([(kinds[k], ls[k], ts[k], cids[k], above.get(k)) for k in first])))
    own = set(first)
    return [of[c] if k in own else -of[c] for k, c in enumerate(cids)]


def _doubles(edge: str) -> Column:
    return F.transform(f"rows.{edge}", lambda x: x.cast("double"))


def _pages(elements: DataFrame) -> DataFrame:
    """(doc if there is one, page, rows, place): the elements of each page in order of cid and their places, of repeated ones negative.

    A page is one row here, in the order of its cids; Python gets its boxes, not its texts."""
    by = [c for c in ("doc", "page") if c in elements.columns]
    kind = F.when(F.col("label") == HEADER, 0).when(F.col("label") == FOOTER, 2).otherwise(1).alias("kind")
    rest = [c for c in elements.columns if c not in (*by, "cid", "label", *"ltrb")]
    row = F.struct(F.col("cid").cast("long").alias("cid"), "label", *"ltrb", *rest, kind, F.coalesce(_body(F.col("label")), F.lit(False)).alias("body"), *_spans())
    listed = elements.repartition("page").groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("rows"))

    @F.arrow_udf("array<int>")
    def place(kind: pa.Array, l: pa.Array, t: pa.Array, cid: pa.Array, body: pa.Array, y: pa.Array, low: pa.Array, high: pa.Array) -> pa.Array:  # noqa: E741
        columns, out = [c.to_pylist() for c in (kind, l, t, cid, body, y, low, high)], []
        for page in zip(*columns):
            out.append(_places(*page))
        return pa.array(out, pa.list_(pa.int32()))

    return listed.withColumn("place", place("rows.kind", _doubles("l"), _doubles("t"), "rows.cid", "rows.body", "rows.y", "rows.low", "rows.high"))


def ordered(elements: DataFrame) -> DataFrame:
    """``elements`` with their places: of rows of a page that repeat a cid the first is left. A page is in one document."""
    rows = _pages(elements).withColumn("z", F.explode(F.arrays_zip("rows", "place"))).where("z.place > 0")
    return rows.select(*(c if c in ("doc", "page") else F.col(f"z.rows.{c}").alias(c) for c in elements.columns), F.col("z.place").alias("place"))


def reading_order(elements: DataFrame) -> DataFrame:
    """(page, cid, place): places from 1 on each page. cids differ within a page; of rows that repeat one the first counts."""
    return ordered(elements.select("page", "cid", "label", *"ltrb")).select("page", "cid", "place")


def reading_order_sql(elements: str, out: str) -> str:
    """CTE ``out`` (page, cid, place) of reading_order(), element by element."""
    edge = lambda label: f"(SELECT page, cid, row_number() OVER (PARTITION BY page ORDER BY t, l, cid) AS n FROM {elements} WHERE label = '{label}')"
    return f"""{precedence_sql(elements, f'{out}_seen')},
{out}_body AS (SELECT e.page, e.cid, e.l, e.t, coalesce(list(s.above) FILTER (s.above IS NOT NULL), []) AS above FROM {elements} e LEFT JOIN {out}_seen s ON s.page = e.page AND s.cid = e.cid WHERE label NOT IN {_list((HEADER, FOOTER))} GROUP BY ALL),
{out}_steps AS (SELECT DISTINCT page, 0 AS n, []::BIGINT[] AS placed FROM {out}_body
  UNION ALL SELECT page, n + 1, list_append(placed, next.cid) FROM (SELECT s.page, s.n, s.placed, min({{'k': -coalesce(list_max(list_transform(b.above, lambda x: list_position(s.placed, x))), 0), 'l': b.l, 't': b.t, 'cid': b.cid}}) AS next
    FROM {out}_steps s JOIN {out}_body b ON b.page = s.page WHERE NOT list_contains(s.placed, b.cid) AND list_has_all(s.placed, b.above) GROUP BY s.page, s.n, s.placed)),
{out}_last AS (SELECT page, unnest(placed) AS cid, unnest(range(1, len(placed) + 1)) AS n FROM {out}_steps WHERE (page, n) IN (SELECT (page, max(n)) FROM {out}_steps GROUP BY page)),
{out} AS (SELECT page, cid, row_number() OVER (PARTITION BY page ORDER BY kind, n)::INTEGER AS place FROM (SELECT *, 0 AS kind FROM {edge(HEADER)} UNION ALL SELECT *, 1 FROM {out}_last UNION ALL SELECT *, 2 FROM {edge(FOOTER)}))"""


def _gap(a: str, b: str) -> Column:
    along = lambda low, high: F.greatest(F.col(f"{a}{low}") - F.col(f"{b}{high}"), F.col(f"{b}{low}") - F.col(f"{a}{high}"), F.lit(0.0))
    return along("l", "r") + along("t", "b")


def _far(a: tuple, b: tuple) -> float:
    """_gap() of two boxes: a null edge does not count, what is not a number is far."""
    out = 0.0
    for low, high in ((0, 2), (1, 3)):
        apart = [x - y for x, y in ((a[low], b[high]), (b[low], a[high])) if x is not None and y is not None]
        out += math.nan if any(map(math.isnan, apart)) else max([0.0, *apart])
    return out


def _matched(pairs: list[dict]) -> dict[int, int]:
    """Captions with their owners, out of a page's pairs in order of (gap, cid, owner): the least pair that is left is each other's nearest."""
    found: dict[int, int] = {}
    taken: set[int] = set()
    for pair in pairs:
        if pair["cid"] not in found and pair["owner"] not in taken:
            found[pair["cid"]] = pair["owner"]
            taken.add(pair["owner"])
    return found


def _owners(labels: list[str], cids: list[int], *edges: list) -> list[int | None]:
    """captions() of one page: the owner of each of its rows that is a caption with one."""
    boxes = list(zip(*edges))
    owners = [k for k, x in enumerate(labels) if x in CAPTIONED]
    near = {(gap, cids[k], cids[o]) for k, x in enumerate(labels) if x == "caption" for o in owners if (gap := _far(boxes[k], boxes[o])) <= CAPTION_GAP}
    found = _matched([{"cid": c, "owner": o} for _, c, o in sorted(near)])
    return [found.get(c) if x == "caption" else None for c, x in zip(cids, labels)]


def captions(elements: DataFrame) -> DataFrame:
    """(page, cid, owner): captions with the table, picture or code they belong to.

    A caption and an owner of its page, no farther apart than CAPTION_GAP (horizontal and vertical gap together), are a pair if each
    is the other's nearest of those that are left (equal distances: the caption, then the owner of the smaller cid); such pairs are
    taken until there are none. So a caption has one owner, an owner one caption, and one that finds none stands alone."""
    side = lambda labels, name: elements.where(F.col("label").isin(*labels)).select("page", F.col("cid").cast("long").alias(name), *(F.col(x).alias(f"{name}_{x}") for x in "ltrb"))
    near = side(["caption"], "cid").join(side(CAPTIONED, "owner"), "page").withColumn("gap", _gap("cid_", "owner_")).where(F.col("gap") <= CAPTION_GAP)
    pages = near.groupBy("page").agg(F.array_sort(F.collect_set(F.struct("gap", "cid", "owner"))).alias("pairs"))

    def run(batches):
        for b in batches:
            out: list[tuple[int, int, int]] = []
            for page, pairs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out += [(page, *found) for found in _matched(pairs).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(3)], ["page", "cid", "owner"])

    return pages.mapInArrow(run, "page long, cid long, owner long")


def captions_sql(elements: str, out: str) -> str:
    gap = "greatest(c.l - o.r, o.l - c.r, 0.0) + greatest(c.t - o.b, o.t - c.b, 0.0)"
    return f"""{out}_near AS (SELECT c.page, {gap} AS gap, c.cid, o.cid AS owner FROM {elements} c JOIN {elements} o ON o.page = c.page WHERE c.label = 'caption' AND o.label IN {_list(CAPTIONED)} AND {gap} <= {CAPTION_GAP}),
{out}_steps AS (SELECT DISTINCT page, []::BIGINT[] AS cids, []::BIGINT[] AS owners FROM {out}_near
  UNION ALL SELECT page, list_append(cids, next.cid), list_append(owners, next.owner) FROM (SELECT s.page, s.cids, s.owners, min({{'gap': gap, 'cid': n.cid, 'owner': n.owner}}) AS next
    FROM {out}_steps s JOIN {out}_near n ON n.page = s.page WHERE NOT list_contains(s.cids, n.cid) AND NOT list_contains(s.owners, n.owner) GROUP BY s.page, s.cids, s.owners)),
{out} AS (SELECT page, unnest(cids) AS cid, unnest(owners) AS owner FROM {out}_steps WHERE (page, len(cids)) IN (SELECT (page, max(len(cids))) FROM {out}_steps GROUP BY page))"""


def footnotes(ordered: DataFrame) -> DataFrame:
    """(page, cid, owner): footnotes that directly follow a table or picture in the reading order, or another footnote of it. Captions
    and furniture between do not count. ``ordered``: elements with place."""
    w = Window.partitionBy("page").orderBy("place")
    body = ordered.where(~F.col("label").isin(HEADER, FOOTER, "caption"))
    last = F.last(F.when(F.col("label") != "footnote", F.struct("cid", "label")), ignorenulls=True).over(w)
    return body.withColumn("last", last).where((F.col("label") == "footnote") & F.col("last.label").isin(*FOOTNOTED)).select("page", "cid", F.col("last.cid").alias("owner"))


def footnotes_sql(ordered: str, out: str) -> str:
    return f"""{out} AS (SELECT page, cid, last.cid AS owner FROM (SELECT *, last_value(CASE WHEN label <> 'footnote' THEN {{'cid': cid, 'label': label}} END IGNORE NULLS) OVER (PARTITION BY page ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last
  FROM {ordered} WHERE label NOT IN {_list((HEADER, FOOTER, 'caption'))}) WHERE label = 'footnote' AND last.label IN {_list(FOOTNOTED)})"""


def text_ends(elements: DataFrame) -> DataFrame:
    """``elements`` with what merges() looks at in their texts: size, open (may go on) and small (begins with a small letter)."""
    said = F.coalesce("text", F.lit(""))
    return elements.withColumns({"size": F.length(said), "open": said.rlike(r"[a-z,\-]\s*$"), "small": said.rlike(r"^\s*[a-z]")})


def _runs(rows: DataFrame) -> DataFrame:
    """``rows`` (with text_ends()) with flow (what texts do not step over), head_page, head, first and last, all null but for texts: see
    merges(). All windows run over a document in the one order of its pages and places, so its rows are sorted once."""
    flow = F.coalesce(~F.col("label").isin(*STEPPED_OVER), F.lit(False))
    w = Window.partitionBy("doc").orderBy("page", "place")
    upto = lambda last: w.rowsBetween(Window.unboundedPreceding, last)
    rows = rows.withColumn("flow", flow).withColumn("chars", F.sum(F.when(F.col("flow"), F.col("size") + 1)).over(upto(0)))
    rows = rows.withColumn("before", F.last(F.when(F.col("flow"), F.struct("label", "open", "page", "r", "chars")), ignorenulls=True).over(upto(-1)))
    on = (F.col("label") == "text") & (F.col("before.label") == "text") & F.col("before.open") & F.col("small") & ((F.col("before.page") < F.col("page")) | (F.col("before.r") <= F.col("l")))
    start = F.coalesce("before.chars", F.lit(0)).alias("start")
    begins = F.when(F.col("flow") & ~F.coalesce(on, F.lit(False)), F.struct("page", "cid", start))
    rows = rows.withColumn("begun", F.last(begins, ignorenulls=True).over(upto(0)))  # what begins with a text has nothing else in it
    first = (start - F.col("begun.start")).cast("long")
    of = lambda c, name: F.when(F.col("flow") & (F.col("label") == "text"), c).alias(name)
    made = [of(F.col("begun.page"), "head_page"), of(F.col("begun.cid"), "head"), of(first, "first"), of(first + F.col("size"), "last")]
    return rows.select("*", *made).drop("chars", "before", "begun")


def merges(ordered: DataFrame) -> DataFrame:
    """(doc, page, cid, head_page, head, first, last) of every text of a document: the text that it is a part of, and where it stands in it.

    A text goes on in the next one of the reading order over all pages (furniture, tables, pictures, captions and footnotes between do
    not count) if it ends in a small letter, a comma or a hyphen, that one begins with a small letter, and it lies on a later page or
    right of it. Parts are joined by a space. ``ordered``: elements with doc, place and text, or text_ends() in its stead; a null text is
    empty. Texts are not shuffled."""
    ends = ordered if "open" in ordered.columns else text_ends(ordered)
    rows = ends.where(~F.col("label").isin(*STEPPED_OVER)).select("doc", "page", "cid", "label", "l", "r", "place", "size", "open", "small")
    return _runs(rows.repartition("doc")).where("label = 'text'").select("doc", "page", "cid", "head_page", "head", "first", "last")


def merges_sql(ordered: str, out: str) -> str:
    return f"""{out}_flow AS (SELECT *, CASE WHEN label = 'text' AND lag(label) OVER w = 'text' AND regexp_matches(lag(text) OVER w, '[a-z,\\-]\\s*$') AND regexp_matches(text, '^\\s*[a-z]') AND (lag(page) OVER w < page OR lag(r) OVER w <= l) THEN 0 ELSE 1 END AS new
  FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM {ordered} WHERE label NOT IN {_list(STEPPED_OVER)}) WINDOW w AS (PARTITION BY doc ORDER BY page, place)),
{out}_runs AS (SELECT * FROM (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY page, place) AS run FROM {out}_flow) WHERE label = 'text'),
{out} AS (SELECT doc, page, cid, first_value(page) OVER c AS head_page, first_value(cid) OVER c AS head, coalesce(sum(length(text) + 1) OVER (PARTITION BY doc, run ORDER BY page, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first,
  (coalesce(sum(length(text) + 1) OVER (PARTITION BY doc, run ORDER BY page, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(text))::BIGINT AS last FROM {out}_runs WINDOW c AS (PARTITION BY doc, run ORDER BY page, place))"""


def document_items(elements: DataFrame) -> DataFrame:
    """(doc, ord, page, cid, label, layer, text, captions, footnotes, parts, said): documents as items in reading order.

    Captions and footnotes with an owner and texts that go on from another do not stand alone: owners list the cids of theirs (``said``: what
    their captions say), a text has all its parts' text, and ``parts`` says where each of them stands in it (page, cid, first, last). Page
    headers and footers are furniture. Elements are shuffled twice, by page and by document, and nothing is written between the steps."""
    @F.arrow_udf("array<long>")
    def owner(label: pa.Array, cid: pa.Array, l: pa.Array, t: pa.Array, r: pa.Array, b: pa.Array) -> pa.Array:  # noqa: E741
        return pa.array([_owners(*page) for page in zip(*(c.to_pylist() for c in (label, cid, l, t, r, b)))], pa.list_(pa.int64()))

    pages = _pages(elements).where("page IS NOT NULL").withColumn("capped", owner("rows.label", "rows.cid", *map(_doubles, "ltrb")))
    rows = pages.withColumn("z", F.explode(F.arrays_zip("rows", "place", "capped"))).where("z.place > 0 AND z.rows.cid IS NOT NULL")
    rows = rows.select("doc", "page", *(F.col(f"z.rows.{c}").alias(c) for c in ("cid", "label", "l", "r", "text")), F.col("z.place").alias("place"), F.col("z.capped").alias("capped"))
    rows = rows.repartition("doc")
    body = F.when(~F.col("label").isin(HEADER, FOOTER, "caption", "footnote"), F.struct("cid", "label"))
    last = F.last(body, ignorenulls=True).over(Window.partitionBy("doc", "page").orderBy("place"))
    noted = F.when((F.col("label") == "footnote") & F.col("last.label").isin(*FOOTNOTED), F.col("last.cid"))
    rows = _runs(text_ends(rows.withColumn("last", last).withColumn("noted", noted).drop("last")))
    # an item is what its own row, its captions, its footnotes and its parts are together
    page, cid = F.coalesce("head_page", "page").alias("at_page"), F.coalesce("capped", "noted", "head", "cid").alias("at")
    own = F.col("capped").isNull() & F.col("noted").isNull() & ((F.col("page") == F.col("head_page")) & (F.col("cid") == F.col("head")) | F.col("head").isNull())
    listed = lambda test, *columns: F.array_sort(F.collect_list(F.when(test, F.struct(*columns))))
    made = rows.select("*", page, cid, own.alias("own"), F.coalesce("text", F.lit("")).alias("said")).groupBy("doc", "at_page", "at").agg(
        F.first(F.when(F.col("own"), F.struct("place", "label", "said")), ignorenulls=True).alias("i"), listed(F.col("capped").isNotNull(), "cid", "said").alias("c"), listed(F.col("noted").isNotNull(), "cid").alias("n"),
        listed(F.col("head").isNotNull(), "first", "last", "page", "cid", "said").alias("p"),
    )
    layer = F.when(F.col("label").isin(HEADER, FOOTER), "furniture").otherwise("body").alias("layer")
    parts = F.when(F.size("p") > 0, F.transform("p", lambda x: F.struct(x["page"].alias("page"), x["cid"].alias("cid"), x["first"].alias("first"), x["last"].alias("last")))).alias("parts")
    made = made.select("doc", F.col("at_page").alias("page"), F.col("at").alias("cid"), "i.*", F.col("c.cid").alias("captions"), F.col("n.cid").alias("footnotes"), parts, F.col("c.said").alias("told"), F.when(F.size("p") > 0, F.array_join("p.said", " ")).alias("joined"))
    ord = F.row_number().over(Window.partitionBy("doc").orderBy("page", "place")).alias("ord")
    return made.select("doc", ord, "page", "cid", "label", layer, F.coalesce("joined", "said").alias("text"), "captions", "footnotes", "parts", F.col("told").alias("said"))


def tree_items(items: DataFrame) -> DataFrame:
    """document_items() as rows of a document tree: doc_id, the fields of all parsers' items, and cid.

    What follows a section header is below it; list items that follow one another, with nothing but tables, pictures, code and
    containers between, are below a list; captions are below their owners. Tables, pictures, containers and formulas have no text of their own.
    What a row is below is always the latest of its kind before it, so all of it is windows over a document."""
    w = Window.partitionBy("doc").orderBy("ord")
    rows = items.withColumn("outside", F.coalesce(F.col("label").isin(*OUTSIDE_LISTS), F.lit(True)))
    follows = F.last(F.when(~F.col("outside"), F.col("label")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("opens", ~F.col("outside") & (F.col("label") == "list_item") & (F.coalesce(follows, F.lit("")) != "list_item"))
    titled = F.col("label").eqNullSafe("section_header") & F.col("layer").eqNullSafe("body")
    rows = rows.withColumn("headed", F.coalesce(F.max(titled).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    row = lambda sub, cid, label, up, depth, text: F.struct(F.lit(sub).alias("sub"), cid.cast("long").alias("cid"), label.alias("label"), up.alias("up"), depth.alias("depth"), text.alias("text"))
    up = lambda test, name: F.when(test, F.lit(name))
    below = F.col("headed") & ~((F.col("label") == "section_header") | (F.col("layer") == "furniture"))
    deep = F.when(below, 1).otherwise(0)
    head = up(below, "head")
    made = F.array(
        F.when(F.col("opens"), row(0, F.lit(None), F.lit("list"), up(F.col("headed"), "head"), deep, F.lit(None).cast("string"))),
        F.when(F.col("label") == "list_item", row(1, F.col("cid"), F.col("label"), F.lit("list"), deep + 1, F.col("text"))).otherwise(row(1, F.col("cid"), F.col("label"), head, deep, F.col("text"))),
    )
    caps = F.transform(F.arrays_zip("captions", "said"), lambda x: row(2, x["captions"], F.lit("caption"), F.lit("owner"), deep + 1, x["said"]))
    every = rows.select("doc", "ord", "page", "layer", F.explode(F.concat(F.array_compact(made), caps)).alias("x")).select("doc", "ord", "page", "layer", "x.*")
    w = Window.partitionBy("doc").orderBy("ord", "sub", "cid")
    every = every.withColumn("n", (F.row_number().over(w) - 1).cast("int"))
    latest = lambda test: F.max(F.when(test, F.col("n"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    titled = (F.col("sub") == 1) & (F.col("label") == "section_header") & (F.col("layer") == "body")
    parent = F.when(F.col("up") == "list", latest(F.col("sub") == 0)).when(F.col("up") == "owner", latest(F.col("sub") == 1)).when(F.col("up") == "head", latest(titled))
    bare = F.col("label").isin(*WITHOUT_TEXT)
    full = every.withColumn("parent", parent).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("ord"), F.coalesce("parent", F.lit(-1)).alias("parent"), "depth", "label", F.when(F.col("label").isin("section_header", "list", "list_item"), 1).alias("level"), "layer",
        F.when(~bare, F.col("text")).alias("text"), F.when(bare, F.col("text")).alias("orig"), F.when(F.col("label") == "list_item", F.lit(False)).alias("enumerated"), F.col("page").cast("int").alias("page"), "cid",
    )
    fields = StructType.fromDDL(ITEM_FIELDS)
    return full.select("doc_id", *(F.col(f.name) if f.name in full.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields), "cid")


def tree_items_sql(items: str, elements: str, out: str) -> str:
    """CTE ``out`` (doc, n, parent, label, layer, text, page, cid); ``items`` with caps, a list of cids."""
    return f"""{out}_flow AS (SELECT doc, ord, label = 'list_item' AND coalesce(lag(label) OVER (PARTITION BY doc ORDER BY ord), '') <> 'list_item' AS opens FROM {items} WHERE label NOT IN {_list(OUTSIDE_LISTS)}),
{out}_marked AS (SELECT i.*, coalesce(opens, false) AS opens, max(CASE WHEN label = 'section_header' AND layer = 'body' THEN i.ord END) OVER (PARTITION BY i.doc ORDER BY i.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS head,
  max(CASE WHEN opens THEN i.ord END) OVER (PARTITION BY i.doc ORDER BY i.ord) AS list FROM {items} i LEFT JOIN {out}_flow f ON f.doc = i.doc AND f.ord = i.ord),
{out}_rows AS (SELECT doc, ord, page, 0 AS sub, NULL::BIGINT AS cid, 'list' AS label, layer, head AS up, 1 AS up_sub, NULL AS text FROM {out}_marked WHERE opens
  UNION ALL SELECT doc, ord, page, 1, cid, label, layer, CASE WHEN label = 'list_item' THEN list WHEN label = 'section_header' OR layer = 'furniture' THEN NULL ELSE head END, CASE WHEN label = 'list_item' THEN 0 ELSE 1 END, CASE WHEN label NOT IN {_list(WITHOUT_TEXT)} THEN text END FROM {out}_marked
  UNION ALL SELECT i.doc, i.ord, i.page, 2, e.cid, 'caption', layer, i.ord, 1, coalesce(e.text, '') FROM (SELECT doc, ord, page, layer, unnest(caps) AS cap FROM {items}) i JOIN {elements} e ON e.page = i.page AND e.cid = i.cap),
{out}_numbered AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY ord, sub, cid) - 1 AS n FROM {out}_rows),
{out} AS (SELECT r.doc, r.n, coalesce(p.n, -1) AS parent, r.label, r.layer, r.text, r.page, r.cid FROM {out}_numbered r LEFT JOIN {out}_numbered p ON p.doc = r.doc AND p.ord = r.up AND p.sub = r.up_sub AND p.sub < 2)"""
