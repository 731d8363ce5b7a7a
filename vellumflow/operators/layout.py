"""Layout post-processing as relations, each step also as SQL: cells to clusters, pairs that overlap too much, connected
groups, who stands for a group, rounds of fitting and merging, special clusters and what they hold.

A cluster is (page, cid, label, confidence, l, t, r, b), a cell (page, idx, text, confidence, l, t, r, b). Everything joins
on the page first. Only connected groups of the pages that have overlaps at all need Python, an Arrow batch of pages at a time.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow import scratch
from vellumflow.functions.geometry import Box
from vellumflow.plans.options import LayoutOptions

# Least confidence of a cluster by its label.
LEAST_CONFIDENCE = {
    "caption": 0.5, "footnote": 0.5, "formula": 0.5, "list_item": 0.5, "page_footer": 0.5, "page_header": 0.5, "picture": 0.5, "section_header": 0.45, "table": 0.5, "text": 0.5,
    "title": 0.45, "code": 0.45, "checkbox_selected": 0.45, "checkbox_unselected": 0.45, "form": 0.45, "key_value_region": 0.45, "document_index": 0.45,
}
# Labels that hold other clusters; for each kind how much larger another may be and by how much more confident.
WRAPPERS = ("form", "key_value_region", "table", "document_index")
SPECIAL = (*WRAPPERS, "picture")
OVERLAP = {"regular": (1.3, 0.05), "picture": (2.0, 0.3), "wrapper": (2.0, 0.2)}
CELL_OVERLAP, CHILD_OVERLAP, SAME_IOU, SAME_PART, FULL_PAGE = 0.2, 0.8, 0.8, 0.8, 0.90
TABLE_OVERLAP, TABLE_GAP, LIKE_SIZE, CODE_PART, ROUNDS = 0.9, 0.1, 0.2, 0.8, 3
UNPLACED = 2147483647

shared_sql = lambda a, b: f"(greatest(0, least({a}.r, {b}.r) - greatest({a}.l, {b}.l)) * greatest(0, least({a}.b, {b}.b) - greatest({a}.t, {b}.t)))"
area_sql = lambda a: f"(({a}.r - {a}.l) * ({a}.b - {a}.t))"
labels_sql = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"


def _side(clusters: DataFrame, name: str, *more: str) -> DataFrame:
    return clusters.select("page", *(F.col(c).alias(f"{name}_{c}") for c in ("cid", *"ltrb", *more)))


def assign(cells: DataFrame, clusters: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page, idx, cid, part, and the columns ``keep`` of the cell): the cluster that covers most of each cell that is not blank, above
    a fifth of it; of equals the first. A join on the page with a box test, then one maximum for each cell."""
    a, b = Box.of(), Box.of("k_")
    right = clusters.select("page", "cid", *(F.col(x).alias(f"k_{x}") for x in "ltrb"))
    pairs = cells.where(F.trim("text") != "").join(right, "page").where(a.overlaps(b)).withColumn("part", a.inside(b)).where(F.col("part") > CELL_OVERLAP)
    best = F.min(F.struct((-F.round("part", 9)).alias("o"), "cid", "part")).alias("best")
    return pairs.groupBy("page", "idx").agg(best, *(F.first(c).alias(c) for c in keep)).select("page", "idx", "best.cid", "best.part", *keep)


def assign_sql(clusters: str, out: str) -> str:
    return f"""{out} AS (SELECT page, idx, cid, part FROM (SELECT *, row_number() OVER (PARTITION BY page, idx ORDER BY round(part, 9) DESC, cid) AS k FROM (
  SELECT c.page, c.idx, k.cid, {shared_sql('c', 'k')} / {area_sql('c')} AS part FROM cells c JOIN {clusters} k ON c.page = k.page
  WHERE trim(c.text) <> '' AND c.l < k.r AND c.r > k.l AND c.t < k.b AND c.b > k.t AND {shared_sql('c', 'k')} / {area_sql('c')} > {CELL_OVERLAP})) WHERE k = 1)"""


def overlaps(clusters: DataFrame) -> DataFrame:
    """(page, x, y), x < y: pairs of clusters of a page that overlap too much to be two. Two clusters made of single cells
    (column orphan, if there is one) are never such a pair."""
    more = ["orphan"] if "orphan" in clusters.columns else []
    p, q = Box.of("x_"), Box.of("y_")
    too_much = (p.iou(q) > SAME_IOU) | (p.inside(q) > SAME_PART) | (q.inside(p) > SAME_PART)
    pairs = _side(clusters, "x", *more).join(_side(clusters, "y", *more), "page").where((F.col("x_cid") < F.col("y_cid")) & p.overlaps(q) & too_much)
    if more:
        pairs = pairs.where(~(F.col("x_orphan") & F.col("y_orphan")))
    return pairs.select("page", F.col("x_cid").alias("x"), F.col("y_cid").alias("y"))


def overlaps_sql(clusters: str, out: str, orphans: bool = False) -> str:
    return f"""{out} AS (SELECT p.page, p.cid AS x, q.cid AS y FROM {clusters} p JOIN {clusters} q ON p.page = q.page AND p.cid < q.cid WHERE {"NOT (p.orphan AND q.orphan) AND " if orphans else ""}{area_sql('p')} > 0 AND {area_sql('q')} > 0
  AND ({shared_sql('p', 'q')} / ({area_sql('p')} + {area_sql('q')} - {shared_sql('p', 'q')}) > {SAME_IOU} OR {shared_sql('p', 'q')} / {area_sql('p')} > {SAME_PART} OR {shared_sql('p', 'q')} / {area_sql('q')} > {SAME_PART}))"""


def groups(pairs: DataFrame) -> DataFrame:
    """(page, cid, grp) of the clusters in ``pairs``: connected groups, named by their least cid."""

    def run(batches):
        for b in batches:
            page, cid, grp = [], [], []
            for p, listed in zip(b.column(0).to_pylist(), b.column(1)):
                up: dict[int, int] = {}

                def top(k):
                    while up.setdefault(k, k) != k:  # noqa: B023
                        k = up[k]  # noqa: B023
                    return k

                for x, y in zip(*(listed.values.field(f).to_pylist() for f in "xy")):
                    x, y = top(x), top(y)
                    up[max(x, y)] = min(x, y)
                page += [p] * len(up)
                cid += up
                grp += [top(k) for k in up]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (page, cid, grp)], ["page", "cid", "grp"])

    return pairs.groupBy("page").agg(F.collect_list(F.struct("x", "y")).alias("e")).mapInArrow(run, "page long, cid long, grp long")


def groups_sql(pairs: str, out: str) -> str:
    return f"""{out}_ways AS (SELECT page, x, y FROM {pairs} UNION SELECT page, y, x FROM {pairs}),
{out}_reach AS (SELECT page, x AS cid, x AS other FROM {out}_ways UNION SELECT r.page, r.cid, e.y FROM {out}_reach r JOIN {out}_ways e ON e.page = r.page AND e.x = r.other),
{out} AS (SELECT page, cid, min(other) AS grp FROM {out}_reach GROUP BY page, cid)"""


def chosen(members: DataFrame, kind: str) -> DataFrame:
    """(page, grp, cid, n) of who stands for each group of ``members`` (clusters with grp).

    x falls to y if x is at most ``rate`` times as large and y is more confident by more than ``gap``, except where x is a list
    item about as large as the text y, or code that contains y. Those who fall to nobody are taken in order; a larger one takes
    the place of the one before unless that is more confident by more than ``gap``. If all fall, the first stands."""
    rate, gap = OVERLAP[kind]
    x, y = Box.of("x_"), Box.of("y_")
    falls = (x.area() / y.area() <= rate) & (F.col("y_confidence") - F.col("x_confidence") > gap)
    listed = (F.col("x_label") == "list_item") & (F.col("y_label") == "text") & (F.abs(1 - x.area() / y.area()) < LIKE_SIZE)
    holds = (F.col("x_label") == "code") & (y.inside(x) > CODE_PART)
    side = lambda n: _side(members, n, "label", "confidence", "grp").withColumnRenamed(f"{n}_grp", "grp")
    fallen = side("x").join(side("y"), ["page", "grp"]).where((F.col("x_cid") != F.col("y_cid")) & falls & ~listed & ~holds).select("page", F.col("x_cid").alias("cid")).distinct()
    rows = members.join(fallen.withColumn("fallen", F.lit(True)), ["page", "cid"], "left")
    stands = F.array_sort(F.collect_list(F.when(F.col("fallen").isNull(), F.struct("cid", Box.of().area().alias("area"), "confidence"))))
    last = F.aggregate(stands, F.get(stands, F.lit(0)), lambda a, c: F.when((c["area"] > a["area"]) & (a["confidence"] - c["confidence"] <= gap), c).otherwise(a))
    return rows.groupBy("page", "grp").agg(F.coalesce(last["cid"], F.min("cid")).alias("cid"), F.count("*").alias("n"))


def chosen_sql(members: str, kind: str, out: str) -> str:
    rate, gap = OVERLAP[kind]
    return f"""{out}_fallen AS (SELECT DISTINCT x.page, x.cid FROM {members} x JOIN {members} y ON x.page = y.page AND x.grp = y.grp AND x.cid <> y.cid WHERE {area_sql('x')} / {area_sql('y')} <= {rate} AND y.confidence - x.confidence > {gap}
  AND NOT (x.label = 'list_item' AND y.label = 'text' AND abs(1 - {area_sql('x')} / {area_sql('y')}) < {LIKE_SIZE}) AND NOT (x.label = 'code' AND {shared_sql('x', 'y')} / {area_sql('y')} > {CODE_PART})),
{out} AS (SELECT m.page, m.grp, coalesce(list_reduce(list({{'cid': m.cid, 'area': {area_sql('m')}, 'confidence': m.confidence}} ORDER BY m.cid) FILTER (f.cid IS NULL), lambda a, c: CASE WHEN c.area > a.area AND a.confidence - c.confidence <= {gap} THEN c ELSE a END).cid, min(m.cid)) AS cid,
  count(*) AS n FROM {members} m LEFT JOIN {out}_fallen f ON f.page = m.page AND f.cid = m.cid GROUP BY m.page, m.grp)"""


def fitted(clusters: DataFrame, held: DataFrame, cells: DataFrame) -> DataFrame:
    """``clusters`` with boxes as large as the cells that they hold (page, cid, idx); a table never shrinks, and what
    holds none stays as it is."""
    return _fitted(clusters, _summed(held.join(cells.select("page", "idx", *"ltrb"), ["page", "idx"])))


def _summed(held: DataFrame) -> DataFrame:
    """(page, cid, n, first, u_l, u_t, u_r, u_b): what the cells of a cluster (page, cid, idx, l, t, r, b) come to."""
    return held.groupBy("page", "cid").agg(F.count("*").alias("n"), F.min("idx").alias("first"), F.min("l").alias("u_l"), F.min("t").alias("u_t"), F.max("r").alias("u_r"), F.max("b").alias("u_b"))


def _fitted(clusters: DataFrame, own: DataFrame) -> DataFrame:
    edge = lambda x, f: F.when(F.col("label") == "table", f(x, f"u_{x}")).otherwise(F.coalesce(f"u_{x}", x)).alias(x)
    rest = [c for c in clusters.columns if c not in ("l", "t", "r", "b")]
    return clusters.join(own.select("page", "cid", *(f"u_{x}" for x in "ltrb")), ["page", "cid"], "left").select(*rest, edge("l", F.least), edge("t", F.least), edge("r", F.greatest), edge("b", F.greatest))


def fitted_sql(clusters: str, held: str, out: str) -> str:
    edge = lambda x, f: f"CASE WHEN k.label = 'table' THEN {f}(k.{x}, coalesce(u.{x}, k.{x})) ELSE coalesce(u.{x}, k.{x}) END AS {x}"
    return f"""{out} AS (SELECT k.* EXCLUDE (l, t, r, b), {edge('l', 'least')}, {edge('t', 'least')}, {edge('r', 'greatest')}, {edge('b', 'greatest')} FROM {clusters} k LEFT JOIN (
  SELECT h.page, h.cid, min(c.l) AS l, min(c.t) AS t, max(c.r) AS r, max(c.b) AS b FROM {held} h JOIN cells c ON c.page = h.page AND c.idx = h.idx GROUP BY h.page, h.cid) u ON u.page = k.page AND u.cid = k.cid)"""


def merged(clusters: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """One cluster of each group of ``clusters``, and the saved table (page, cid, best) of the groups, which it reads: what the others hold is the best one's."""
    found = scratch.save(groups(overlaps(clusters)), "groups")
    best = chosen(clusters.join(found, ["page", "cid"]), kind).select("page", "grp", F.col("cid").alias("best"))
    moved = scratch.save(found.join(best, ["page", "grp"]).select("page", "cid", "best"), "moved")
    scratch.discard(found)
    return clusters.join(moved.where("cid <> best"), ["page", "cid"], "left_anti"), moved


def _moved(held: DataFrame, moved: DataFrame) -> DataFrame:
    return held.join(moved, ["page", "cid"], "left").withColumn("cid", F.coalesce("best", "cid")).drop("best")


def merged_sql(clusters: str, held: str, kind: str, name: str, orphans: bool = False) -> str:
    """CTEs {name} (clusters) and {name}_held."""
    return f"""{overlaps_sql(clusters, f'{name}_pairs', orphans)},
{groups_sql(f'{name}_pairs', f'{name}_groups')},
{name}_members AS (SELECT k.*, g.grp FROM {clusters} k JOIN {name}_groups g ON g.page = k.page AND g.cid = k.cid),
{chosen_sql(f'{name}_members', kind, f'{name}_best')},
{name}_moved AS (SELECT g.page, g.cid, b.cid AS best FROM {name}_groups g JOIN {name}_best b ON b.page = g.page AND b.grp = g.grp),
{name} AS (SELECT * FROM {clusters} k WHERE NOT EXISTS (SELECT 1 FROM {name}_moved m WHERE m.page = k.page AND m.cid = k.cid AND m.cid <> m.best)),
{name}_held AS (SELECT DISTINCT h.page, coalesce(m.best, h.cid) AS cid, h.idx FROM {held} h LEFT JOIN {name}_moved m ON m.page = h.page AND m.cid = h.cid)"""


def children(special: DataFrame, regular: DataFrame) -> DataFrame:
    """(page, special, s_label, cid, ...): regular clusters that lie with more than 0.8 of their area in a special one."""
    s = special.select("page", F.col("cid").alias("special"), F.col("label").alias("s_label"), *(F.col(x).alias(f"s_{x}") for x in "ltrb"))
    return regular.join(s, "page").where(Box.of().overlaps(Box.of("s_"))).where(Box.of().inside(Box.of("s_")) > CHILD_OVERLAP)


def like_tables(wrappers: DataFrame, tables: DataFrame) -> DataFrame:
    """(page, cid) of the wrappers that are nearly all inside a table and not clearly more confident."""
    w, t = Box.of("w_"), Box.of("t_")
    pairs = _side(wrappers, "w", "confidence").join(_side(tables, "t", "confidence"), "page").where((F.col("w_cid") != F.col("t_cid")) & w.overlaps(t))
    return pairs.where((w.inside(t) > TABLE_OVERLAP) & (F.col("w_confidence") - F.col("t_confidence") < TABLE_GAP)).select("page", F.col("w_cid").alias("cid")).distinct()


def postprocess(cells: DataFrame, clusters: DataFrame, page_area: float, options: LayoutOptions = LayoutOptions()) -> DataFrame:
    """(page, cid, label, n_cells, n_children, l, t, r, b, place) of the final clusters.

    Sure enough regular clusters get their cells; empty ones go (formulas stay), cells without a cluster become texts; up to
    three rounds fit boxes to cells and merge groups. Sure enough special clusters lose wrappers that are nearly a table and
    full-page pictures; they adopt what lies in them (forms and key-value regions take its bounds and cells), then pictures and
    wrappers are merged, each by their own thresholds. What was adopted by a special cluster that is left no longer stands by itself.
    From the assignment on, a cluster's cells are their number, their first and their bounds; no cell is read again.
    A round without a merge changes nothing more, so it is the last. Tables between the steps go as soon as the next is written;
    those that the result reads go when the application ends."""
    least = F.create_map(*(F.lit(x) for kv in LEAST_CONFIDENCE.items() for x in kv))
    sure = clusters.where(F.col("confidence") >= least[F.col("label")]).withColumn("orphan", F.lit(False))
    regular = sure.where(~F.col("label").isin(*SPECIAL)).withColumn("label", F.when(F.col("label") == "title", "section_header").otherwise(F.col("label")))
    used = []
    none = regular.limit(0).select("page", "cid", F.lit(0).cast("long").alias("idx"), *"ltrb")
    given = none if options.skip_cell_assignment else scratch.save(assign(cells, regular, tuple("ltrb")).select("page", "cid", "idx", *"ltrb"), "given")
    held = _summed(given)
    if not options.skip_cell_assignment:
        used.append(given)
        if not options.keep_empty_clusters:
            full = given.select("page", "cid").distinct().withColumn("full", F.lit(True))
            regular = regular.join(full, ["page", "cid"], "left").where((F.col("label") == "formula") | F.col("full")).drop("full")
        if options.create_orphan_clusters:
            top = clusters.groupBy("page").agg(F.max("cid").alias("top"))
            free = cells.where(F.trim("text") != "").join(given.select("page", "idx"), ["page", "idx"], "left_anti").join(top, "page", "left")
            number = F.coalesce("top", F.lit(0)) + F.row_number().over(Window.partitionBy("page").orderBy("idx"))
            orphans = scratch.save(free.select("page", number.alias("cid"), F.lit("text").alias("label"), "confidence", *"ltrb", F.lit(True).alias("orphan"), "idx"), "orphans")
            used.append(orphans)
            regular, held = regular.unionByName(orphans.drop("idx")), held.unionByName(orphans.select("page", "cid", F.lit(1).cast("long").alias("n"), F.col("idx").alias("first"), *(F.col(x).alias(f"u_{x}") for x in "ltrb")))
    held = scratch.save(held, "held")
    used.append(held)
    for _ in range(ROUNDS):
        fit = scratch.save(_fitted(regular, held), "fitted")
        regular, moved = merged(fit, "regular")
        sums = [F.sum("n").alias("n"), *(F.min(x).alias(x) for x in ("first", "u_l", "u_t")), *(F.max(x).alias(x) for x in ("u_r", "u_b"))]
        regular, held = scratch.save(regular, "regular"), scratch.save(_moved(held, moved).groupBy("page", "cid").agg(*sums), "held")
        any_merge = moved.where("cid <> best").limit(1).count()
        scratch.discard(fit, moved, *used)
        used = [regular, held]
        if not any_merge:
            break

    special = sure.where(F.col("label").isin(*SPECIAL))
    special = special.join(like_tables(special.where(F.col("label").isin(*WRAPPERS)), regular.where("label = 'table'")), ["page", "cid"], "left_anti")
    special = scratch.save(special.where(~((F.col("label") == "picture") & (Box.of().area() / page_area > FULL_PAGE))), "special")
    adopted = scratch.save(children(special, regular).select("page", "special", "s_label", "cid", *"ltrb"), "adopted")
    bounds = adopted.where(F.col("s_label").isin("form", "key_value_region")).groupBy("page", F.col("special").alias("cid")).agg(F.min("l").alias("u_l"), F.min("t").alias("u_t"), F.max("r").alias("u_r"), F.max("b").alias("u_b"))
    first_special = special
    special = scratch.save(special.join(bounds, ["page", "cid"], "left").select("page", "cid", "label", "confidence", "orphan", *(F.coalesce(f"u_{x}", x).alias(x) for x in "ltrb")), "special")
    scratch.discard(first_special)
    inside = scratch.save(adopted.join(held, ["page", "cid"]).select("page", F.col("special").alias("cid"), F.col("cid").alias("of"), "n", "first"), "inside")
    parts = [merged(special.where(F.col("label").isin(*labels)), kind) for labels, kind in ((("picture",), "picture"), (WRAPPERS, "wrapper"))]
    kept = scratch.save(parts[0][0].unionByName(parts[1][0]), "special")
    cells_of = scratch.save(_moved(inside, parts[0][1].unionByName(parts[1][1])).join(kept.select("page", "cid"), ["page", "cid"], "left_semi").distinct(), "inside")
    scratch.discard(special, inside, parts[0][1], parts[1][1])
    theirs = adopted.join(kept.select("page", F.col("cid").alias("special")), ["page", "special"], "left_semi")

    alone = regular.join(theirs.select("page", "cid").distinct(), ["page", "cid"], "left_anti")
    all_held = held.select("page", "cid", "n", "first").unionByName(cells_of.select("page", "cid", "n", "first")).groupBy("page", "cid").agg(F.min("first").alias("first"), F.sum("n").alias("n_cells"))
    n_children = theirs.groupBy("page", F.col("special").alias("cid")).agg(F.count("*").alias("n_children"))
    rows = alone.unionByName(kept).join(all_held, ["page", "cid"], "left").join(n_children, ["page", "cid"], "left")
    place = F.row_number().over(Window.partitionBy("page").orderBy(F.coalesce("first", F.lit(UNPLACED)), "t", "l", "cid"))
    return rows.select("page", "cid", "label", F.coalesce("n_cells", F.lit(0)).alias("n_cells"), F.coalesce("n_children", F.lit(0)).alias("n_children"), *"ltrb", place.alias("place"))


def postprocess_sql(page_area: float, fixtures: str) -> str:
    """postprocess() with the default options, over CTEs cells and clusters."""
    least = ", ".join(f"('{k}', {v})" for k, v in LEAST_CONFIDENCE.items())
    special, wrappers = labels_sql(SPECIAL), labels_sql(WRAPPERS)
    rounds = ",\n".join(f"{fitted_sql(f'regular{k}', f'regular{k}_held', f'fitted{k}')},\n{merged_sql(f'fitted{k}', f'regular{k}_held', 'regular', f'regular{k + 1}', True)}" for k in range(ROUNDS))
    last = f"regular{ROUNDS}"
    return f"""WITH RECURSIVE {fixtures}, least_of(label, least_confidence) AS (VALUES {least}),
sure AS (SELECT k.*, false AS orphan FROM clusters k JOIN least_of USING (label) WHERE confidence >= least_confidence),
first_regular AS (SELECT * REPLACE (CASE WHEN label = 'title' THEN 'section_header' ELSE label END AS label) FROM sure WHERE label NOT IN {special}),
{assign_sql('first_regular', 'first_held')},
tops AS (SELECT page, max(cid) AS top FROM clusters GROUP BY page),
orphans AS (SELECT c.page, coalesce(top, 0) + row_number() OVER (PARTITION BY c.page ORDER BY c.idx) AS cid, c.* EXCLUDE (page) FROM cells c LEFT JOIN tops ON tops.page = c.page WHERE trim(c.text) <> '' AND NOT EXISTS (SELECT 1 FROM first_held h WHERE h.page = c.page AND h.idx = c.idx)),
regular0 AS (SELECT page, cid, label, confidence, l, t, r, b, orphan FROM first_regular k WHERE label = 'formula' OR EXISTS (SELECT 1 FROM first_held h WHERE h.page = k.page AND h.cid = k.cid) UNION ALL SELECT page, cid, 'text', confidence, l, t, r, b, true FROM orphans),
regular0_held AS (SELECT page, cid, idx FROM first_held UNION ALL SELECT page, cid, idx FROM orphans),
{rounds},
special0 AS (SELECT * FROM sure w WHERE label IN {special} AND NOT (label = 'picture' AND {area_sql('w')} / {page_area} > {FULL_PAGE}) AND NOT (label IN {wrappers} AND EXISTS (SELECT 1 FROM {last} t WHERE t.page = w.page AND t.label = 'table' AND {shared_sql('w', 't')} / {area_sql('w')} > {TABLE_OVERLAP} AND w.confidence - t.confidence < {TABLE_GAP}))),
adopted AS (SELECT k.page, s.cid AS special, s.label AS s_label, k.cid, k.l, k.t, k.r, k.b FROM {last} k JOIN special0 s ON s.page = k.page WHERE {area_sql('k')} > 0 AND {shared_sql('k', 's')} / {area_sql('k')} > {CHILD_OVERLAP}),
bounds AS (SELECT page, special AS cid, min(l) AS l, min(t) AS t, max(r) AS r, max(b) AS b FROM adopted WHERE s_label IN ('form', 'key_value_region') GROUP BY page, special),
special1 AS (SELECT s.page, s.cid, s.label, s.confidence, coalesce(u.l, s.l) AS l, coalesce(u.t, s.t) AS t, coalesce(u.r, s.r) AS r, coalesce(u.b, s.b) AS b FROM special0 s LEFT JOIN bounds u ON u.page = s.page AND u.cid = s.cid),
inside AS (SELECT DISTINCT a.page, a.special AS cid, h.idx FROM adopted a JOIN {last}_held h ON h.page = a.page AND h.cid = a.cid),
pictures0 AS (SELECT * FROM special1 WHERE label = 'picture'), wrappers0 AS (SELECT * FROM special1 WHERE label <> 'picture'),
{merged_sql('pictures0', 'inside', 'picture', 'pictures')},
{merged_sql('wrappers0', 'inside', 'wrapper', 'wrapping')},
kept AS (SELECT * FROM pictures UNION ALL SELECT * FROM wrapping),
theirs AS (SELECT a.* FROM adopted a JOIN kept k ON k.page = a.page AND k.cid = a.special),
final AS (SELECT page, cid, label, l, t, r, b FROM {last} k WHERE NOT EXISTS (SELECT 1 FROM theirs a WHERE a.page = k.page AND a.cid = k.cid) UNION ALL SELECT page, cid, label, l, t, r, b FROM kept),
final_held AS (SELECT page, cid, idx FROM {last}_held UNION SELECT page, cid, idx FROM pictures_held UNION SELECT page, cid, idx FROM wrapping_held),
counted AS (SELECT page, cid, min(idx) AS first, count(*) AS n_cells FROM final_held GROUP BY page, cid),
owned AS (SELECT page, special AS cid, count(*) AS n_children FROM theirs GROUP BY page, special)
SELECT f.page, f.cid, f.label, coalesce(n_cells, 0)::BIGINT AS n_cells, coalesce(n_children, 0)::BIGINT AS n_children, f.l, f.t, f.r, f.b,
  row_number() OVER (PARTITION BY f.page ORDER BY coalesce(first, {UNPLACED}), t, l, f.cid)::INTEGER AS place
FROM final f LEFT JOIN counted c ON c.page = f.page AND c.cid = f.cid LEFT JOIN owned o ON o.page = f.page AND o.cid = f.cid"""
