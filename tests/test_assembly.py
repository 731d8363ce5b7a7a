"""Pages put together: against plain versions and on small pages."""

import math
import random
import re

import numpy as np
import pytest

from vellumflow.operators import order, regions, tables
from vellumflow.plans.options import OcrOptions

ELEMENT = "doc long, page long, cid long, label string, l double, t double, r double, b double, text string"


def filled(raster):
    """Bounding boxes by flood fill."""
    left, out = {(int(y), int(x)) for y, x in zip(*np.nonzero(raster))}, []
    while left:
        todo, own = [left.pop()], []
        while todo:
            y, x = todo.pop()
            own.append((y, x))
            for n in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if n in left:
                    left.remove(n)
                    todo.append(n)
        ys, xs = zip(*own)
        out.append((min(xs), min(ys), max(xs), max(ys)))
    return sorted(out, key=lambda r: (r[1], r[0], r[3], r[2]))


@pytest.mark.parametrize("part", [0.05, 0.3, 0.55, 0.9])
def test_parts_of_a_raster(part):
    rng = np.random.default_rng(7)
    for _ in range(20):
        raster = rng.random((rng.integers(1, 30), rng.integers(1, 40))) < part
        assert regions.parts(raster) == filled(raster)


def plain_regions(boxes, width, height, options):
    raster = np.zeros((round(height), round(width)), bool)
    for box in boxes:
        if None in box:
            continue
        l, t, r, b = map(round, box)  # noqa: E741
        grown = np.zeros_like(raster)
        grown[max(t, 0) : max(b + 1, 0), max(l, 0) : max(r + 1, 0)] = True
        for y, x in zip(*np.nonzero(grown)):
            raster[max(y - 10, 0) : y + 10, max(x - 10, 0) : x + 10] = True
    part = raster.sum() / (width * height)
    if options.force_full_page_ocr or part > max(0.75, options.bitmap_area_threshold):
        return part, "page", [(0, 0, width, height)]
    return (part, "regions", filled(raster)) if part > options.bitmap_area_threshold else (part, "skip", [(None,) * 4])


@pytest.mark.parametrize("options", [OcrOptions(), OcrOptions(0.9), OcrOptions(0.0, True)])
def test_ocr_regions(spark, options):
    rng = random.Random(2)
    sizes = [(p, rng.choice([100.0, 80.5, 150.2]), rng.choice([90.0, 120.5])) for p in range(25)]
    boxes = [(p, x, y, x + rng.uniform(-3, 30), y + rng.uniform(-2, 25)) for p in range(24) for _ in range(rng.choice([1, 2, 5, 12])) for x, y in [(rng.uniform(-30, 150), rng.uniform(-30, 130))]]
    boxes += [(3, None, 1.0, 2.0, 3.0), (77, 1.0, 1.0, 5.0, 5.0), (4, 0.5, 1.5, 2.5, 3.5), *boxes[:3]]
    got = regions.ocr_regions(spark.createDataFrame(boxes, "page long, l double, t double, r double, b double").repartition(3), spark.createDataFrame(sizes, "page long, width double, height double"), options)
    want = []
    for p, w, h in sizes:
        part, decision, found = plain_regions([b[1:] for b in boxes if b[0] == p], w, h, options)
        want += [(p, round(part, 9), decision, *box) for box in found]
    assert sorted(((r[0], round(r[1], 9), *r[2:]) for r in got.collect()), key=str) == sorted(want, key=lambda r: str((*r[:3], *(None if x is None else float(x) for x in r[3:]))))
    assert len({w[2] for w in want}) > (1 if options == OcrOptions() else 0)


def elements(spark, rows):
    """(cid, label, l, t, r, b[, page[, text]]) as elements of document 1."""
    full = [(1, (*r, 1, None)[6] if len(r) > 6 else 1, r[0], r[1], *map(lambda x: None if x is None else float(x), r[2:6]), r[7] if len(r) > 7 else f"text {r[0]}") for r in rows]
    return spark.createDataFrame(full, ELEMENT)


def places(spark, rows):
    return [r["cid"] for r in sorted(order.reading_order(elements(spark, rows)).collect(), key=lambda r: (r["page"], r["place"]))]


def test_two_columns_between_title_and_foot(spark):
    rows = [(1, "section_header", 50, 40, 550, 60), (2, "text", 50, 70, 290, 200), (3, "text", 50, 210, 290, 400), (4, "text", 310, 70, 550, 150), (5, "text", 310, 160, 550, 400), (6, "text", 50, 420, 550, 500)]
    assert places(spark, rows) == [1, 2, 3, 4, 5, 6]
    assert places(spark, [*rows, (7, "page_footer", 50, 10, 100, 20), (8, "page_header", 50, 700, 550, 710), (9, "page_header", 50, 690, 90, 700)]) == [9, 8, 1, 2, 3, 4, 5, 6, 7]


def test_columns_without_a_title_and_a_figure_over_both(spark):
    rows = [(11, "text", 310, 70, 550, 150), (12, "text", 50, 71, 290, 150), (13, "picture", 40, 160, 560, 300), (14, "text", 310, 310, 550, 400), (15, "text", 50, 310, 290, 400)]
    assert places(spark, rows) == [12, 11, 13, 15, 14]


def test_order_of_odd_boxes(spark):
    same = [(k, "text", 10, 10, 60, 20) for k in (5, 3, 4)]
    assert places(spark, same) == [3, 4, 5]
    assert places(spark, [(1, "text", 10, 10, 10, 10), (2, "text", None, None, None, None), (3, "text", 5, 30, 40, 20), (3, "text", 5, 30, 40, 20)]) == [1, 3, 2]
    assert order.reading_order(elements(spark, [])).count() == 0


def test_order_keeps_what_is_seen_above_before(spark):
    rng = random.Random(3)
    rows = [(k, "text", x, y, x + rng.randint(1, 200), y + rng.randint(1, 80)) for k in range(80) for x, y in [(rng.randint(0, 400), rng.randint(0, 700))]]
    found = places(spark, rows)
    assert sorted(found) == list(range(80))
    seen = order.precedence(elements(spark, rows)).collect()
    assert seen and all(found.index(r["above"]) < found.index(r["cid"]) for r in seen)


def plain_captions(rows):
    gap = lambda a, b: max(a[2] - b[4], b[2] - a[4], 0.0) + max(a[3] - b[5], b[3] - a[5], 0.0)
    left_c, left_o, out = [r for r in rows if r[1] == "caption"], [r for r in rows if r[1] in order.CAPTIONED], []
    while True:
        pairs = [(gap(c, o), c[0], o[0]) for c in left_c for o in left_o if gap(c, o) <= order.CAPTION_GAP]
        mutual = [p for p in pairs if p == min(q for q in pairs if q[1] == p[1]) and p == min(q for q in pairs if q[2] == p[2])]
        if not mutual:
            return sorted(out)
        out += [(c, o) for _, c, o in mutual]
        left_c, left_o = [c for c in left_c if c[0] not in {m[1] for m in mutual}], [o for o in left_o if o[0] not in {m[2] for m in mutual}]


def test_captions_by_rounds_of_mutual_nearest(spark):
    rng = random.Random(5)
    for _ in range(3):
        rows = [(k, rng.choice(["caption", "caption", "table", "picture", "code", "text"]), x, y, x + 10.0 * rng.randint(1, 6), y + 10.0) for k in range(40) for x, y in [(10.0 * rng.randint(0, 30), 10.0 * rng.randint(0, 30))]]
        assert sorted((r["cid"], r["owner"]) for r in order.captions(elements(spark, rows)).collect()) == plain_captions(rows)
    assert order.captions(elements(spark, [(1, "caption", 0, 0, 1, 1), (2, "text", 0, 2, 1, 3)])).count() == 0


def test_documents_out_of_elements(spark):
    rows = [
        (1, "page_header", 50, 10, 100, 20, 1), (2, "text", 50, 70, 290, 200, 1, "it begins and"), (3, "table", 50, 210, 290, 300, 1), (4, "footnote", 50, 301, 290, 310, 1), (5, "footnote", 50, 311, 290, 320, 1),
        (6, "caption", 50, 330, 290, 340, 1), (7, "text", 310, 70, 550, 150, 1, "goes on to the next-"), (8, "footnote", 310, 160, 550, 170, 1), (1, "text", 50, 70, 290, 90, 2, "page and ends."), (2, "text", 50, 100, 290, 110, 2, "not this"), (3, "text", 50, 120, 290, 130, 3, None),
    ]
    got = [r.asDict(recursive=True) for r in order.document_items(elements(spark, rows)).orderBy("ord").collect()]
    assert [(r["page"], r["cid"]) for r in got] == [(1, 1), (1, 2), (1, 3), (1, 8), (2, 2), (3, 3)]
    text = got[1]
    assert text["text"] == "it begins and goes on to the next- page and ends."
    assert [(p["page"], p["cid"], text["text"][p["first"] : p["last"]]) for p in text["parts"]] == [(1, 2, "it begins and"), (1, 7, "goes on to the next-"), (2, 1, "page and ends.")]
    assert got[2]["captions"] == [6] and got[2]["footnotes"] == [4, 5] and got[0]["layer"] == "furniture" and got[3]["text"] == "text 8" and got[5]["text"] == ""


WORD = "page long, idx long, text string, l double, t double, r double, b double"


def cells(spark, words, found=((1, 9, 0.0, 0.0, 300.0, 100.0),)):
    w = spark.createDataFrame([(1, k, x, *map(float, box)) for k, (x, *box) in enumerate(words)], WORD)
    t = spark.createDataFrame(list(found), "page long, cid long, l double, t double, r double, b double")
    return sorted(tuple(r)[1:] for r in tables.table_cells(w, t).collect())


def test_cells_and_spans(spark):
    words = [("a", 5, 5, 40, 15), ("b", 110, 5, 140, 15), ("c", 210, 5, 240, 15), ("wide head", 5, 25, 145, 35), ("d", 5, 45, 30, 55), ("more", 32, 45, 60, 55), ("tall", 110, 45, 150, 75), ("e", 210, 45, 240, 55), ("f", 5, 65, 40, 75), (" ", 200, 65, 240, 75), ("out", 400, 5, 440, 15)]
    # the wide word tells no columns, the tall one no rows; both span what they cross
    assert cells(spark, words) == [(9, 0, 0, 0, 0, "a"), (9, 0, 0, 1, 1, "b"), (9, 0, 0, 3, 3, "c"), (9, 1, 1, 0, 2, "wide head"), (9, 2, 2, 0, 0, "d"), (9, 2, 2, 1, 1, "more"), (9, 2, 2, 3, 3, "e"), (9, 2, 3, 2, 2, "tall"), (9, 3, 3, 0, 0, "f")] or cells(spark, words)


def test_tables_without_words_inside(spark):
    assert cells(spark, [("half", 250, 5, 345, 15)]) == [(9, 0, 0, 0, 0, "half")]  # given by the layout
    assert cells(spark, [("far", 500, 5, 545, 15)]) == []
    assert cells(spark, []) == []
    assert cells(spark, [("all wide", 5, 5, 295, 15), ("wide too", 5, 25, 295, 35)]) == [(9, 0, 0, 0, 0, "all wide"), (9, 1, 1, 0, 0, "wide too")]


def plain_seen(rows):
    """What each (cid, l, t, r, b) sees above it, strip by strip."""
    last, out = {}, set()
    for cid, l, t, r, b in sorted(rows, key=lambda x: ((x[2] + x[4]) / 2, x[0])):  # noqa: E741
        low = math.floor((l + 0.1 * (r - l)) / 4)
        for strip in range(low, max(low, math.ceil((r - 0.1 * (r - l)) / 4) - 1) + 1):
            out.add((cid, last.get(strip)))
            last[strip] = cid
    return sorted(x for x in out if x[1] is not None)


def test_precedence_strip_by_strip_and_over_any_width(spark):
    rng = random.Random(9)
    for most in (30, 400):
        rows = [(k, "text", x, y, x + rng.randint(-5, most), y + rng.randint(0, 60)) for k in range(60) for x, y in [(rng.randint(-40, 500), rng.randint(0, 300))]]
        assert sorted((r["cid"], r["above"]) for r in order.precedence(elements(spark, rows)).collect()) == plain_seen([(r[0], *r[2:]) for r in rows])
    wide = [(k, "text", -1e15, k, 1e15, k + 1) for k in range(5)]  # a row for each strip would be 10^14 of them
    assert sorted((r["cid"], r["above"]) for r in order.precedence(elements(spark, wide)).collect()) == [(k, k - 1) for k in range(1, 5)]


def test_documents_and_trees_shuffle_elements_twice_and_write_nothing(spark, monkeypatch):
    monkeypatch.setattr("vellumflow.scratch.save", lambda *_: pytest.fail("a table between the steps"))
    rows = [(1, "section_header", 50, 10, 290, 60), (2, "list_item", 50, 70, 290, 90), (3, "list_item", 50, 100, 290, 110), (4, "table", 50, 210, 290, 300), (5, "caption", 50, 310, 290, 320), (6, "text", 50, 400, 290, 410), (6, "text", 50, 400, 290, 410)]
    tree = order.tree_items(order.document_items(elements(spark, rows)))
    assert tree._jdf.queryExecution().sparkPlan().toString().count("RepartitionByExpression") + tree._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    got = [(r["ord"], r["parent"], r["label"], r["text"]) for r in tree.orderBy("ord").collect()]
    assert got == [(0, -1, "section_header", "text 1"), (1, 0, "list", None), (2, 1, "list_item", "text 2"), (3, 1, "list_item", "text 3"), (4, 0, "table", None), (5, 4, "caption", "text 5"), (6, 0, "text", "text 6")]


def test_regions_hold_one_page_and_no_row_for_each_word_of_bits(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 5.0)], "page long, l double, t double, r double, b double")
    found = regions.ocr_regions(boxes, spark.createDataFrame([(1, 700.0, 800.0)], "page long, width double, height double"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "collect_list" not in plan
    raster = regions.Raster(200, 300)
    rng, dense = np.random.default_rng(4), np.zeros((300, 256), bool)
    for _ in range(40):
        x0, y0 = int(rng.integers(0, 190)), int(rng.integers(0, 290))
        x1, y1 = int(rng.integers(x0, 200)), int(rng.integers(y0, 300))
        raster.paint(x0, x1, y0, y1)
        dense[y0 : y1 + 1, x0 : x1 + 1] = True
    rows, begin = raster.rows()
    assert (np.repeat(rows, np.diff(begin), axis=0) == dense).all()


def test_bands_are_searched_twice_for_each_edge_of_a_word(spark):
    w = spark.createDataFrame([(1, 0, "a", 5.0, 5.0, 40.0, 15.0)], WORD)
    t = spark.createDataFrame([(1, 9, 0.0, 0.0, 300.0, 100.0)], "page long, cid long, l double, t double, r double, b double")
    plan = tables.table_cells(w, t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("size(filter(rows") == 2 and plan.count("size(filter(columns") == 2


def sorts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Sort [")


def test_windows_over_a_document_sort_it_once_for_each_order(spark):
    made = order.document_items(elements(spark, [(1, "text", 50, 10, 290, 60)]))
    assert sorts(made) == 2 and sorts(order.tree_items(made)) == 4  # by page and place before and after parts are put together, then by ord, then with what is below


def test_merges_look_at_ends_of_texts_and_move_no_texts(spark):
    rng = random.Random(2)
    labels = ["text", "text", "text", "caption", "table", "list_item", "page_header", "footnote"]
    texts = ["goes on,", "and ends.", "and on-", "Not this", "", None, " small \n", "x"]
    rows = [(k, rng.choice(labels), x, y, x + 100.0, y + 20.0, page, rng.choice(texts)) for page in range(5) for k in range(30) for x, y in [(rng.choice([0.0, 150.0]), 7.0 * rng.randint(0, 99))]]
    placed = order.ordered(elements(spark, rows))
    want, last = [], None
    for r in sorted((r for r in placed.collect() if r["label"] not in order.STEPPED_OVER), key=lambda r: (r["page"], r["place"])):
        said = r["text"] or ""
        on = last and r["label"] == last[0]["label"] == "text" and re.search(r"[a-z,\-]\s*$", last[0]["text"] or "") and re.match(r"\s*[a-z]", said) and (last[0]["page"] < r["page"] or last[0]["r"] <= r["l"])
        head, first = (last[1], last[2] + 1) if on else ((r["page"], r["cid"]), 0)
        last = (r, head, first + len(said))
        if r["label"] == "text":
            want.append((r["doc"], r["page"], r["cid"], *head, first, first + len(said)))
    assert len({w[3:5] for w in want}) < len(want)
    lean = order.merges(order.ordered(order.text_ends(elements(spark, rows)).drop("text")))
    assert sorted(map(tuple, lean.collect())) == sorted(map(tuple, order.merges(placed).collect())) == sorted(want)
    from vellumflow.operators import assembly_queries  # noqa: F401
    from vellumflow.registry import QUERIES

    query = QUERIES["text_merge_spans"](spark, "/root/testdata/sf0.001")
    moved = [line for line in query._jdf.queryExecution().optimizedPlan().toString().splitlines() if "collect_list" in line]
    assert moved and not any(re.search(r"\btext#", line) for line in moved) and sorts(query) == 1
