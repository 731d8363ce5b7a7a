"""Tagged model output to document trees, and pages of such output to one document."""

from __future__ import annotations

import re

from vellumflow.sources import html, markup
from vellumflow.sources.tree import Cell, Tree

# Tags of texts and what they stand for; tags of table cells.
TEXTS = {"title": "title", "text": "text", "caption": "caption", "footnote": "footnote", "formula": "formula", "page_header": "page_header", "page_footer": "page_footer", "code": "code", "list_item": "list_item", "checkbox_selected": "checkbox_selected", "checkbox_unselected": "checkbox_unselected"}
CELLS = ("fcel", "ecel", "lcel", "ucel", "xcel", "ched", "rhed", "srow", "nl")
GRID = 500
_LOC = re.compile(r"<loc_(\d+)>")


def table(content: str) -> list[Cell]:
    """A table of cell tags: fcel a full cell, ecel an empty one, lcel and ucel the spans of the one to the left or above."""
    rows: list[list[tuple[str, str]]] = [[]]
    for tag, text in re.findall(rf"<({'|'.join(CELLS)})>([^<]*)", content):
        if tag == "nl":
            rows.append([])
        else:
            rows[-1].append((tag, text.strip()))
    cells: dict[tuple[int, int], Cell] = {}
    owner: dict[tuple[int, int], Cell] = {}
    for r, row in enumerate(x for x in rows if x):
        for c, (tag, text) in enumerate(row):
            at = (r, c - 1) if tag == "lcel" else (r - 1, c) if tag in ("ucel", "xcel") else None
            if at in owner:
                own = owner[(r, c)] = owner[at]
                own.rows, own.cols = max(own.rows, r - own.r0 + 1), max(own.cols, c - own.c0 + 1)
            else:
                owner[(r, c)] = cells[(r, c)] = Cell(r, c, text, column_header=tag == "ched", row_header=tag in ("rhed", "srow"))
    return list(cells.values())


def boxes(content: str, width: float, height: float) -> tuple[float, float, float, float] | None:
    """The box that four location tags give, on a page of this size."""
    found = [int(x) for x in _LOC.findall(content)[:4]]
    if len(found) < 4:
        return None
    return found[0] / GRID * width, found[1] / GRID * height, found[2] / GRID * width, found[3] / GRID * height


def parse(content: str, page: int = 1, tree: Tree | None = None) -> Tree:
    tree = Tree() if tree is None else tree
    body = re.sub(r"</?doctag>", "", content.split("<end_of_utterance>")[0])
    heads: dict[int, int] = {}
    group = -1
    for m in re.finditer(r"<(?P<tag>[a-z_]+?)(?:_level_(?P<level>\d+))?>(?P<inner>.*?)</(?P=tag)(?:_level_\d+)?>", body, re.S):
        tag, inner = m["tag"], m["inner"]
        text = re.sub(r"<[^>]+>", "", inner).strip()
        up = heads[max(heads)] if heads else -1
        if tag in ("ordered_list", "unordered_list"):
            group = tree.add("list", "ordered list" if tag == "ordered_list" else "list", up, page=page, enumerated=tag == "ordered_list")
            for n, item in enumerate(re.findall(r"<list_item>(.*?)</list_item>", inner, re.S), 1):
                tree.add("list_item", re.sub(r"<[^>]+>", "", item).strip(), group, page=page, enumerated=tag == "ordered_list", marker=f"{n}." if tag == "ordered_list" else "-")
        elif tag == "section_header":
            level = int(m["level"] or 1)
            heads = {k: v for k, v in heads.items() if k < level}
            heads[level] = tree.add("section_header", text, heads[max(heads)] if heads else -1, page=page, level=level)
        elif tag in ("otsl", "table"):
            tree.add("table", None, up, page=page, cells=table(inner))
        elif tag in ("picture", "chart"):
            at = tree.add("picture", None, up, page=page)
            if found := re.search(r"<caption>(.*?)</caption>", inner, re.S):
                tree.add("caption", re.sub(r"<[^>]+>", "", found[1]).strip(), at, page=page)
        elif tag in TEXTS and text:
            layer = "furniture" if tag in ("page_header", "page_footer") else "body"
            tree.add(TEXTS[tag], text, up, page=page, layer=layer)
    return tree


def pages(answers: list[str | None], kind: str = "doctags") -> Tree:
    """One document of a model's answers for its pages, in order; each page is read as what the model was asked for."""
    out = Tree()
    for n, answer in enumerate(answers, 1):
        if kind == "doctags":
            parse(answer or "", n, out)
            continue
        fenced = re.match(r"^```(?:\w*\n)?(.*?)```(\n)*$", answer or "", re.S)
        text = fenced[1] if fenced else answer or ""
        one = markup.markdown(text) if kind == "markdown" else html.parse(text)
        base = len(out.items)
        for x in one.items:
            x.parent, x.page = (x.parent + base if x.parent >= 0 else -1), n
            out.items.append(x)
    return out
