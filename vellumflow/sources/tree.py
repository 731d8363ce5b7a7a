"""The document tree that all parsers build, and its rows."""

from __future__ import annotations

from dataclasses import dataclass, field

#: Rows of a tree: items in reading order, each with its parent's place; table cells lie in their table's row.
CELL_TYPE = "struct<r0:int,r1:int,c0:int,c1:int,text:string,column_header:boolean,row_header:boolean>"
ITEM_FIELDS = (
    "ord int, parent int, depth int, label string, level int, layer string, text string, orig string, marker string, enumerated boolean, style string, link string, language string, page int, "
    f"cells array<{CELL_TYPE}>"
)


@dataclass
class Cell:
    r0: int
    c0: int
    text: str
    rows: int = 1
    cols: int = 1
    column_header: bool = False
    row_header: bool = False


@dataclass
class Item:
    label: str
    text: str | None = None
    parent: int = -1
    depth: int = 0
    level: int | None = None
    layer: str = "body"
    orig: str | None = None
    marker: str | None = None
    enumerated: bool | None = None
    style: str | None = None
    link: str | None = None
    language: str | None = None
    page: int | None = None
    cells: list[Cell] = field(default_factory=list)


class Tree:
    """Items in the order in which they are added; ``parent`` is the place of an earlier item, or -1 for the body."""

    def __init__(self):
        self.items: list[Item] = []

    def add(self, label: str, text: str | None = None, parent: int = -1, **more) -> int:
        depth = self.items[parent].depth + 1 if parent >= 0 else 0
        self.items.append(Item(label, text, parent, depth, **more))
        return len(self.items) - 1

    def rows(self) -> list[tuple]:
        """A tuple for each item. The level of a list and of its items is the number of lists around them, itself included."""
        out, lists = [], []
        for k, x in enumerate(self.items):
            lists.append((lists[x.parent] if x.parent >= 0 else 0) + (x.label == "list"))
            if x.label in ("list", "list_item"):
                x.level = max(1, lists[k])
            cells = [(c.r0, c.r0 + c.rows, c.c0, c.c0 + c.cols, c.text, c.column_header, c.row_header) for c in x.cells] if x.label == "table" else None
            out.append((k, x.parent, x.depth, x.label, x.level, x.layer, x.text, x.orig, x.marker, x.enumerated, x.style, x.link, x.language, x.page, cells))
        return out


def grid(cells: list[Cell]) -> list[list[str]]:
    """The table as rows of texts; a cell's text stands at every place that it spans."""
    n = max((c.r0 + c.rows for c in cells), default=0)
    m = max((c.c0 + c.cols for c in cells), default=0)
    out = [[""] * m for _ in range(n)]
    for c in cells:
        for r in range(c.r0, c.r0 + c.rows):
            out[r][c.c0 : c.c0 + c.cols] = [c.text] * c.cols
    return out


def outline(tree: Tree) -> str:
    """One line for each item: its place, depth, label and text."""
    return "\n".join(f"{'  ' * x.depth}item-{k} at level {x.depth}: {x.label}" + (f": {x.text}" if x.text else "") for k, x in enumerate(tree.items))


def pipe_table(rows: list[list[str]]) -> str | None:
    """Rows as a pipe table: columns as wide as their widest cell and their header with two spaces, numbers to the right."""
    if not rows:
        return None
    rows = [[t.replace("\n", " ") for t in row] for row in rows]
    columns = range(len(rows[0]))
    wide = [max(len(rows[0][k]) + 2, *(len(row[k]) for row in rows)) for k in columns]
    right = [all(_number(row[k]) for row in rows[1:] if row[k]) and any(row[k] for row in rows[1:]) for k in columns]
    lines = ["| " + " | ".join(t.rjust(w) if a else t.ljust(w) for t, w, a in zip(row, wide, right)) + " |" for row in rows]
    return "\n".join([lines[0], "|" + "|".join("-" * (w + 2) for w in wide) + "|", *lines[1:]])


def _number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True
