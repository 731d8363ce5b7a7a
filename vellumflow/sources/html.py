"""HTML to a document tree, with the standard library's tokenizer and a forgiving stack of open elements."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

from vellumflow.sources.tree import Cell, grid, pipe_table, Tree

# Elements with a meaning of their own, elements without an end, elements that are left out.
BLOCKS = {"address", "details", "figure", "footer", "img", "h1", "h2", "h3", "h4", "h5", "h6", "ol", "p", "pre", "summary", "table", "ul"}
STYLES = {"b": "bold", "strong": "bold", "i": "italic", "em": "italic", "var": "italic", "s": "strikethrough", "del": "strikethrough", "u": "underline", "ins": "underline", "sub": "sub", "sup": "super", "code": "code", "kbd": "code", "samp": "code"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
DROPPED = {"script", "noscript", "style", "template"}
CLEAN = {
    " ": " ", " ": " ", "​": "", "‌": "", "‍": "", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-",
    "‘": "'", "’": "'", "“": '"', "”": '"', "…": "...", "­": "", "﻿": "", "⁠": "",
}
_TABLE = str.maketrans(CLEAN)


def clean(text: str) -> str:
    return text.translate(_TABLE)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict | None = None, parent: Node | None = None):
        self.tag, self.attrs, self.children, self.parent = tag, attrs or {}, [], parent

    def find(self, *tags: str):
        """The descendants of these tags in order."""
        for c in self.children:
            if isinstance(c, Node):
                if c.tag in tags:
                    yield c
                yield from c.find(*tags)

    def text(self) -> str:
        """All text below, with a space after each paragraph and list entry."""
        out = []
        for c in self.children:
            if isinstance(c, str):
                out.append(c)
            elif c.tag == "br":
                out.append("\n")
            elif c.tag not in DROPPED:
                out.append(c.text() + (" " if c.tag in ("p", "li") else ""))
        return "".join(out)


class _Builder(HTMLParser):
    """Start tags nest in what is open; an end tag closes the nearest open element of its name, or nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def dom(content: str) -> Node:
    b = _Builder()
    b.feed(content)
    b.close()
    return b.root


def span(value: str | None) -> int:
    found = re.match(r"\d+", (value or "").strip())
    return max(1, int(found.group())) if found else 1


def _squeeze(text: str) -> str:
    return re.sub(r"\s+", " ", clean(text)).strip()


def marked_text(tree: Tree) -> str:
    """A small tree as Markdown: runs with their marks, list entries, tables; blocks with a blank line between."""
    marks = {"bold": "**", "italic": "*", "strikethrough": "~~"}
    said: dict[int, list[str]] = {}
    blocks: list[tuple[str, str]] = []
    items = tree.items
    for x in reversed(range(len(items))):
        item = items[x]
        text = item.text or " ".join(reversed(said.pop(x, [])))
        for name in reversed((item.style or "").split(",")):
            text = f"{marks[name]}{text}{marks[name]}" if name in marks and text else text
        if item.label == "table":
            text = pipe_table(grid(item.cells))
        if item.label == "inline" or (item.parent >= 0 and items[item.parent].label == "inline"):
            up = item.parent
            if item.label != "inline" or (up >= 0 and items[up].label == "list_item"):
                said.setdefault(up, []).append(text)
                continue
        if item.label == "list_item":
            text = f"{item.marker or '-'} {text}"
        if text and item.label not in ("list", "caption"):
            blocks.append((item.label, text))
    out = ""
    last = None
    for label, text in reversed(blocks):
        out += ("" if last is None else "\n" if last == label == "list_item" else "\n\n") + text
        last = label
    return out


class _Walk:
    def __init__(self, root: Node, base: str | None):
        self.tree, self.base = Tree(), base
        self.heads: dict[int, int] = {}
        self.root = root
        self.layer = "furniture" if self._heading_ahead(root) else "body"

    @staticmethod
    def _heading_ahead(root: Node) -> bool:
        def outside(h: Node) -> bool:
            p = h.parent
            while p is not None:
                if p.tag == "table":
                    return False
                p = p.parent
            return True

        return any(outside(h) for h in root.find("h1", "h2", "h3", "h4", "h5", "h6"))

    def parent(self) -> int:
        return self.heads[max(self.heads)] if self.heads else -1

    def href(self, node: Node) -> str | None:
        h = node.attrs.get("href")
        if not h:
            return None
        if h.startswith("//"):
            return "https:" + h
        return h if h.startswith("#") or re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", h) or not self.base else urljoin(self.base, h)

    def runs(self, node: Node, style: tuple = (), link: str | None = None):
        """(text, style, link) of the inline content below a node, blocks of their own left out; a line break has no text."""
        for c in node.children:
            if isinstance(c, str):
                yield c, style, link
            elif c.tag == "br":
                yield None, style, link
            elif c.tag not in DROPPED and c.tag not in ("ul", "ol", "table", "img", "figure") and "hidden" not in c.attrs:
                more = STYLES.get(c.tag)
                yield from self.runs(c, style + (more,) if more and more not in style else style, self.href(c) or link if c.tag == "a" else link)

    def emit(self, runs, label: str, parent: int, **more) -> int | None:
        """One item for runs of one style, an inline group for several. Equal neighbours are put together. A text ends at a line
        break, so it may be several items (the first is returned); elsewhere a line break is a space."""
        runs = list(runs)
        if label == "text" and any(text is None for text, _, _ in runs):
            made, part = [], []
            for x in [*runs, (None, (), None)]:
                if x[0] is None:
                    made.append(self.emit(part, label, parent, **more))
                    part = []
                else:
                    part.append(x)
            return next((x for x in made if x is not None), None)
        runs = [("\n" if text is None else text, style, link) for text, style, link in runs]
        joined: list[list] = []
        for text, style, link in runs:
            if joined and joined[-1][1:] == [style, link]:
                joined[-1][0] += text
            elif text.strip() or joined:
                joined.append([text, style, link])
        joined = [[_squeeze(t), s, k] for t, s, k in joined]
        joined = [x for x in joined if x[0]]
        if not joined:
            return None
        if len(joined) == 1:
            t, s, k = joined[0]
            return self.tree.add("code" if "code" in s and label == "text" else label, t, parent, layer=self.layer, style=",".join(x for x in s if x != "code") or None, link=k, orig=t, **more)
        top = self.tree.add(label, "", parent, layer=self.layer, **more) if label != "text" else -1
        group = self.tree.add("inline", None, top if top >= 0 else parent, layer=self.layer)
        for t, s, k in joined:
            self.tree.add("code" if "code" in s else "text", t, group, layer=self.layer, style=",".join(x for x in s if x != "code") or None, link=k, orig=t)
        return top if top >= 0 else group

    def go(self, node: Node, parent: int | None = None) -> None:
        """Blocks in order; what stands between them is gathered into paragraphs."""
        loose: list = []

        def flush():
            if loose:
                self.emit(loose, "text", self.parent() if parent is None else parent)
                loose.clear()

        for c in node.children:
            if isinstance(c, str):
                loose.append((c, (), None))
            elif c.tag in DROPPED or "hidden" in c.attrs or c.tag in ("head", "title"):
                continue
            elif c.tag in BLOCKS:
                flush()
                self.block(c, parent)
            elif any(True for _ in c.find(*BLOCKS)):
                flush()
                self.go(c, parent)
            elif c.tag == "br":
                loose.append((None, (), None))
            else:
                holder = Node("#inline")
                holder.children = [c]
                loose.extend(self.runs(holder))
                if c.tag in ("div", "section", "article", "li", "td", "nav", "main", "header", "body", "html"):
                    flush()
        flush()

    def block(self, c: Node, parent: int | None) -> None:
        at = self.parent() if parent is None else parent
        if c.tag[0] == "h" and len(c.tag) == 2:
            self.heading(c, int(c.tag[1]))
        elif c.tag in ("ul", "ol"):
            self.listing(c, at)
        elif c.tag in ("p", "address", "summary"):
            self.emit(self.runs(c), "text", at)
            for inner in c.find("ul", "ol", "table", "img", "figure"):
                if next((a for a in self._above(inner, c) if a.tag in BLOCKS - {"p", "address", "summary"}), None) is None:
                    self.block(inner, parent)
        elif c.tag == "pre":
            self.tree.add("code", clean(c.text()).strip("\n"), at, layer=self.layer)
        elif c.tag == "table":
            self.table(c, at)
        elif c.tag in ("img", "figure"):
            self.picture(c, at)
        elif c.tag == "footer":
            kept, self.layer = self.layer, "furniture"
            self.go(c, self.tree.add("section", "footer", at, layer="furniture"))
            self.layer = kept
        elif c.tag == "details":
            self.go(c, self.tree.add("section", "details", at, layer=self.layer))

    @staticmethod
    def _above(node: Node, stop: Node):
        p = node.parent
        while p is not None and p is not stop:
            yield p
            p = p.parent

    def heading(self, c: Node, level: int) -> None:
        self.layer = "body"
        if level == 1:
            self.heads = {}
            at = self.emit(self.runs(c), "title", -1)
        else:
            self.heads = {k: v for k, v in self.heads.items() if k < level}
            above = max(self.heads, default=1)
            for missing in range(above + 1, level):
                if above > 1 or missing > 1:
                    self.heads[missing] = self.tree.add("section", f"header-{missing}", self.parent(), layer="invisible")
            at = self.emit(self.runs(c), "section_header", self.parent(), level=level - 1)
        if at is not None:
            self.heads[level] = at

    def listing(self, c: Node, parent: int) -> None:
        start = c.attrs.get("start", "")
        first = int(start) if start.isdigit() and int(start) > 0 else 1
        group = self.tree.add("list", "ordered list" if c.tag == "ol" else "list", parent, layer=self.layer, enumerated=c.tag == "ol")
        n = 0
        for li in c.children:
            if not isinstance(li, Node):
                continue
            if li.tag in ("ul", "ol"):
                self.listing(li, group)
            elif li.tag == "li":
                marker = f"{first + n}." if c.tag == "ol" else ""
                at = self.emit(self.runs(li), "list_item", group, marker=marker, enumerated=c.tag == "ol")
                n += 1
                for inner in li.find("ul", "ol", "table", "img", "figure"):
                    if next((a for a in self._above(inner, li) if a.tag in ("ul", "ol", "table", "figure")), None) is None:
                        self.block(inner, group if at is None else at)

    def picture(self, c: Node, parent: int) -> None:
        caption = next((x.text() for x in c.find("figcaption")), None)
        images = [c] if c.tag == "img" else list(c.find("img"))
        for image in images:
            words = caption or image.attrs.get("alt") or ""
            at = self.tree.add("picture", None, parent, layer=self.layer)
            if words.strip():
                self.tree.add("caption", _squeeze(words), at, layer=self.layer)
        if not images:
            self.go(c, parent)

    def cell_text(self, x: Node) -> str:
        """The text of a table cell; of one that holds blocks or styled runs, its Markdown in one line."""
        if not any(True for _ in x.find("p", "ul", "ol", "table", "pre", *STYLES)):
            return _squeeze(x.text())
        inner = _Walk(x, self.base)
        inner.layer = "body"
        inner.go(x, -1)
        return marked_text(inner.tree).replace("\n", " ")

    def table(self, c: Node, parent: int) -> None:
        rows = [r for r in c.find("tr") if next((a for a in self._above(r, c) if a.tag == "table"), None) is None]
        taken: set[tuple[int, int]] = set()
        cells: list[Cell] = []
        for r, row in enumerate(rows):
            own = [x for x in row.children if isinstance(x, Node) and x.tag in ("td", "th")]
            heads = all(x.tag == "th" for x in own)
            col = 0
            for x in own:
                while (r, col) in taken:
                    col += 1
                h, w = min(span(x.attrs.get("rowspan")), len(rows) - r), span(x.attrs.get("colspan"))
                taken.update((r + i, col + j) for i in range(h) for j in range(w))
                cells.append(Cell(r, col, self.cell_text(x), h, w, heads and bool(own), x.tag == "th" and not heads))
                col += w
        caption = next((x.text() for x in c.find("caption")), None)
        at = self.tree.add("table", None, parent, layer=self.layer, cells=cells)
        if caption and caption.strip():
            self.tree.add("caption", _squeeze(caption), at, layer=self.layer)


def parse(content: str, base: str | None = None) -> Tree:
    """The tree of a page: its title as furniture, all before the first heading as furniture, then the body."""
    root = dom(content)
    w = _Walk(root, base)
    title = next(root.find("title"), None)
    if title is not None and title.text().strip():
        w.tree.add("title", _squeeze(title.text()), layer="furniture", orig=title.text())
    w.go(next(root.find("body"), root))
    return w.tree
