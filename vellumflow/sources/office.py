"""Word, slide and spreadsheet archives to document trees, with zipfile and ElementTree only."""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as ET

from vellumflow.sources.tree import Cell, Tree

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
M = "{http://schemas.openxmlformats.org/officeDocument/2006/math}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"


class Package:
    """Parts of an archive and the relations between them."""

    def __init__(self, content: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        self.names = set(self.zip.namelist())

    def xml(self, name: str) -> ET.Element | None:
        return ET.fromstring(self.zip.read(name)) if name in self.names else None

    def relations(self, part: str) -> dict[str, tuple[str, str]]:
        """id -> (kind, target) of a part."""
        folder, name = posixpath.split(part)
        root = self.xml(f"{folder}/_rels/{name}.rels")
        out = {}
        for r in root if root is not None else []:
            target = r.get("Target", "")
            if r.get("TargetMode") != "External":
                target = target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join(folder, target))
            out[r.get("Id")] = (r.get("Type", "").rsplit("/", 1)[-1], target)
        return out


# ---------------------------------------------------------------- formulas

# Operators of large size, accents and functions, and how they are written.
_LARGE = {"∑": r"\sum", "∏": r"\prod", "∫": r"\int", "⋃": r"\bigcup", "⋂": r"\bigcap"}
_ACCENTS = {"̂": "hat", "̃": "tilde", "̅": "overline", "⃗": "vec", "̇": "dot", "̈": "ddot"}
_LETTERS = {"α": r"\alpha", "β": r"\beta", "γ": r"\gamma", "δ": r"\delta", "ε": r"\epsilon", "θ": r"\theta", "λ": r"\lambda", "μ": r"\mu", "π": r"\pi", "σ": r"\sigma", "φ": r"\phi", "ω": r"\omega", "Δ": r"\Delta", "Σ": r"\Sigma", "Ω": r"\Omega", "∞": r"\infty", "≤": r"\leq", "≥": r"\geq", "≠": r"\neq", "±": r"\pm", "×": r"\times", "·": r"\cdot", "→": r"\rightarrow", "∈": r"\in", "∂": r"\partial"}
_FUNCTIONS = ("sin", "cos", "tan", "log", "ln", "exp", "lim", "max", "min", "det")


def formula(e: ET.Element) -> str:
    """An office formula in LaTeX."""
    kind = e.tag.removeprefix(M)
    part = lambda name: "".join(map(formula, e.findall(f"{M}{name}")))
    prop = lambda name, default: ((x := e.find(f"{M}{kind}Pr/{M}{name}")) is not None and x.get(f"{M}val")) or default
    if kind == "r":
        text = "".join(t.text or "" for t in e.iter(f"{M}t"))
        return "".join(f"{_LETTERS[c]} " if c in _LETTERS else c for c in text)
    if kind == "f":
        return rf"\frac{{{part('num')}}}{{{part('den')}}}"
    if kind == "sSup":
        return f"{part('e')}^{{{part('sup')}}}"
    if kind == "sSub":
        return f"{part('e')}_{{{part('sub')}}}"
    if kind == "sSubSup":
        return f"{part('e')}_{{{part('sub')}}}^{{{part('sup')}}}"
    if kind == "rad":
        degree = part("deg")
        return rf"\sqrt[{degree}]{{{part('e')}}}" if degree else rf"\sqrt{{{part('e')}}}"
    if kind == "nary":
        sign = prop("chr", "∫")
        low, high = part("sub"), part("sup")
        return _LARGE.get(sign, sign) + (f"_{{{low}}}" if low else "") + (f"^{{{high}}}" if high else "") + f"{{{part('e')}}}"
    if kind == "d":
        inner = prop("sepChr", "|").join(formula(x) for x in e.findall(f"{M}e"))
        return rf"\left{prop('begChr', '(')}{inner}\right{prop('endChr', ')')}"
    if kind == "acc":
        return rf"\{_ACCENTS.get(prop('chr', '̂'), 'hat')}{{{part('e')}}}"
    if kind == "bar":
        return rf"\{'underline' if prop('pos', 'top') == 'bot' else 'overline'}{{{part('e')}}}"
    if kind == "groupChr":
        return rf"\underbrace{{{part('e')}}}" if prop("pos", "bot") == "bot" else rf"\overbrace{{{part('e')}}}"
    if kind == "func":
        name = part("fName").strip()
        return (f"\\{name}" if name in _FUNCTIONS else name) + f"{{{part('e')}}}"
    if kind == "limLow":
        return f"{part('e')}_{{{part('lim')}}}"
    if kind == "limUpp":
        return f"{part('e')}^{{{part('lim')}}}"
    if kind == "m":
        return r"\begin{matrix}" + r"\\".join("&".join(formula(x) for x in row.findall(f"{M}e")) for row in e.findall(f"{M}mr")) + r"\end{matrix}"
    if kind == "eqArr":
        return r"\begin{array}{c}" + r"\\".join(formula(x) for x in e.findall(f"{M}e")) + r"\end{array}"
    if kind.endswith("Pr"):
        return ""
    return "".join(map(formula, e))


# ---------------------------------------------------------------- Word


class _Word:
    def __init__(self, content: bytes):
        self.p, self.tree = Package(content), Tree()
        self.links = self.p.relations("word/document.xml")
        self.styles = {s.get(f"{W}styleId"): s for s in self.p.xml("word/styles.xml").iter(f"{W}style")} if "word/styles.xml" in self.p.names else {}
        self.formats = self.numbering()
        self.heads: dict[int, int] = {}
        self.lists: list[tuple[tuple, int]] = []
        self.count: dict[tuple, int] = {}

    def numbering(self) -> dict[tuple[str, str], str]:
        """(number, level) -> format: a number names an abstract one, which has the levels."""
        root = self.p.xml("word/numbering.xml")
        if root is None:
            return {}
        levels = {a.get(f"{W}abstractNumId"): {v.get(f"{W}ilvl"): (f.get(f"{W}val") if (f := v.find(f"{W}numFmt")) is not None else "") for v in a.findall(f"{W}lvl")} for a in root.findall(f"{W}abstractNum")}
        return {(n.get(f"{W}numId"), lvl): fmt for n in root.findall(f"{W}num") for lvl, fmt in levels.get(n.find(f"{W}abstractNumId").get(f"{W}val"), {}).items()}

    def style(self, para: ET.Element) -> tuple[str, int | None]:
        """(label, level) by the style of a paragraph, or of a style that it is based on."""
        s = para.find(f"{W}pPr/{W}pStyle")
        name, seen = s.get(f"{W}val") if s is not None else "", set()
        while name and name not in seen:
            seen.add(name)
            found = self.styles.get(name)
            shown = (found.find(f"{W}name").get(f"{W}val") if found is not None and found.find(f"{W}name") is not None else name).lower()
            if shown == "title":
                return "title", None
            if m := re.match(r"heading\s*(\d*)", shown):
                return "section_header", int(m[1] or 1)
            base = found.find(f"{W}basedOn") if found is not None else None
            name = base.get(f"{W}val") if base is not None else ""
        return "text", None

    def runs(self, para: ET.Element):
        """(text, style, link): neighbouring runs of one format are one; formulas come in dollar signs."""
        out: list[list] = []

        def say(text, style, link):
            if out and out[-1][1:] == [style, link]:
                out[-1][0] += text
            elif text:
                out.append([text, style, link])

        def walk(node, link):
            for x in node:
                if x.tag == f"{W}hyperlink":
                    walk(x, self.links.get(x.get(f"{R}id"), ("", None))[1])
                elif x.tag == f"{W}r":
                    pr = x.find(f"{W}rPr")
                    on = lambda t: pr is not None and (v := pr.find(f"{W}{t}")) is not None and v.get(f"{W}val") not in ("0", "false", "none")  # noqa: B023, E731
                    script = pr.find(f"{W}vertAlign") if pr is not None else None
                    style = [n for t, n in (("b", "bold"), ("i", "italic"), ("u", "underline"), ("strike", "strikethrough")) if on(t)]
                    if script is not None and script.get(f"{W}val") in ("subscript", "superscript"):
                        style.append(script.get(f"{W}val").removesuffix("script"))
                    text = "".join("\t" if t.tag == f"{W}tab" else "\n" if t.tag == f"{W}br" else t.text or "" for t in x if t.tag in (f"{W}t", f"{W}tab", f"{W}br"))
                    say(text, ",".join(style), link)
                elif x.tag in (f"{M}oMath", f"{M}oMathPara"):
                    say(f"${formula(x)}$", "formula", None)
                elif x.tag in (f"{W}ins", f"{W}smartTag", f"{W}sdt", f"{W}sdtContent"):
                    walk(x, link)

        walk(para, None)
        return [(t.strip(), s, k) for t, s, k in out if t.strip()]

    def say(self, runs, label: str, parent: int, **more) -> int:
        if len(runs) == 1:
            t, s, k = runs[0]
            return self.tree.add("formula" if s == "formula" and label == "text" else label, t.strip("$") if s == "formula" else t, parent, style=None if s == "formula" else s or None, link=k, **more)
        top = self.tree.add(label, "", parent, **more) if label != "text" else parent
        group = self.tree.add("inline", None, top, layer=more.get("layer", "body"))
        for t, s, k in runs:
            self.tree.add("formula" if s == "formula" else "text", t.strip("$") if s == "formula" else t, group, style=None if s == "formula" else s or None, link=k, layer=more.get("layer", "body"))
        return top if label != "text" else group

    def paragraph(self, para: ET.Element, parent: int | None = None) -> None:
        up = parent if parent is not None else self.heads[max(self.heads)] if self.heads else -1
        if any(True for _ in para.iter(f"{A}blip")):
            self.tree.add("picture", None, up)
        for box in para.iter(f"{W}txbxContent"):
            for x in dict.fromkeys("".join(t.text or "" for t in q.iter(f"{W}t")).strip() for q in box.findall(f"{W}p")):
                if x:
                    self.tree.add("text", x, up)
        runs = self.runs(para)
        if not runs:
            return
        label, level = self.style(para)
        number = para.find(f"{W}pPr/{W}numPr")
        num = number.find(f"{W}numId").get(f"{W}val") if number is not None and number.find(f"{W}numId") is not None else None
        if label == "title":
            self.lists = []
            self.heads = {0: self.say(runs, "title", -1)}
        elif label == "section_header":
            self.lists = []
            self.heads = {k: v for k, v in self.heads.items() if k < level}
            self.heads[level] = self.say(runs, "section_header", self.heads[max(self.heads)] if self.heads else -1, level=level)
        elif num and num != "0":
            lvl = number.find(f"{W}ilvl").get(f"{W}val") if number.find(f"{W}ilvl") is not None else "0"
            key = (int(lvl), num)
            ordered = self.formats.get((num, lvl), "bullet") not in ("bullet", "none", "")
            while self.lists and (self.lists[-1][0][0] > key[0] or (self.lists[-1][0][0] == key[0] and self.lists[-1][0] != key)):
                self.lists.pop()
            if not self.lists or self.lists[-1][0] != key:
                self.lists.append((key, self.tree.add("list", "ordered list" if ordered else "list", self.lists[-1][1] if self.lists else up, enumerated=ordered)))
                self.count[key] = 0
            self.count[key] += 1
            self.say(runs, "list_item", self.lists[-1][1], enumerated=ordered, marker=f"{self.count[key]}." if ordered else "")
        else:
            self.lists = []
            self.say(runs, "text", up)

    def table(self, t: ET.Element) -> None:
        up = self.heads[max(self.heads)] if self.heads else -1
        rows = t.findall(f"{W}tr")
        if len(rows) == 1 and len(rows[0].findall(f"{W}tc")) == 1:  # a frame, not a table
            self.body(rows[0].find(f"{W}tc"))
            return
        cells: list[Cell] = []
        above: dict[int, Cell] = {}
        for r, row in enumerate(rows):
            c = 0
            for tc in row.findall(f"{W}tc"):
                pr = tc.find(f"{W}tcPr")
                wide = int(g.get(f"{W}val")) if pr is not None and (g := pr.find(f"{W}gridSpan")) is not None else 1
                merge = pr.find(f"{W}vMerge") if pr is not None else None
                if merge is not None and merge.get(f"{W}val") != "restart" and c in above:
                    above[c].rows += 1
                else:
                    text = "\n".join(" ".join(x for x, _, _ in self.runs(p)) for p in tc.iter(f"{W}p")).strip()
                    cells.append(Cell(r, c, text, 1, wide, column_header=r == 0))
                    above[c] = cells[-1]
                c += wide
        self.tree.add("table", None, up, cells=cells)

    def body(self, root: ET.Element) -> None:
        for x in root:
            if x.tag == f"{W}p":
                self.paragraph(x)
            elif x.tag == f"{W}tbl":
                self.table(x)
            elif x.tag == f"{W}sdt" and (inner := x.find(f"{W}sdtContent")) is not None:
                self.body(inner)


def docx(content: bytes) -> Tree:
    """The body in order, then headers and footers as furniture."""
    w = _Word(content)
    w.body(w.p.xml("word/document.xml").find(f"{W}body"))
    for kind, target in w.links.values():
        if kind in ("header", "footer") and target in w.p.names:
            for text in dict.fromkeys("".join(t.text or "" for t in p.iter(f"{W}t")).strip() for p in w.p.xml(target).iter(f"{W}p")):
                if text:
                    w.tree.add("page_header" if kind == "header" else "page_footer", text, layer="furniture")
    return w.tree


# ---------------------------------------------------------------- slides


def pptx(content: bytes) -> Tree:
    """Each slide a chapter: its shapes (also in groups), lists, tables, pictures, and notes as furniture."""
    p, tree = Package(content), Tree()
    slides = p.relations("ppt/presentation.xml")
    order = [slides[s.get(f"{R}id")][1] for s in p.xml("ppt/presentation.xml").iter(f"{P}sldId")]
    for n, name in enumerate(order, 1):
        top = tree.add("chapter", f"slide-{n - 1}", page=n)
        root = p.xml(name)

        def text_of(e):
            return "".join(t.text or "" for t in e.iter(f"{A}t"))

        def shape(x):
            if x.tag == f"{P}grpSp":
                for y in x:
                    shape(y)
            elif x.tag == f"{P}pic":
                tree.add("picture", None, top, page=n)  # noqa: B023
            elif x.tag == f"{P}graphicFrame":
                for t in x.iter(f"{A}tbl"):
                    cells = []
                    for r, row in enumerate(t.findall(f"{A}tr")):
                        for c, tc in enumerate(row.findall(f"{A}tc")):
                            if tc.get("hMerge") or tc.get("vMerge"):
                                continue
                            cells.append(Cell(r, c, text_of(tc).strip(), int(tc.get("rowSpan", 1)), int(tc.get("gridSpan", 1)), column_header=r == 0))
                    tree.add("table", None, top, page=n, cells=[c for c in cells if c.text])  # noqa: B023
            elif x.tag == f"{P}sp":
                kind = next((ph.get("type", "body") for ph in x.iter(f"{P}ph")), None)
                group, number = None, 0
                for para in x.iter(f"{A}p"):
                    text = text_of(para).strip()
                    pr = para.find(f"{A}pPr")
                    ordered = pr is not None and pr.find(f"{A}buAutoNum") is not None
                    bullet = ordered or (pr is not None and (pr.find(f"{A}buChar") is not None or int(pr.get("lvl", 0)) > 0))
                    if not text:
                        continue
                    if bullet and kind not in ("title", "ctrTitle", "subTitle"):
                        if group is None:
                            group, number = tree.add("list", "ordered list" if ordered else "list", top, page=n, enumerated=ordered), 0  # noqa: B023
                        number += 1
                        tree.add("list_item", text, group, page=n, enumerated=ordered, marker=f"{number}." if ordered else "")  # noqa: B023
                    else:
                        group = None
                        label = "title" if kind in ("title", "ctrTitle") else "section_header" if kind == "subTitle" else "text"
                        tree.add(label, text, top, page=n, level=1 if label == "section_header" else None)  # noqa: B023

        for x in root.find(f"{P}cSld/{P}spTree"):
            shape(x)
        for kind, target in p.relations(name).values():
            if kind == "notesSlide" and target in p.names:
                for sp in p.xml(target).iter(f"{P}sp"):
                    if next((ph.get("type") for ph in sp.iter(f"{P}ph")), "") == "body" and text_of(sp).strip():
                        tree.add("text", text_of(sp).strip(), top, page=n, layer="furniture")
    return tree


# ---------------------------------------------------------------- spreadsheets


def address(ref: str) -> tuple[int, int]:
    """(row, column) from 0 of a reference as B7."""
    m = re.match(r"\$?([A-Z]+)\$?(\d+)", ref)
    col = 0
    for c in m[1]:
        col = col * 26 + ord(c) - 64
    return int(m[2]) - 1, col - 1


def sheet(root: ET.Element, shared: list[str]) -> tuple[dict[tuple[int, int], str], list[tuple[int, int, int, int]]]:
    """Values by place, and merged ranges (first and last row, first and last column)."""
    values = {}
    for c in root.iter(f"{S}c"):
        kind, v = c.get("t", "n"), c.find(f"{S}v")
        text = "".join(t.text or "" for t in c.iter(f"{S}t")) if kind == "inlineStr" else v.text if v is not None else None
        if text is not None and text != "":
            values[address(c.get("r"))] = shared[int(text)] if kind == "s" else {"0": "FALSE", "1": "TRUE"}[text] if kind == "b" else text
    merges = []
    for m in root.iter(f"{S}mergeCell"):
        (a, b), (c, d) = map(address, (m.get("ref").split(":") * 2)[:2])
        merges.append((a, c, b, d))
    return values, merges


def islands(values, merges) -> list[tuple[tuple[int, int, int, int], list[Cell]]]:
    """Tables of a sheet: places that hold something and touch, also at corners or through a merged range. Each is
    (bounds, cells relative to them). Only places in use are visited, so inflated dimensions cost nothing."""
    owner = {}
    for a, c, b, d in merges:
        if (a, b) in values:
            for r in range(a, c + 1):
                for k in range(b, d + 1):
                    owner[(r, k)] = (a, b, c, d)
    used, out = set(values) | set(owner), []
    todo = sorted(used)
    seen: set = set()
    for start in todo:
        if start in seen:
            continue
        stack, group = [start], set()
        while stack:
            at = stack.pop()
            if at in seen:
                continue
            seen.add(at)
            group.add(at)
            stack += [q for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (q := (at[0] + dr, at[1] + dc)) in used and q not in seen]
        r0, c0 = min(r for r, _ in group), min(c for _, c in group)
        r1, c1 = max(r for r, _ in group), max(c for _, c in group)
        cells = []
        for r, c in sorted(group):
            a, b, z, d = owner.get((r, c), (r, c, r, c))
            if (a, b) == (r, c) and (r, c) in values:
                cells.append(Cell(r - r0, c - c0, values[(r, c)], z - a + 1, d - b + 1, column_header=r == r0))
        out.append(((r0, c0, r1, c1), cells))
    return out


def xlsx(content: bytes) -> Tree:
    """Each sheet is a page, each island of values a table; a hidden sheet's items are invisible."""
    p, tree = Package(content), Tree()
    strings = p.xml("xl/sharedStrings.xml")
    shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in strings.findall(f"{S}si")] if strings is not None else []
    names = p.relations("xl/workbook.xml")
    for n, s in enumerate(p.xml("xl/workbook.xml").iter(f"{S}sheet"), 1):
        layer = "body" if s.get("state", "visible") == "visible" else "invisible"
        top = tree.add("section", f"sheet: {s.get('name')}", page=n, layer=layer)
        part = names[s.get(f"{R}id")][1]
        root = p.xml(part)
        if root is None:
            continue
        for _, cells in islands(*sheet(root, shared)):
            tree.add("table", None, top, page=n, layer=layer, cells=cells)
        for kind, target in p.relations(part).values():
            if kind == "drawing" and target in p.names:
                for _ in p.xml(target).iter(f"{A}blip"):
                    tree.add("picture", None, top, page=n, layer=layer)
    return tree
