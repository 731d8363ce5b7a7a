"""Scholarly articles, patents, fixed-layout pages, scanned books and saved trees to document trees."""

from __future__ import annotations

import io
import json
import posixpath
import re
import tarfile
import zipfile
from xml.etree import ElementTree as ET

from vellumflow.sources.tree import Cell, Tree

_ENTITY = re.compile(r"&(?!amp;|lt;|gt;|quot;|apos;|#)(\w+);")


def _root(content: str) -> ET.Element:
    """The root element, without document type and with named entities as characters."""
    from html import unescape

    body = re.sub(r"<!DOCTYPE[^\[>]*(?:\[.*?\])?\s*>", "", content, flags=re.S)
    body = _ENTITY.sub(lambda m: unescape(m[0]) if unescape(m[0]) != m[0] else "", body)
    root = ET.fromstring(body.lstrip().encode())
    for e in root.iter():
        if isinstance(e.tag, str):
            e.tag = e.tag.rpartition("}")[2]
    return root


def _text(e: ET.Element | None, skip: tuple[str, ...] = ()) -> str:
    if e is None:
        return ""
    out = [e.text or ""]
    for c in e:
        if c.tag not in skip:
            out.append(_text(c, skip))
        out.append(c.tail or "")
    return "".join(out)


def _flat(e: ET.Element | None, skip: tuple[str, ...] = ()) -> str:
    return re.sub(r"\s+", " ", _text(e, skip)).strip()


# ---------------------------------------------------------------- tables of both kinds


def oasis_table(table: ET.Element) -> list[Cell]:
    """A table of column groups: the offsets of all groups together make the columns; an entry spans those between its
    names. Rows without text are left out."""
    groups, edges = [], {0.0}
    for g in table.iter("tgroup"):
        at, names, ends = 0.0, {}, [0.0]
        for k, spec in enumerate(g.findall("colspec")):
            width = float(re.sub(r"[^\d.]", "", spec.get("colwidth", "")) or 1) or 1.0
            names[spec.get("colname", str(k + 1))] = k
            at += width
            ends.append(at)
        groups.append((g, names, ends))
        edges.update(ends)
    offsets = sorted(edges)
    place = {x: k for k, x in enumerate(offsets)}
    cells: list[Cell] = []
    r = 0
    for g, names, ends in groups:
        busy: dict[int, int] = {}
        for part, row in ((part, row) for part in g if part.tag in ("thead", "tbody", "tfoot") for row in part.findall("row")):
            own, k = [], 0
            for e in row.findall("entry"):
                while busy.get(k, 0) > 0:
                    busy[k] -= 1
                    k += 1
                first = names.get(e.get("namest") or e.get("colname") or "", k)
                last = names.get(e.get("nameend") or "", first)
                rows = int(e.get("morerows", 0)) + 1
                for j in range(first, last + 1):
                    busy[j] = rows - 1
                if first < len(ends) - 1:
                    last = min(last, len(ends) - 2)
                    own.append(Cell(r, place[ends[first]], _flat(e), rows, place[ends[last + 1]] - place[ends[first]], part.tag == "thead"))
                k = last + 1
            if any(c.text for c in own):
                cells += own
                r += 1
    for c in cells:
        c.rows = min(c.rows, r - c.r0)
    return cells


def plain_table(table: ET.Element) -> list[Cell]:
    """A table of rows with td and th."""
    cells, taken = [], set()
    rows = list(table.iter("tr"))
    for r, row in enumerate(rows):
        c, own = 0, [x for x in row if x.tag in ("td", "th")]
        for x in own:
            while (r, c) in taken:
                c += 1
            h, w = min(int(x.get("rowspan") or 1), len(rows) - r), int(x.get("colspan") or 1)
            taken.update((r + i, c + j) for i in range(h) for j in range(w))
            cells.append(Cell(r, c, _flat(x), h, w, all(y.tag == "th" for y in own)))
            c += w
    return cells


# ---------------------------------------------------------------- scholarly articles


def affiliations(meta: ET.Element) -> list[tuple[str, list[str]]]:
    """Authors with the affiliations that they refer to (unknown references dropped, each once)."""
    known = {a.get("id"): _flat(a, ("label", "sup")).strip(" ,;") for a in meta.iter("aff")}
    out = []
    for c in meta.iter("contrib"):
        if c.get("contrib-type", "author") != "author" or c.find("name") is None:
            continue
        name = " ".join(x for x in (_flat(c.find("name/given-names")), _flat(c.find("name/surname"))) if x)
        refs = [known[x.get("rid")] for x in c.findall("xref") if x.get("ref-type") == "aff" and x.get("rid") in known]
        out.append((name, list(dict.fromkeys(refs))))
    return out


def citation(ref: ET.Element) -> str:
    """One line for a reference: authors, title, source, year, volume and pages."""
    c = next((x for x in ref if x.tag in ("element-citation", "mixed-citation", "citation")), ref)
    if c.find(".//name") is None and c.find(".//article-title") is None:
        return _flat(c)
    names = ", ".join(" ".join(x for x in (_flat(n.find("surname")), _flat(n.find("given-names"))) if x) for n in c.iter("name"))
    title, source, year = _flat(c.find(".//article-title")), _flat(c.find(".//source")), _flat(c.find(".//year"))
    where = _flat(c.find(".//volume")) + (f":{_flat(c.find('.//fpage'))}" if c.find(".//fpage") is not None else "") + (f"-{_flat(c.find('.//lpage'))}" if c.find(".//lpage") is not None else "")
    parts = [names, title.rstrip("."), " ".join(x for x in (source, f"({year})" if year else "", where) if x)]
    return ". ".join(p for p in parts if p)


def jats(content: str) -> Tree:
    root, tree = _root(content), Tree()
    meta = root.find(".//article-meta")
    meta = meta if meta is not None else root
    top = tree.add("title", _flat(meta.find(".//article-title")) or None)
    authors = affiliations(meta)
    if authors:
        tree.add("text", ", ".join(n for n, _ in authors), top)
        places = list(dict.fromkeys(a for _, xs in authors for a in xs))
        if places:
            tree.add("text", "; ".join(places), top)
    for a in meta.findall("abstract"):
        head = tree.add("section_header", _flat(a.find("title")) or "Abstract", top, level=1)
        for p in a.iter("p"):
            tree.add("text", _flat(p), head)

    def walk(e: ET.Element, parent: int, level: int) -> None:
        for x in e:
            if x.tag == "sec":
                title = _flat(x.find("title"))
                at = tree.add("section_header", title, parent, level=level) if title else parent
                walk(x, at, level + 1 if title else level)
            elif x.tag == "p":
                inner = ("fig", "table-wrap", "list", "disp-formula")
                if t := _flat(x, inner):
                    tree.add("text", t, parent)
                holder = ET.Element("holder")
                holder.extend(y for y in x if y.tag in inner)
                walk(holder, parent, level)
            elif x.tag == "list":
                group = tree.add("list", "list", parent, enumerated=x.get("list-type") == "order")
                for n, item in enumerate(x.findall("list-item"), 1):
                    tree.add("list_item", _flat(item), group, enumerated=x.get("list-type") == "order", marker=f"{n}." if x.get("list-type") == "order" else "")
            elif x.tag == "fig":
                at = tree.add("picture", None, parent)
                if words := " ".join(y for y in (_flat(x.find("label")), _flat(x.find("caption"))) if y):
                    tree.add("caption", words, at)
            elif x.tag == "table-wrap":
                at = tree.add("table", None, parent, cells=plain_table(x))
                if words := " ".join(y for y in (_flat(x.find("label")), _flat(x.find("caption"))) if y):
                    tree.add("caption", words, at)
            elif x.tag == "disp-formula":
                tree.add("formula", _flat(x.find("tex-math")) or _flat(x), parent)
            elif x.tag in ("ack", "app", "app-group", "notes", "fn-group"):
                title = _flat(x.find("title")) or {"ack": "Acknowledgements"}.get(x.tag, "")
                walk(x, tree.add("section_header", title, parent, level=level) if title else parent, level + 1)
            elif x.tag == "ref-list":
                group = tree.add("list", "list", tree.add("section_header", _flat(x.find("title")) or "References", parent, level=level))
                for ref in x.iter("ref"):
                    tree.add("list_item", citation(ref), group, enumerated=False, marker="")

    for part in ("body", "back"):
        if (e := root.find(part)) is not None:
            walk(e, top, 1)
    return tree


# ---------------------------------------------------------------- patents

# Digits and signs as raised and lowered characters.
_UP = str.maketrans("0123456789+-=()n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ")
_DOWN = str.maketrans("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")


def _patent_text(e: ET.Element, skip: tuple[str, ...] = ("tables", "table", "maths", "math", "figref-list")) -> str:
    out = [e.text or ""]
    for c in e:
        if c.tag in ("sup", "sp") and c.text:
            out.append(c.text.translate(_UP))
        elif c.tag in ("sub", "sb") and c.text:
            out.append(c.text.translate(_DOWN))
        elif c.tag not in skip:
            out.append(_patent_text(c, skip))
        out.append(c.tail or "")
    return "".join(out)


# The elements of the three vocabularies of patents.
PATENTS = {
    "us-patent": {"title": "invention-title", "abstract": "abstract", "description": "description", "heading": ("heading",), "para": ("p",), "claims": "claims", "claim": "claim"},
    "PATDOC": {"title": "B540", "abstract": "SDOAB", "description": "SDODE", "heading": ("H",), "para": ("PARA",), "claims": "SDOCL", "claim": "CLM"},
    "patent-application": {"title": "title-of-invention", "abstract": "subdoc-abstract", "description": "subdoc-description", "heading": ("heading",), "para": ("paragraph",), "claims": "subdoc-claims", "claim": "claim"},
}


def patent(content: str) -> Tree:
    """Title, abstract, description with headings and tables, claims; any of the four forms."""
    if content.startswith("PATN"):
        return aps(content)
    root, tree = _root(content), Tree()
    kind = next((v for k, v in PATENTS.items() if root.tag.startswith(k)), PATENTS["us-patent"])
    flat = lambda e: re.sub(r"\s+", " ", _patent_text(e)).strip()
    title = root.find(f".//{kind['title']}")
    top = tree.add("title", flat(title) if title is not None else None)
    abstract = root.find(f".//{kind['abstract']}")
    if abstract is not None:
        head = tree.add("section_header", "ABSTRACT", top, level=1)
        tree.add("text", " ".join(flat(p) for p in abstract.iter() if p.tag in kind["para"]) or flat(abstract), head)
    at = top
    description = root.find(f".//{kind['description']}")
    for x in description.iter() if description is not None else ():
        if x.tag in kind["heading"]:
            at = tree.add("section_header", flat(x), top, level=1)
        elif x.tag in kind["para"]:
            if t := flat(x):
                tree.add("text", t, at)
            for t in x.iter("table"):
                tree.add("table", None, at, cells=oasis_table(t))
    claims = root.find(f".//{kind['claims']}")
    if claims is not None:
        head = tree.add("section_header", "CLAIMS", top, level=1)
        for n, c in enumerate(claims.iter(kind["claim"]), 1):
            t = flat(c)
            tree.add("text", t if re.match(r"\d+\s*\.", t) else f"{n}. {t}", head)
    return tree


def aps_records(content: str) -> list[tuple[str, str]]:
    """(key, value) of the two-column form; lines without a key go on with the value before."""
    out: list[tuple[str, str]] = []
    for line in content.splitlines():
        if not line.strip() or re.match(r"^\s*##STR\d+##\s*$", line):
            continue
        key, value = line[:5].strip(), line[5:].strip()
        if key or not out:
            out.append((key, value))
        else:
            out[-1] = (out[-1][0], f"{out[-1][1]} {value}".strip())
    return out


def aps(content: str) -> Tree:
    tree, section, top, at, claim = Tree(), "", -1, -1, []
    for key, value in aps_records(content):
        if len(key) == 4 and not value:
            section = key
            if key == "ABST":
                at = tree.add("section_header", "ABSTRACT", top, level=1)
            elif key == "CLMS":
                at = tree.add("section_header", "CLAIMS", top, level=1)
        elif key == "TTL":
            top = at = tree.add("title", value)
        elif section == "CLMS" and key in ("NUM", "PAR", "PA1", "PA2", "PA3"):
            if key == "NUM":
                claim = [tree.add("text", value, at)]
            elif claim:
                tree.items[claim[0]].text = f"{tree.items[claim[0]].text} {value}".strip()
        elif key in ("PAC",) and section in ("BSUM", "DETD", "DRWD", "PARN", "GOVT"):
            at = tree.add("section_header", value, top, level=1)
        elif key in ("PAR", "PAL", "PA0", "PA1", "PA2") and section in ("ABST", "BSUM", "DETD", "DRWD", "PARN", "GOVT"):
            tree.add("text", value, at)
    return tree


# ---------------------------------------------------------------- fixed-layout pages


def positions(deltas: str, n: int) -> list[float]:
    """The steps of a delta list; "g 3 2.5" stands for three steps of 2.5."""
    out, parts, k = [], deltas.split(), 0
    while k < len(parts):
        if parts[k] == "g" and k + 2 < len(parts):
            out += [float(parts[k + 2])] * int(parts[k + 1])
            k += 3
        else:
            out.append(float(parts[k]))
            k += 1
    return (out + [0.0] * n)[:n]


class Layout:
    """A fixed-layout archive: its pages' files, and what one of them holds."""

    def __init__(self, archive: zipfile.ZipFile):
        self.archive = archive
        self.names = {n.lower(): n for n in archive.namelist()}
        top, base = self._read("OFD.xml")
        if top is None:
            raise ValueError("no OFD.xml in the archive")
        doc, self.folder = self._read((top.findtext(".//DocRoot") or "Doc_0/Document.xml").strip(), base)
        self.pages = [page.get("BaseLoc", "") for page in doc.iter("Page")] if doc is not None else []

    def _read(self, path: str, base: str = "") -> tuple[ET.Element | None, str]:
        full = path.lstrip("/") if path.startswith("/") else posixpath.normpath(posixpath.join(base, path))
        name = self.names.get(full.lower())
        return (_root(self.archive.read(name).decode("utf-8", "replace")), posixpath.dirname(full)) if name else (None, "")

    def texts(self, page: int) -> list[dict]:
        """(page, text, l, t, r, b, size) of every text object of a page, from 1 on."""
        out = []
        root, _ = self._read(self.pages[page - 1], self.folder)
        for obj in root.iter("TextObject") if root is not None else ():
            x, y, w, h = (list(map(float, (obj.get("Boundary") or "0 0 0 0").split())) + [0.0] * 4)[:4]
            size = float(obj.get("Size") or DEFAULT_SIZE)
            text = "".join(t.text or "" for t in obj.iter("TextCode"))
            text = re.sub("[\ue000-\uf8ff]", "", text)
            if text.strip():
                out.append({"page": page, "text": text, "l": x, "t": y, "r": x + (w or text_width(text, size)), "b": y + h, "size": size})
        return out


# The size of text that names none, and the width of a letter in sizes.
DEFAULT_SIZE, LETTER_WIDTH = 6.0, 0.6


def text_width(text: str, size: float | None) -> float:
    """The width that a text may have, by its size (none, or none above 0: DEFAULT_SIZE) and letters (one at least)."""
    return (size if size and size > 0 else DEFAULT_SIZE) * LETTER_WIDTH * max(len(text), 1)


def fixed_layout(content: bytes) -> list[dict]:
    """(page, text, l, t, r, b, size) of every text object of a fixed-layout archive."""
    layout = Layout(zipfile.ZipFile(io.BytesIO(content)))
    return [x for page in range(1, len(layout.pages) + 1) for x in layout.texts(page)]


def ofd(content: bytes) -> Tree:
    """Text objects as lines and lines as paragraphs, page by page."""
    tree = Tree()
    by: dict[int, list[dict]] = {}
    for x in fixed_layout(content):
        by.setdefault(x["page"], []).append(x)
    for page, items in sorted(by.items()):
        lines: list[dict] = []
        for x in sorted(items, key=lambda i: (round(i["t"], 3), i["l"])):
            h, line = x["b"] - x["t"], lines[-1] if lines else None
            if line and abs(x["t"] - line["t"]) <= max(h, line["h"]) * 0.6 + 0.8:
                line["parts"].append(x)
                line["t"], line["h"] = min(line["t"], x["t"]), max(line["h"], h)
            else:
                lines.append({"t": x["t"], "h": h, "parts": [x]})
        text, before = "", None
        for line in lines:
            words, right = "", None
            for x in sorted(line["parts"], key=lambda i: i["l"]):
                words += (" " if right is not None and x["l"] - right > max(0.6 * x["size"], 0.8) else "") + x["text"]
                right = x["r"]
            if before is not None and line["t"] - before["t"] > max(before["h"], line["h"]) * 1.4:
                tree.add("text", text, page=page)
                text = words
            else:
                text += words
            before = line
        if text:
            tree.add("text", text, page=page)
    return tree


# ---------------------------------------------------------------- scanned books


def hocr(content: str) -> list[tuple[str, tuple[int, int, int, int], float | None]]:
    """(word, box, confidence from 0 to 1) of a page's recognised words."""
    out = []
    for m in re.finditer(r"""<span[^>]*class=['"]ocrx_word['"][^>]*title=['"]([^'"]*)['"][^>]*>(.*?)</span>""", content, re.S):
        box = re.search(r"bbox (-?\d+) (-?\d+) (-?\d+) (-?\d+)", m[1])
        conf = re.search(r"x_wconf (\d+)", m[1])
        word = re.sub(r"<[^>]+>", "", m[2]).strip()
        if box and word:
            out.append((word, tuple(map(int, box.groups())), int(conf[1]) / 100 if conf else None))
    return out


def mets(content: bytes) -> Tree:
    """Pages of a scanned book: the archive's index tells which recognised text belongs to which page."""
    tar = tarfile.open(fileobj=io.BytesIO(content), mode="r:*")
    files = {m.name.rsplit("/", 1)[-1]: tar.extractfile(m).read() for m in tar.getmembers() if m.isfile()}
    index = next((v for k, v in files.items() if k.endswith(".xml") and b"mets" in v[:2000].lower()), None)
    if index is None:
        raise ValueError("no index in the archive")
    root = _root(index.decode("utf-8", "replace"))
    use = {}
    for g in root.iter("fileGrp"):
        for f in g.iter("file"):
            loc = f.find("FLocat")
            name = next((v for k, v in loc.attrib.items() if k.endswith("href")), "") if loc is not None else ""
            use[f.get("ID")] = (g.get("USE", ""), name.rsplit("/", 1)[-1])
    tree = Tree()
    for n, div in enumerate((d for d in root.iter("div") if d.find("fptr") is not None), 1):
        own = dict(use[p.get("FILEID")] for p in div.findall("fptr") if p.get("FILEID") in use)
        top = tree.add("chapter", f"page {div.get('ORDER') or n}", page=n)
        name = own.get("coordOCR")
        if name in files and (words := hocr(files[name].decode("utf-8", "replace"))):
            tree.add("text", " ".join(w for w, _, _ in words), top, page=n)
    return tree


# ---------------------------------------------------------------- saved trees


def saved(content: str) -> Tree:
    """A document saved as JSON: items in the order of the children, found by their references."""
    doc = json.loads(content)
    if not {"body", "texts"} <= doc.keys():
        raise ValueError("not a saved document")
    tree = Tree()

    def at(ref: str):
        _, kind, *rest = ref.split("/")
        return doc[kind][int(rest[0])] if rest else doc[kind]

    def walk(node: dict, parent: int) -> None:
        for c in node.get("children", []):
            x = at(c["$ref"])
            cells = [Cell(k["start_row_offset_idx"], k["start_col_offset_idx"], k["text"], k.get("row_span", 1), k.get("col_span", 1), k.get("column_header", False), k.get("row_header", False)) for k in x.get("data", {}).get("table_cells", [])]
            page = x["prov"][0]["page_no"] if x.get("prov") else None
            k = tree.add(x["label"], x.get("text", x.get("name")), parent, level=x.get("level"), layer=x.get("content_layer", "body"), orig=x.get("orig"), marker=x.get("marker"), enumerated=x.get("enumerated"), link=x.get("hyperlink"), page=page, cells=cells)
            walk(x, k)

    walk(doc["body"], -1)
    return tree
