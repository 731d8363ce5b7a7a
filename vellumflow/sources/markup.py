"""Markdown, AsciiDoc, comma-separated values and WebVTT to document trees."""

from __future__ import annotations

import csv
import html as entities
import io
import re

from vellumflow.sources import html
from vellumflow.sources.tree import Cell, Tree

# ---------------------------------------------------------------- Markdown

_INLINE = re.compile(r"\\(?P<escaped>[\\`*_{}\[\]()#+\-.!|>~])|(?P<ticks>`+)(?P<code>.+?)(?P=ticks)|!\[(?P<alt>[^\]]*)\]\((?P<src>[^)\s]*)(?:\s+\"(?P<cap>[^\"]*)\")?\)|\[(?P<label>(?:[^\[\]]|\[[^\]]*\])*)\]\((?P<href>[^)\s]*)[^)]*\)|(?P<mark>\*\*|__|~~|\*|_)", re.S)


def inline(text: str, style: tuple = (), link: str | None = None) -> list[tuple[str, tuple, str | None]]:
    """(text, styles, link) runs of one block of Markdown; images come as ("", ("image", caption), source)."""
    out: list[tuple[str, tuple, str | None]] = []
    open_: list[str] = []
    names = {"**": "bold", "__": "bold", "*": "italic", "_": "italic", "~~": "strikethrough"}
    at = 0

    def say(t: str, more: tuple = ()):
        if t:
            out.append((entities.unescape(t) if "code" not in more else t, style + tuple(names[m] for m in open_) + more, link))

    for m in _INLINE.finditer(text):
        say(text[at : m.start()])
        at = m.end()
        if m["escaped"]:
            say(m["escaped"])
        elif m["code"] is not None:
            say(m["code"].strip(), ("code",))
        elif m["alt"] is not None:
            out.append(("", ("image", m["cap"] or m["alt"]), m["src"]))
        elif m["label"] is not None:
            out.extend(inline(m["label"], style + tuple(names[x] for x in open_), m["href"]))
        else:
            mark = m["mark"]
            if open_ and open_[-1] == mark:
                open_.pop()
            elif mark in text[at:] and (mark != "_" or not (m.start() and text[m.start() - 1].isalnum())):
                open_.append(mark)
            else:
                say(mark)
    say(text[at:])
    merged: list[tuple] = []
    for t, s, k in out:
        if merged and merged[-1][1:] == (s, k) and "image" not in s:
            merged[-1] = (merged[-1][0] + t, s, k)
        else:
            merged.append((t, s, k))
    return merged


def _say(tree: Tree, text: str, label: str, parent: int, **more) -> int:
    text = re.sub(r"_{11,}", "_" * 10, text)
    runs = [r for r in inline(text) if r[0].strip() or "image" in r[1]]
    if len(runs) == 1 and "image" not in runs[0][1]:
        t, s, k = runs[0]
        return tree.add("code" if "code" in s and label == "text" else label, re.sub(r"\s*\n\s*", " ", t).strip(), parent, style=",".join(x for x in s if x != "code") or None, link=k, **more)
    if len(runs) == 1:
        at = tree.add("picture", None, parent, link=runs[0][2])
        if runs[0][1][1]:
            tree.add("caption", runs[0][1][1], at)
        return at
    top = tree.add(label, "", parent, **more) if label != "text" else parent
    group = tree.add("inline", None, top)
    for t, s, k in runs:
        if "image" in s:
            tree.add("picture", None, group, link=k)
        else:
            tree.add("code" if "code" in s else "text", re.sub(r"\s*\n\s*", " ", t).strip(), group, style=",".join(x for x in s if x != "code") or None, link=k)
    return top if label != "text" else group


def pipe_table(lines: list[str]) -> list[Cell]:
    rows = [[c.strip() for c in re.split(r"(?<!\\)\|", x.strip().strip("|"))] for k, x in enumerate(lines) if k != 1]
    return [Cell(r, c, entities.unescape(re.sub(r"[*_`]{1,2}(\S(?:.*?\S)?)[*_`]{1,2}", r"\1", t.replace("\\|", "|"))), column_header=r == 0) for r, row in enumerate(rows) for c, t in enumerate(row)]


def underlined(content: str) -> str:
    """Headings that are underlined by = or - written with number signs, outside of fences."""
    parts = re.split(r"(?ms)(^\s*```.*?(?:^\s*```\s*?$|\Z))", content)
    mark = lambda m: ("# " if m[2][0] == "=" else "## ") + m[1]
    return "".join(x if k % 2 else re.sub(r"(?m)(?<![^\n]\n)^(?![ \t]*(?:[-*+#>|<=`~]|\d+[.)]))(\S[^\n|]*)\n(=+|-{2,})[ \t]*$", mark, x) for k, x in enumerate(parts))


def markdown(content: str) -> Tree:
    """Headings (the first level as title), paragraphs, nested lists, fences, pipe tables, pictures; a text with blocks
    of HTML is put into HTML as a whole and read by that parser."""
    if re.search(r"(?m)^<(?:table|div|p|ul|ol|h[1-6]|pre|details|figure|img)\b", content):
        return html.parse(to_html(content))
    tree, lines, k = Tree(), underlined(content.replace("\r\n", "\n")).split("\n"), 0
    heads: dict[int, int] = {}
    up = lambda: heads[max(heads)] if heads else -1
    lists: list[tuple[int, int, bool, int]] = []  # indent, group, ordered, last item
    count: dict[int, int] = {}
    while k < len(lines):
        line = lines[k]
        if not line.strip():
            k += 1
            continue
        item = re.match(r"^(\s*)([-*+]|\d{1,9}[.)])\s+(.*)$", line)
        fence = re.match(r"^\s*(```+|~~~+)\s*(\w*)", line)
        head = re.match(r"^ {0,3}(#{1,6})\s+(.*?)\s*#*\s*$", line)
        if not item and not line.startswith((" ", "\t")):
            lists, count = [], {}
        if fence:
            body, k = [], k + 1
            while k < len(lines) and not lines[k].strip().startswith(fence[1]):
                body.append(lines[k])
                k += 1
            k += 1
            tree.add("code", "\n".join(body), lists[-1][3] if lists else up(), language=fence[2] or None)
        elif head:
            level = len(head[1])
            heads = {a: b for a, b in heads.items() if a < level}
            heads[level] = _say(tree, head[2], "title", -1) if level == 1 else _say(tree, head[2], "section_header", up(), level=level - 1)
            k += 1
        elif item and not re.match(r"^\s*([-*_]\s*){3,}$", line):
            indent, ordered = len(item[1].expandtabs(4)), item[2][0].isdigit()
            while lists and lists[-1][0] > indent:
                lists.pop()
            if not lists or lists[-1][0] < indent or lists[-1][2] != ordered:
                if lists and lists[-1][0] == indent:
                    lists.pop()
                group = tree.add("list", "ordered list" if ordered else "list", lists[-1][3] if lists else up(), enumerated=ordered)
                lists.append((indent, group, ordered, -1))
                count[group] = int(item[2][:-1]) if ordered else 1
            group, text, k = lists[-1][1], [item[3]], k + 1
            while k < len(lines) and lines[k].strip() and not re.match(r"^\s*([-*+]|\d{1,9}[.)])\s+|^\s*(```|~~~)|^#{1,6}\s", lines[k]):
                text.append(lines[k].strip())
                k += 1
            at = _say(tree, "\n".join(text), "list_item", group, enumerated=ordered, marker=f"{count[group]}." if ordered else "-")
            count[group] += 1
            lists[-1] = (indent, group, ordered, at)
        elif re.match(r"^ {0,3}([-*_]\s*){3,}$", line):
            k += 1
        elif "|" in line and k + 1 < len(lines) and re.match(r"^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$", lines[k + 1]):
            first = k
            while k < len(lines) and "|" in lines[k]:
                k += 1
            tree.add("table", None, up(), cells=pipe_table(lines[first:k]))
        else:
            text = [line.strip().lstrip("> ")]
            k += 1
            while k < len(lines) and lines[k].strip() and not re.match(r"^\s*([-*+]|\d{1,9}[.)])\s+|^\s*(```|~~~)|^#{1,6}\s", lines[k]):
                text.append(lines[k].strip().lstrip("> "))
                k += 1
            _say(tree, "\n".join(text), "text", lists[-1][3] if lists and line.startswith((" ", "\t")) else up())
    return tree


def to_html(content: str) -> str:
    """Markdown with HTML blocks as HTML: blocks that are Markdown are rendered, the others go through."""
    out = []
    for block in re.split(r"\n\s*\n", content):
        if re.match(r"^\s*<", block):
            out.append(block)
            continue
        for x in markdown_items(block):
            out.append(x)
    return "<body>" + "\n".join(out) + "</body>"


def markdown_items(block: str):
    head = re.match(r"^(#{1,6})\s+(.*)$", block.strip())
    wrap = {"bold": "b", "italic": "i", "strikethrough": "s", "code": "code"}

    def rendered(text):
        parts = []
        for t, s, k in inline(text):
            x = entities.escape(t, quote=False) if "image" not in s else f'<img src="{k}" alt="{s[1]}">'
            for style in s if "image" not in s else ():
                x = f"<{wrap[style]}>{x}</{wrap[style]}>"
            parts.append(f'<a href="{k}">{x}</a>' if k and "image" not in s else x)
        return "".join(parts)

    if head:
        yield f"<h{len(head[1])}>{rendered(head[2])}</h{len(head[1])}>"
    elif re.match(r"^\s*([-*+]|\d+[.)])\s+", block):
        tag = "ol" if block.strip()[0].isdigit() else "ul"
        yield f"<{tag}>" + "".join(f"<li>{rendered(re.sub(r'^\s*([-*+]|\d+[.)])\s+', '', x))}</li>" for x in block.split("\n") if x.strip()) + f"</{tag}>"
    elif block.strip():
        yield f"<p>{rendered(block)}</p>"


# ---------------------------------------------------------------- AsciiDoc


def asciidoc(content: str) -> Tree:
    """Title, sections, lists by indent, tables, pictures with captions, paragraphs of joined lines."""
    tree, para, caption = Tree(), [], None
    heads: dict[int, int] = {}
    lists: list[tuple[int, int]] = []
    rows: list[list[str]] | None = None
    up = lambda: heads[max(heads)] if heads else -1

    def flush():
        nonlocal para
        if para:
            tree.add("text", " ".join(para), up())
            para = []

    def put(at: int):
        nonlocal caption
        if caption:
            tree.add("caption", caption, at)
            caption = None

    for raw in [*content.splitlines(), ""]:
        line = raw.rstrip()
        item = re.match(r"^(\s*)(\*+|-+|\d+\.|\w+\.)\s+(.+)$", line)
        if rows is not None and line.strip() and (line.startswith("|===") or line.lstrip().startswith("|")):
            if line.startswith("|==="):
                at = tree.add("table", None, up(), cells=[Cell(r, c, t, column_header=r == 0) for r, row in enumerate(rows) for c, t in enumerate(row)])
                put(at)
                rows = None
            else:
                rows.append([x.strip() for x in line.strip().strip("|").split("|")])
        elif line.startswith("= ") and not tree.items:
            heads = {1: tree.add("title", line[2:].strip())}
        elif re.match(r"^==+ +.+", line):
            flush()
            level = len(line) - len(line.lstrip("="))
            heads = {k: v for k, v in heads.items() if k < level}
            heads[level] = tree.add("section_header", line.lstrip("=").strip(), up(), level=level - 1)
            lists = []
        elif line.startswith("|==="):
            flush()
            rows = []
        elif line.startswith("image::"):
            flush()
            found = re.match(r"^image::([^\[]*)(?:\[(.*)\])?", line)
            at = tree.add("picture", None, up(), link=found[1])
            alt = (found[2] or "").split(",")[0].strip().strip('"')
            caption = caption or (alt if "=" not in alt else None) or None
            put(at)
        elif re.match(r"^\.\S.+", line):
            flush()
            caption = line[1:].strip()
        elif item and not para:
            depth = len(item[1]) if item[2][0] not in "*" else len(item[1]) + len(item[2]) - 1
            ordered = item[2][0] not in "*-"
            while lists and lists[-1][0] > depth:
                lists.pop()
            if not lists or lists[-1][0] < depth:
                lists.append((depth, tree.add("list", "ordered list" if ordered else "list", lists[-1][1] if lists else up(), enumerated=ordered)))
            tree.add("list_item", item[3].strip(), lists[-1][1], enumerated=ordered, marker=item[2] if ordered else "-")
        elif not line.strip():
            flush()
            lists = []
        else:
            para.append(line.strip())
    return tree


# ---------------------------------------------------------------- comma-separated values


def delimiter(first: str) -> str:
    """The delimiter of a file by its first line: the most frequent outside quotes of , ; tab | and colon."""
    bare = re.sub(r'"[^"]*"', "", first)
    counts = [(bare.count(d), -k, d) for k, d in enumerate(",;\t|:")]
    return max(counts)[2] if max(counts)[0] else ","


def separated(content: str) -> Tree:
    """One table; its first row is the header and rows may be of different length."""
    tree = Tree()
    lines = content.removeprefix("﻿")
    if lines.strip():
        rows = [r for r in csv.reader(io.StringIO(lines, newline=""), delimiter=delimiter(lines.split("\n", 1)[0]), strict=True) if r]
        tree.add("table", None, cells=[Cell(r, c, t.strip(), column_header=r == 0) for r, row in enumerate(rows) for c, t in enumerate(row)])
    return tree


# ---------------------------------------------------------------- WebVTT

STAMP = re.compile(r"^(?:(\d{2,}):)?([0-5]\d):([0-5]\d)\.(\d{3})$")
_SPAN = re.compile(r"<(/?)([vcibu]|ruby|rt|lang)((?:\.[^\s>.]+)*)(?:[ \t]+([^>]*))?>")


def seconds(stamp: str) -> float | None:
    m = STAMP.match(stamp.strip())
    return int(m[1] or 0) * 3600 + int(m[2]) * 60 + int(m[3]) + int(m[4]) / 1000 if m else None


def cues(content: str):
    """(identifier, start, end, payload) of each valid cue; invalid ones are passed over."""
    text = content.removeprefix("﻿").replace("\r\n", "\n").replace("\r", "\n")
    if not re.match(r"^WEBVTT(?:[ \t\n]|$)", text):
        raise ValueError("not a WebVTT file")
    for block in re.split(r"\n{2,}", text)[1:]:
        lines = [x for x in block.strip("\n").split("\n") if x]
        if not lines or re.match(r"^(NOTE|STYLE|REGION)(\s|$)", lines[0]):
            continue
        name = lines.pop(0) if "-->" not in lines[0] else None
        found = re.match(r"^\s*(\S+)\s+-->\s+(\S+)", lines[0]) if lines else None
        if not found:
            continue
        a, b, payload = seconds(found[1]), seconds(found[2]), "\n".join(lines[1:])
        if a is None or b is None or b <= a or "-->" in payload:
            continue
        yield name, found[1], found[2], payload


def webvtt(content: str) -> Tree:
    """A section for each cue: its identifier, its timing, and its text in runs of voice and style."""
    tree = Tree()
    for name, a, b, payload in cues(content):
        at = tree.add("section", "cue")
        if name:
            tree.add("text", name, at)
        tree.add("text", f"{a} --> {b}", at)
        for line in payload.split("\n"):
            runs, open_, pos = [], [], 0
            for m in [*_SPAN.finditer(line), None]:
                t = entities.unescape(line[pos : m.start() if m else len(line)])
                if t.strip():
                    runs.append((t.strip(), list(open_)))
                if m is None:
                    break
                pos = m.end()
                if m[1]:
                    while open_ and open_.pop()[0] != m[2]:
                        pass
                else:
                    open_.append((m[2], [c for c in m[3].split(".") if c], (m[4] or "").strip()))
            voice = next((f"{v}{' (' + ', '.join(c) + ')' if c else ''}: " for _, o in runs for t, c, v in o if t == "v"), None)
            names = {"b": "bold", "i": "italic", "u": "underline"}
            if voice or len(runs) > 1:
                group = tree.add("inline", None, at)
                if voice:
                    tree.add("text", voice, group)
                for t, o in runs:
                    tree.add("text", t, group, style=",".join(names[x] for x, _, _ in o if x in names) or None)
            elif runs:
                tree.add("text", runs[0][0], at, style=",".join(names[x] for x, _, _ in runs[0][1] if x in names) or None)
    return tree
