"""Chunks of document items: one for each element, or split and merged to a number of tokens."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.plans.serialize import _table

CHUNK_FIELDS = "chunk_no int, text string, headings array<string>, captions array<string>, item_refs array<int>, n_tokens int"
_ARROW = (pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32())
#: What chunks are made of; no other column of an item goes to Python.
_SEEN = ("ord", "parent", "label", "layer", "text", "marker", "cells")


def words(text: str) -> int:
    """The default count of tokens."""
    return len(text.split())


def _elements(rows: list[dict]):
    """(text, headings, captions, places) of each element of one document, in reading order."""
    by = {r["ord"]: r for r in rows}
    below: dict[int, list[dict]] = {}
    for r in rows:
        below.setdefault(r["parent"], []).append(r)

    def title(r):
        return r["text"] or " ".join(x["text"] or "" for c in below.get(r["ord"], []) if c["label"] == "inline" for x in below.get(c["ord"], []))

    def path(r):
        out, at = [], r["parent"]
        while at in by:
            if by[at]["label"] in ("title", "section_header"):
                out.append(title(by[at]))
            at = by[at]["parent"]
        return out[::-1]

    def said(r):
        if r["label"] == "table":
            return _table(r["cells"]) or ""
        if r["label"] == "inline":
            return " ".join(x["text"] or "" for x in below.get(r["ord"], []))
        return r["text"] or " ".join(said(c) for c in below.get(r["ord"], []) if c["label"] == "inline")

    used: set[int] = set()
    for r in rows:
        up = by.get(r["parent"])
        if r["ord"] in used or r["layer"] != "body" or r["label"] in ("title", "section_header", "section", "chapter", "caption") or (up and up["label"] in ("inline",)):
            continue
        if r["label"] == "inline" and up and up["label"] in ("title", "section_header", "list_item") and not up["text"]:
            continue
        if r["label"] == "list":
            members, todo = [], list(below.get(r["ord"], []))
            while todo:
                x = todo.pop(0)
                used.add(x["ord"])
                if x["label"] == "list_item":
                    members.append(x)
                todo = list(below.get(x["ord"], [])) + todo
            text = "\n".join(f"{x['marker'] or '-'} {said(x)}" for x in members)
            refs = [x["ord"] for x in members]
        else:
            text, refs = said(r), [r["ord"]]
        captions = [c["text"] for c in below.get(r["ord"], []) if c["label"] == "caption"]
        if text.strip() or captions:
            yield text, path(r), captions, refs


def _grouped(rows: DataFrame, key: str, order: str, columns: tuple[str, ...], make: Callable[[list[dict]], list[tuple]]) -> DataFrame:
    """(key, CHUNK_FIELDS): what ``make`` makes of the rows of each document in order, numbered; as Arrow, since a document costs
    more as a pandas frame than its chunks do."""
    kind = rows.schema[key].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        made = [(n, *r) for n, r in enumerate(make(sorted(table.select(columns).to_pylist(), key=lambda r: r[order])))]
        of = pa.array([table.column(key)[0].as_py()] * len(made), table.schema.field(key).type)
        return pa.table([of, *(pa.array([r[k] for r in made], t) for k, t in enumerate(_ARROW))], names=["key", *(f.split()[0] for f in CHUNK_FIELDS.split(", "))])

    return rows.select(key, *columns).groupBy(key).applyInArrow(run, f"key {kind}, {CHUNK_FIELDS}").withColumnRenamed("key", key)


def hierarchical(items: DataFrame, key: str = "doc_id", count: Callable[[str], int] = words) -> DataFrame:
    """One chunk for each element; the items of a list are one element. Headings and captions go along."""
    live = items.where("error IS NULL") if "error" in items.columns else items
    return _grouped(live, key, "ord", _SEEN, lambda rows: [(t, h, c, r, count(t)) for t, h, c, r in _elements(rows)])


def _pieces(text: str, most: int, count: Callable[[str], int]):
    """Parts of at most ``most`` tokens, cut between words; a single longer word stands alone. A part's end is found by doubling
    and halving, so a part costs a few counts and not one for each word; counts are taken to grow with the text."""
    own = text.split(" ")
    first = 0
    while first < len(own):
        fits = lambda k: count(" ".join(own[first : first + k])) <= most  # noqa: B023, E731
        good, bad = 1, 2
        while first + bad <= len(own) and fits(bad):
            good, bad = bad, 2 * bad
        bad = min(bad, len(own) - first + 1)
        while bad - good > 1:
            middle = (good + bad) // 2
            good, bad = (middle, bad) if fits(middle) else (good, middle)
        yield " ".join(own[first : first + good])
        first += good


def hybrid(chunks: DataFrame, max_tokens: int, key: str = "doc_id", count: Callable[[str], int] = words, merge_peers: bool = True) -> DataFrame:
    """Chunks of at most ``max_tokens``: larger ones are split, then neighbours with the same headings and captions are
    merged while they fit."""

    def make(rows: list[dict]) -> list[tuple]:
        out: list[list] = []
        for r in rows:
            h, c, refs = r["headings"], r["captions"], r["item_refs"]
            for t in [r["text"]] if count(r["text"]) <= max_tokens else _pieces(r["text"], max_tokens, count):
                last = out[-1] if out else None
                if merge_peers and last and last[1] == h and last[2] == c and count(last[0] + "\n" + t) <= max_tokens:
                    last[0] += "\n" + t
                    last[3] += [x for x in refs if x not in last[3]]
                else:
                    out.append([t, h, c, list(refs)])
        return [(*r, count(r[0])) for r in out]

    return _grouped(chunks, key, "chunk_no", ("chunk_no", "text", "headings", "captions", "item_refs"), make)


def contextualize(chunks: DataFrame) -> DataFrame:
    """``chunks`` with context: headings, captions and text, a line each, as an embedding model gets them."""
    return chunks.withColumn("context", F.concat_ws("\n", F.array_join("headings", "\n"), F.nullif(F.array_join("captions", "\n"), F.lit("")), "text"))
