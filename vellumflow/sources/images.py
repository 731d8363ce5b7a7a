"""Sizes and frames of pictures from their headers; no pixel is decoded."""

from __future__ import annotations

import struct

from vellumflow.sources.tree import Tree


def frames(content: bytes) -> list[tuple[int, int]]:
    """(width, height) of each frame of a PNG, GIF, BMP, JPEG, WebP or TIFF file."""
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return [struct.unpack(">II", content[16:24])]
    if content[:4] == b"GIF8":
        return [struct.unpack("<HH", content[6:10])]
    if content[:2] == b"BM":
        w, h = struct.unpack("<ii", content[18:26])
        return [(w, abs(h))]
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP":
        return [_webp(content)]
    if content[:2] == b"\xff\xd8":
        return [_jpeg(content)]
    if content[:4] in (b"II*\x00", b"MM\x00*"):
        return _tiff(content, "<" if content[:1] == b"I" else ">")
    raise ValueError("not a picture of a known kind")


def _jpeg(content: bytes) -> tuple[int, int]:
    at = 2
    while at + 9 < len(content):
        if content[at] != 0xFF:
            at += 1
            continue
        mark = content[at + 1]
        if mark in (0xFF, 0x01) or 0xD0 <= mark <= 0xD9:
            at += 1 if mark == 0xFF else 2
            continue
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", content[at + 5 : at + 9])
            return w, h
        at += 2 + struct.unpack(">H", content[at + 2 : at + 4])[0]
    raise ValueError("no size in the file")


def _webp(content: bytes) -> tuple[int, int]:
    kind = content[12:16]
    if kind == b"VP8X":
        return int.from_bytes(content[24:27], "little") + 1, int.from_bytes(content[27:30], "little") + 1
    if kind == b"VP8L":
        bits = int.from_bytes(content[21:25], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    w, h = struct.unpack("<HH", content[26:30])
    return w & 0x3FFF, h & 0x3FFF


def _tiff(content: bytes, order: str) -> list[tuple[int, int]]:
    out, seen = [], set()
    at = struct.unpack(f"{order}I", content[4:8])[0]
    while at and at not in seen and at + 2 <= len(content):
        seen.add(at)
        n = struct.unpack(f"{order}H", content[at : at + 2])[0]
        tags = {}
        for k in range(n):
            tag, kind, _, value = struct.unpack(f"{order}HHI4s", content[at + 2 + 12 * k : at + 14 + 12 * k])
            tags[tag] = struct.unpack(f"{order}H", value[:2])[0] if kind == 3 else struct.unpack(f"{order}I", value)[0]
        out.append((tags.get(256, 0), tags.get(257, 0)))
        at = struct.unpack(f"{order}I", content[at + 2 + 12 * n : at + 6 + 12 * n])[0]
    return out


def parse(content: bytes) -> Tree:
    """A page with one picture for each frame; their text needs a model."""
    tree = Tree()
    for n, (w, h) in enumerate(frames(content), 1):
        tree.add("picture", None, tree.add("chapter", f"page {n}: {w} x {h}", page=n), page=n)
    return tree
