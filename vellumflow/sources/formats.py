"""Formats: their extensions and media types, and how a file's format is found."""

from __future__ import annotations

import io
import re
import zipfile

# Extensions and media types of each format.
EXTENSIONS = {
    "docx": ("docx", "dotx", "docm", "dotm"), "pptx": ("pptx", "potx", "ppsx", "pptm", "potm", "ppsm"), "html": ("html", "htm", "xhtml"), "image": ("jpg", "jpeg", "png", "tif", "tiff", "bmp", "webp"), "pdf": ("pdf",),
    "asciidoc": ("adoc", "asciidoc", "asc"), "md": ("md",), "csv": ("csv",), "xlsx": ("xlsx", "xlsm"), "xml_uspto": ("xml", "txt"), "xml_jats": ("xml", "nxml"), "mets_gbs": ("tar.gz",), "json_tree": ("json",),
    "audio": ("wav", "mp3", "m4a", "aac", "ogg", "flac", "mp4", "avi", "mov"), "vtt": ("vtt",), "ofd": ("ofd",),
}
MEDIA_TYPES = {
    "docx": ("application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/vnd.openxmlformats-officedocument.wordprocessingml.template"),
    "pptx": ("application/vnd.openxmlformats-officedocument.presentationml.template", "application/vnd.openxmlformats-officedocument.presentationml.slideshow", "application/vnd.openxmlformats-officedocument.presentationml.presentation"),
    "html": ("text/html", "application/xhtml+xml"), "xml_jats": ("application/xml",), "image": ("image/png", "image/jpeg", "image/tiff", "image/gif", "image/bmp", "image/webp"), "pdf": ("application/pdf",), "asciidoc": ("text/asciidoc",),
    "md": ("text/markdown", "text/x-markdown"), "csv": ("text/csv",), "xlsx": ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",), "xml_uspto": ("application/xml", "text/plain"), "mets_gbs": ("application/mets+xml",),
    "json_tree": ("application/json",), "audio": ("audio/x-wav", "audio/mpeg", "audio/wav", "audio/mp3", "audio/mp4", "audio/m4a", "audio/aac", "audio/ogg", "audio/flac", "audio/x-flac", "video/mp4", "video/avi", "video/x-msvideo", "video/quicktime"),
    "vtt": ("text/vtt",), "ofd": ("application/ofd",),
}
# What the content of binary formats begins with.
MAGIC = ((b"%PDF", "pdf"), (b"\x89PNG", "image"), (b"\xff\xd8\xff", "image"), (b"II*\x00", "image"), (b"MM\x00*", "image"), (b"BM", "image"), (b"GIF8", "image"), (b"ID3", "audio"), (b"fLaC", "audio"), (b"OggS", "audio"))


def by_media_type(media: str) -> list[str]:
    return [f for f, types in MEDIA_TYPES.items() if media in types]


def looks_separated(text: str) -> bool:
    """At least two lines that one delimiter (comma, semicolon, tab or bar) divides into as many fields."""
    lines = [x for x in text.split("\n")[:5] if x.strip()]
    if len(lines) < 2:
        return False
    return any(len({x.count(d) for x in lines[:3]}) == 1 and lines[0].count(d) > 0 for d in ",;\t|")


def detect(name: str, content: bytes, tail: bytes | None = None) -> str | None:
    """The format of a file: magic bytes, archive contents, extension, then the look of the text.

    ``content`` may be the first 8 KB only; then ``tail``, the last bytes of an archive, holds its index. An archive whose index
    is longer than that goes by its extension."""
    low, head = name.lower(), content[:8192]
    for magic, kind in MAGIC:
        if head.startswith(magic):
            return kind
    if head.startswith(b"RIFF"):
        return "audio" if head[8:12] in (b"WAVE", b"AVI ") else "image"
    if head.startswith(b"PK"):
        try:
            names = set(zipfile.ZipFile(io.BytesIO(content if tail is None else tail)).namelist())
        except zipfile.BadZipFile:
            return None if tail is None else next((f for f in ("docx", "pptx", "xlsx", "ofd") for x in EXTENSIONS[f] if low.endswith("." + x)), None)
        marks = (("word/document.xml", "docx"), ("ppt/presentation.xml", "pptx"), ("xl/workbook.xml", "xlsx"), ("OFD.xml", "ofd"))
        return next((kind for part, kind in marks if part in names), None)
    if head.startswith(b"\x1f\x8b"):
        return "mets_gbs"
    text = head.decode("utf-8", "replace").lstrip("﻿")
    if text.startswith("PATN\r\n") or text.startswith("PATN\n"):
        return "xml_uspto"
    if re.match(r"WEBVTT(?:[ \t\r\n]|$)", text):
        return "vtt"
    bare = re.sub(r"<!--.*?-->", "", text, flags=re.S).lstrip()
    doctype = re.search(r"<!DOCTYPE\s+([^>\[]*)", bare)
    if bare.startswith("<?xml") or doctype:
        kind = doctype[1] if doctype else ""
        if re.search(r"us-patent|PATDOC|pap-v1|patent-application", kind):
            return "xml_uspto"
        if "JATS" in kind or "journalpublishing" in kind or "archivearticle" in kind:
            return "xml_jats"
        if kind.lower().startswith("html") or "http://www.w3.org/1999/xhtml" in bare[:2000]:
            return "html"
    suffix = next((f for f, xs in EXTENSIONS.items() for x in xs if low.endswith("." + x) and f not in ("xml_uspto", "xml_jats", "docx", "pptx", "xlsx", "ofd")), None)
    if suffix:
        return suffix
    if re.match(r"(?i)<(html|head|body|!doctype html)", bare):
        return "html"
    if bare.startswith("<") and low.endswith((".xml", ".nxml", ".txt")):  # without a document type: by the first element
        element = re.search(r"<([A-Za-z][\w.-]*)", re.sub(r"<\?.*?\?>|<!.*?>", "", bare, flags=re.S))
        if element and element[1] in ("us-patent-grant", "us-patent-application", "PATDOC", "patent-application-publication"):
            return "xml_uspto"
        if element and element[1] == "article":
            return "xml_jats"
    if looks_separated(text):
        return "csv"
    return None
