"""Column expressions over text. All are built-in expressions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of web text and what they are replaced by.
WEB_SPACES = "  "
WEB_HYPHENS = "‐‑‒–—―"
WEB_SINGLE_QUOTES = "‘’"
WEB_DOUBLE_QUOTES = "“”"
WEB_REMOVED = "​‌‍­﻿⁠"
WEB_ELLIPSIS = "…"

# Characters of printed text (fraction slash, quotes, bullet) and their plain forms.
PRINT_FROM, PRINT_TO = "⁄’‘“”•", "/''\"\"·"

# What the text-quality score looks for.
GLYPH_CODE = r"GLYPH<[0-9A-Fa-f]+>"
SLASH_G = r"(?:/G\d+){2,}"
FRAGMENTED = r"(?U)\b[A-Za-z](?:/[a-z]{1,3}\.[a-z]{1,3}){2,}\b"
SLASH_START = r"(?U)^(?:/\w+\s*){2,}"


def web_clean(c: Column) -> Column:
    kept = WEB_SPACES + WEB_HYPHENS + WEB_SINGLE_QUOTES + WEB_DOUBLE_QUOTES
    becomes = " " * len(WEB_SPACES) + "-" * len(WEB_HYPHENS) + "'" * len(WEB_SINGLE_QUOTES) + '"' * len(WEB_DOUBLE_QUOTES)
    return F.replace(F.translate(c, kept + WEB_REMOVED, becomes), F.lit(WEB_ELLIPSIS), F.lit("..."))


def print_clean(c: Column) -> Column:
    return strip(F.translate(c, PRINT_FROM, PRINT_TO))


def strip(c: Column) -> Column:
    """Without white space at either end (all of Unicode's, not only the space)."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def clamp_underscores(c: Column) -> Column:
    return F.regexp_replace(c, "_{11,}", "_" * 10)


def quality(c: Column) -> Column:
    """1 for sound text, 0 for text with decoding garbage; a tenth less for each fragment if there are three or more."""
    fragments = F.regexp_count(c, F.lit(FRAGMENTED))
    garbage = c.contains("�") | c.rlike(GLYPH_CODE) | c.rlike(SLASH_G) | c.rlike(SLASH_START)
    return F.when(garbage, 0.0).otherwise(F.when(fragments >= 3, F.greatest(F.lit(0.0), 1.0 - 0.1 * fragments)).otherwise(1.0))


def vtt_seconds(c: Column) -> Column:
    """Seconds of a subtitle time stamp, null if it is not valid."""
    stamp = r"^(?:(\d{2,}):)?([0-5]\d):([0-5]\d)\.(\d{3})$"
    part = lambda k: F.regexp_extract(c, stamp, k)
    hours = F.coalesce(F.nullif(part(1), F.lit("")).cast("double"), F.lit(0.0))
    return F.when(c.rlike(stamp), hours * 3600 + part(2).cast("double") * 60 + part(3).cast("double") + part(4).cast("double") / 1000)


def resolve_url(href: Column, base: Column) -> Column:
    """``href`` against ``base``: absolute and in-page ones as they are, // gets https:, / the host, others the folder."""
    host = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("#"), href)
        .when(href.startswith("//"), F.concat(F.lit("https:"), href))
        .when(href.startswith("/"), F.concat(host, href))
        .otherwise(F.concat(folder, href))
    )


def asciidoc_uri(c: Column) -> Column:
    return F.when(c.startswith("http"), c).when(c.startswith("//"), F.concat(F.lit("file:"), c)).when(c.startswith("/"), F.concat(F.lit("file:/"), c)).otherwise(F.concat(F.lit("file://"), c))


def span_value(c: Column) -> Column:
    """The whole number that a span attribute starts with, else 1."""
    found = F.regexp_extract(strip(c), r"^(\d+)", 1)
    return F.when(found != "", found.cast("int")).otherwise(F.lit(1))


def code_fence(c: Column) -> Column:
    """The inside of a text that is one fenced block, else the text."""
    fence = r"(?s)^```(?:\w*\n)?(.*?)```(\n)*$"
    return F.when(c.rlike(fence), F.regexp_extract(c, fence, 1)).otherwise(c)


def language_tag(c: Column) -> tuple[Column, Column]:
    """(rest, language) of a text that may start with <_language_>."""
    tag = r"(?s)^<_([^_>]+)_>\s*(.*)"
    return F.when(c.rlike(tag), F.regexp_extract(c, tag, 2)).otherwise(c), F.when(c.rlike(tag), F.regexp_extract(c, tag, 1))


def generated(c: Column) -> Column:
    """Model output up to its end mark, without leading white space."""
    return F.regexp_replace(F.substring_index(c, "<end_of_utterance>", 1), r"(?U)^\s+", "")


def private_use(c: Column) -> Column:
    """How many characters are in the private use area U+E000 to U+F8FF."""
    return F.length(c) - F.length(F.regexp_replace(c, "[\\x{E000}-\\x{F8FF}]", ""))


def script_name(script: Column) -> Column:
    """The name under which trained data of a script is kept."""
    # Script names and what they are called there.
    return F.when(script.isin("Katakana", "Hiragana"), "Japanese").when(script == "Han", "HanS").when(script == "Korean", "Hangul").otherwise(script)


def page_turn(clockwise: Column) -> Column:
    """A clockwise turn in degrees as the counter-clockwise angle from 0 to 359."""
    return F.pmod(-clockwise, F.lit(360))
