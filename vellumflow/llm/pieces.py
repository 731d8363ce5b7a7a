"""Quick splitting of plain chunks as the word-level tokenizer file's normaliser and splitter would.

Only for chunks of printable ASCII and the letters U+00C0 to U+017F (which the normaliser leaves composed, and which
lower-case without context); all others are left to the tokenizers library itself.
"""

from __future__ import annotations

import re

_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
_PLAIN_TEXT = re.compile("[!-~À-ÖØ-öø-įı-ſ \\t\\n\\r]*")
# Fixed value: the splitter's pattern, for the letters above (its letters come first here: nothing else starts with one).
_SPLIT = re.compile("[a-zÀ-ÖØ-öø-ſ]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\sa-zÀ-ÖØ-öø-ſ0-9]+")


def plain_pieces(chunk: str) -> list[str] | None:
    """The lower-case pieces of a chunk without white space, or None where the library has to decide."""
    if _PLAIN.fullmatch(chunk) is None or "<|" in chunk:
        return None
    return _SPLIT.findall(chunk.lower())


_SPLIT_SPACED = re.compile(" |" + _SPLIT.pattern)


def is_plain(chunk: str) -> bool:
    return _PLAIN.fullmatch(chunk) is not None and "<|" not in chunk


def pieces_of(chunks: list[str]) -> list[str]:
    """The lower-case pieces of plain chunks in sequence, with a space between those of one chunk and those of the next."""
    return _SPLIT_SPACED.findall(" ".join(chunks).lower())


def text_pieces(text: str) -> list[str] | None:
    """The same for a whole text, of chunks divided by space, tab, line feed or carriage return."""
    if "<|" in text:
        return None
    if not (text.isascii() and text.replace("\n", " ").replace("\t", " ").replace("\r", " ").isprintable()) and _PLAIN_TEXT.fullmatch(text) is None:
        return None
    return _SPLIT.findall(text.lower())


class Recent(dict):
    """A table of about ``most`` entries: the older half goes when the newer is full; what is still used moves over."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most // 2, {}

    def __missing__(self, key):
        value = self.older[key]
        self[key] = value
        return value

    def has(self, key) -> bool:
        return key in self or key in self.older

    def turn(self) -> None:
        """To be called between uses; lets the older half go when it is time."""
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
