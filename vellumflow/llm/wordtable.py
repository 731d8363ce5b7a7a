"""Texts as numbers of their distinct chunks (stretches without space, tab, line feed and carriage return), and what is known of chunks,
in arrays: no object is made for a chunk that was met before.

A chunk of up to 16 bytes is two 64-bit words, read from the batch's bytes at once, and its size. The chunks of a batch are sorted by
a hash of these; equal neighbours get one number, and all three are compared with the first of their number, so numbers are exact.
The table of known chunks is sorted by the same hash and compares all three as well. Longer chunks, and any whose words differ from
those behind their hash, go through dicts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .pieces import Recent

U64 = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\r")] = True
#: The bytes of a little-endian word that a chunk of so many bytes fills.
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
WORDS = 16


@dataclass
class Division:
    """The chunks of some texts: the distinct ones' places in ``data`` (those without ``long`` first, with ``keys`` sorted by the first
    row), the number of each chunk in sequence, and where each text's chunks begin and end in that. A number may have no chunk."""

    data: bytes
    begin: np.ndarray
    size: np.ndarray
    keys: np.ndarray
    which: np.ndarray
    of_text: np.ndarray

    def chunk(self, k: int) -> bytes:
        return self.data[self.begin[k] : self.begin[k] + self.size[k]]


def divide(texts: pa.Array) -> Division:
    """The chunks of string texts; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, size = int(at[0]), int(at[-1] - at[0])
    if not size:
        none = np.zeros(0, np.int64)
        return Division(b"", none, none, np.zeros((4, 0), U64), none, np.zeros(len(texts) + 1, np.int64))
    raw = np.zeros(size + 24, np.uint8)
    raw[:size] = np.frombuffer(texts.buffers()[2], np.uint8, size, first)
    at = at - first
    full = ~_BLANK[raw[:size]]
    begins = full.copy()
    begins[1:] &= ~full[:-1]
    cut = at[(at > 0) & (at < size)]
    begins[cut] = full[cut]  # a chunk ends with its text
    starts = np.flatnonzero(begins)
    full[:-1] &= ~full[1:] | begins[1:]
    sizes = np.flatnonzero(full) + 1 - starts

    words = np.ndarray((size + 16,), "<u8", raw, strides=(1,))
    a, b = words[starts], words[np.minimum(starts + 8, size + 8)]
    a &= _MASK[np.minimum(sizes, 8)]
    b &= _MASK[np.clip(sizes - 8, 0, 8)]
    h = (a ^ (a >> U64(31))) * U64(0x9E3779B97F4A7C15) + (b ^ (b >> U64(29))) * U64(0xC2B2AE3D27D4EB4F)
    h += sizes.astype(U64) * U64(0x165667B19E3779F9)  # else a zero byte at the end would make no difference
    h ^= h >> U64(32)
    order = np.argsort(h)
    ranked = h[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    heads = order[new]
    same = heads[which]
    odd = np.flatnonzero((sizes > WORDS) | (sizes != sizes[same]) | (a != a[same]) | (b != b[same]))
    data = raw[:size].tobytes()
    known: dict[bytes, int] = {}
    others = []
    for k, s, n in zip(odd.tolist(), starts[odd].tolist(), sizes[odd].tolist()):
        if (number := known.setdefault(data[s : s + n], len(heads) + len(known))) == len(heads) + len(others):
            others.append(k)
        which[k] = number
    listed = np.concatenate([heads, np.array(others, np.int64)])
    return Division(data, starts[listed], sizes[listed], np.stack([h[heads], a[heads], b[heads], sizes[heads].astype(U64)]), which, np.searchsorted(starts, at))


class Table:
    """The ids of chunks, of about ``most`` at a time: when it is full, what was not met since the last time goes."""

    def __init__(self, most: int):
        self.most = most
        self.keys = np.zeros((4, 0), U64)
        self.begin, self.size, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids, self.n = np.zeros(1 << 16, np.uint32), 0
        self.others: Recent = Recent(most // 16)

    def _put(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) of ids written behind the others, which takes ``n`` no further."""
        flat = np.frombuffer(b"".join(parts), "<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        if self.n + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.n], np.zeros(max(len(self.ids), 2 * len(flat)), np.uint32)])
        self.ids[self.n : self.n + len(flat)] = flat
        return self.n + np.cumsum(size) - size, size

    def _forget(self) -> None:
        keep = self.met
        self.keys, self.begin, self.size = self.keys[:, keep], self.begin[keep], self.size[keep]
        begin = np.cumsum(self.size) - self.size
        self.n = int(self.size.sum())
        self.ids[: self.n] = self.ids[np.arange(self.n) + np.repeat(self.begin - begin, self.size)]
        self.begin, self.met = begin, np.zeros(len(begin), bool)

    def places(self, found: Division, learn: Callable[[list[bytes]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """(begin, size) in ``ids`` of the ids of each distinct chunk, good until the next call; ``learn`` gives the ids of chunks
        that are not here."""
        if len(self.begin) > self.most:
            self._forget()
        own = found.keys.shape[1]
        begin, size = np.zeros(len(found.begin), np.int64), np.zeros(len(found.begin), np.int64)
        at = np.searchsorted(self.keys[0], found.keys[0])
        at[at == len(self.begin)] = 0
        hit = (self.keys[:, at] == found.keys).all(0) if len(self.begin) else np.zeros(own, bool)
        begin[:own][hit], size[:own][hit] = self.begin[at[hit]], self.size[at[hit]]
        self.met[at[hit]] = True
        new = np.flatnonzero(~hit & (found.size[:own] <= WORDS))
        others = [found.chunk(k) for k in range(own, len(found.begin))]
        self.others.turn()
        ask = [x for x in others if not self.others.has(x)]
        if len(new) or ask:
            ids = learn([found.chunk(k) for k in new.tolist()] + ask)
            self.others.update(zip(ask, ids[len(new) :]))
            begin[new], size[new] = self._put(ids[: len(new)])
            self.n += int(size[new].sum())
            fresh = np.concatenate([self.keys[0], found.keys[0, new]])
            order = np.argsort(fresh, kind="stable")
            self.keys = np.concatenate([self.keys, found.keys[:, new]], 1)[:, order]
            self.begin, self.size = np.concatenate([self.begin, begin[new]])[order], np.concatenate([self.size, size[new]])[order]
            self.met = np.concatenate([self.met, np.ones(len(new), bool)])[order]
        if others:
            begin[own:], size[own:] = self._put([self.others[x] for x in others])
        return begin, size
