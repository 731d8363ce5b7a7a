"""Vectorised scanning of UTF-8 text: words, their 64-bit hashes and hashes of word windows.

Everything works on the bytes of an Arrow string column, many documents at a time, in pieces of a bounded number
of bytes, so memory does not follow the length of a text. A word is a maximal run of bytes other than the ASCII
white space x20 and x09-x0D. Nulls count as empty texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
PIECE_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2**64)
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[65:91] = _BYTE[97:123]
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (multiply and xor-shift)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        steps = np.full(max(n, PIECE_BYTES + 65536), base, dtype=U64)
        steps[0] = 1
        have = _powers[kind] = np.cumprod(steps, dtype=U64)
    return have[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(column) else raw[:0], at - at[0]


def pieces(offsets: np.ndarray):
    """Ranges of documents of at most PIECE_BYTES together; a longer document stands alone."""
    first, n, limit = 0, len(offsets) - 1, PIECE_BYTES
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _word_bounds(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words; ``cuts`` are offsets at which a document begins."""
    inside = ~WHITE[raw]
    edge = np.empty(len(raw), dtype=bool)
    edge[:1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    starts = edge & inside
    cut = cuts[cuts < len(raw)]
    starts[cut] = inside[cut]
    ends = np.zeros(len(raw) + 1, dtype=bool)
    ends[:-1] = edge & ~inside
    ends[cut] |= np.concatenate([[False], inside])[cut]
    ends[len(raw)] = bool(len(raw)) and inside[-1]
    if len(ends):
        ends[0] = False
    return np.flatnonzero(starts), np.flatnonzero(ends)


def _span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    total = np.zeros(len(raw) + 1, dtype=U64)
    value = table[raw]
    value *= _power("up", _BASE, len(raw))
    np.cumsum(value, out=total[1:])
    out = total[ends] - total[starts]
    out *= _power("down", _BASE_INV, len(raw) + 1)[starts]
    return mix(out + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def parts(raw: np.ndarray, offsets: np.ndarray):
    """(first document, last, from byte, to byte): ranges of bounded size; only a long document is cut, at a line end, or at white space where it has none."""
    for first, last in pieces(offsets):
        at, hi = int(offsets[first]), int(offsets[last])
        while at < hi:
            to = min(hi, at + PIECE_BYTES)
            if to < hi:
                back = np.flatnonzero(raw[at:to] == 10)  # no sentence goes over a line end
                back = back if len(back) else np.flatnonzero(WHITE[raw[at:to]])
                if len(back):
                    to = at + int(back[-1]) + 1
                else:
                    more = np.flatnonzero(WHITE[raw[to:hi]])
                    to = to + int(more[0]) + 1 if len(more) else hi
            yield first, last, at, to
            at = to


def words(raw: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, count): of each word its hash and byte range in ``raw``, and the words of each document."""
    table = _LOWER_BYTE if lower else _BYTE
    got, begins, stops, counts = [], [], [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for first, last, at, to in parts(raw, offsets):
        part, cuts = raw[at:to], offsets[first:last] - at
        s, e = _word_bounds(part, cuts[cuts >= 0])
        got.append(_span_hashes(part, s, e, table))
        begins.append(s + at)
        stops.append(e + at)
        where = np.searchsorted(offsets[first : last + 1], s + at, side="right") - 1
        counts[first:last] += np.bincount(where, minlength=last - first)
    if not got:
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=U64), none, none, counts
    return np.concatenate(got), np.concatenate(begins), np.concatenate(stops), counts


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words, one for each place where a window fits into ``hashes``."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= U64(0xC2B2AE3D27D4EB4F)
        out += hashes[k : k + n]
    return mix(out)


class Prefix:
    """Hashes of any byte ranges of one part: cumulative sums of a polynomial modulo 2**64."""

    def __init__(self, raw: np.ndarray):
        self.total = np.zeros(len(raw) + 1, dtype=U64)
        value = _BYTE[raw]
        value *= _power("up", _BASE, len(raw))
        np.cumsum(value, out=self.total[1:])
        self.down = _power("down", _BASE_INV, len(raw) + 1)

    def buckets(self, start: np.ndarray, size, bits: int, salt: int) -> np.ndarray:
        """The range from ``start`` of ``size`` bytes, hashed to ``bits`` bits."""
        x = (self.total[start + size] - self.total[start]) * self.down[start]
        x ^= x >> U64(32)
        x += U64(salt)
        x *= U64(0x9E3779B97F4A7C15)
        return (x >> U64(64 - bits)).astype(np.int64)


def word_bounds(part: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _word_bounds(part, cuts[cuts >= 0])


def lowered(raw: np.ndarray) -> np.ndarray:
    """A copy with A-Z, and the two-byte letters U+00C0 to U+00DE, in lower case."""
    out = raw.copy()
    out[(raw >= 65) & (raw <= 90)] += 32
    after = np.zeros(len(raw), bool)
    after[1:] = raw[:-1] == 0xC3
    out[after & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)] += 32
    return out


def stretches(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of the word sequences [first, last) of ``hashes``, equal for equal sequences of words."""
    total = np.zeros(len(hashes) + 1, dtype=U64)
    np.cumsum(hashes * _power("up", _BASE, len(hashes)), out=total[1:])
    return mix((total[last] - total[first]) * _power("down", _BASE_INV, len(hashes) + 1)[first] + (last - first).astype(U64))
