"""Which parts of a page are read by character recognition: its bitmaps, grown and merged, if they cover enough of it.

Bitmaps (page, l, t, r, b) are painted one by one on a raster of the page's size, one bit a point; rows that are equal to the one before are
one row then. A task holds the raster of one page, however many bitmaps or pages there are. What touches on the grown raster, edge to
edge, is one region.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.plans.options import OcrOptions

# A bitmap grows by the square of 20 points whose centre is its point 10; above the second part all of the page is read.
GROW_BEFORE, GROW_AFTER, WHOLE = 10, 9, 0.75
#: Points in a word of bits.
WORD = 64


def grown(bitmaps: DataFrame, sizes: DataFrame) -> DataFrame:
    """(page, x0, x1, y0, y1): the grown bitmaps of each page, each once. A bitmap's edges are rounded (halves to even) and belong to
    it; what lies outside the page is cut off before it grows. Boxes with a null edge, or turned inside out, are none."""
    at = lambda c: F.bround(c, 0).cast("long")
    boxes = bitmaps.join(sizes.select("page", at("width").alias("w"), at("height").alias("h")), "page").select("page", "w", "h", *(at(x).alias(x) for x in "ltrb"))
    seen = boxes.where("l <= r AND t <= b AND r >= 0 AND b >= 0 AND l < w AND t < h")
    low = lambda x: F.greatest(F.greatest(x, F.lit(0)) - GROW_BEFORE, F.lit(0))
    high = lambda x, size: F.least(F.least(x, F.col(size) - 1) + GROW_AFTER, F.col(size) - 1)
    return seen.select("page", low("l").alias("x0"), high("r", "w").alias("x1"), low("t").alias("y0"), high("b", "h").alias("y1")).distinct()


class Raster:
    """A page of one bit a point."""

    def __init__(self, width: int, height: int):
        self.bits = np.zeros((max(1, height), max(1, -(-width // WORD))), np.uint64)

    def paint(self, x0: int, x1: int, y0: int, y1: int) -> None:
        a, z = x0 // WORD, x1 // WORD
        for w in range(a, z + 1):
            first, last = max(x0 - w * WORD, 0), min(x1 - w * WORD, WORD - 1)
            self.bits[y0 : y1 + 1, w] |= np.uint64((2 << last) - (1 << first))

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows that differ from the one before, as points, and the heights at which they begin, with the page's end."""
        begin = np.flatnonzero(np.concatenate([[True], (self.bits[1:] != self.bits[:-1]).any(1)]))
        spread = np.unpackbits(self.bits[begin].astype("<u8").view(np.uint8), axis=1, bitorder="little")
        return spread.astype(bool), np.append(begin, len(self.bits))


def parts(raster: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(l, t, r, b) of what hangs together edge to edge: runs of each row, united with the runs of the row before that they touch."""
    edge = np.diff(np.pad(raster.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    y, x0 = np.nonzero(edge == 1)
    x1 = np.nonzero(edge == -1)[1] - 1
    up = list(range(len(y)))

    def top(k: int) -> int:
        while up[k] != k:
            up[k] = k = up[up[k]]
        return k

    first = np.searchsorted(y, np.arange(len(raster) + 1)).tolist()
    a, z = x0.tolist(), x1.tolist()
    for row in range(1, len(raster)):
        i, j = first[row - 1], first[row]
        while i < first[row] and j < first[row + 1]:
            if a[i] <= z[j] and a[j] <= z[i]:
                p, q = top(i), top(j)
                up[max(p, q)] = min(p, q)
            if z[i] < z[j]:
                i += 1
            else:
                j += 1
    of = np.array([top(k) for k in range(len(y))], np.int64)
    out = []
    for k in np.unique(of).tolist():
        own = of == k
        out.append((int(x0[own].min()), int(y[own].min()), int(x1[own].max()), int(y[own].max())))
    return sorted(out, key=lambda r: (r[1], r[0], r[3], r[2]))


def ocr_regions(bitmaps: DataFrame, sizes: DataFrame, options: OcrOptions = OcrOptions()) -> DataFrame:
    """(page, part, decision, l, t, r, b) of every page of ``sizes`` (page, width, height): 'page' with the whole page where its grown
    bitmaps cover more than WHOLE of it (or if all pages are to be read), 'regions' with one row for each of them above the least
    part, else 'skip' without a box."""
    pages = sizes.select("page", F.col("width").cast("double").alias("width"), F.col("height").cast("double").alias("height"), F.monotonically_increasing_id().alias("k"))
    rows = pages.join(grown(bitmaps, sizes), "page", "left").select("k", "page", "width", "height", "x0", "x1", "y0", "y1")  # the boxes of a page follow one another
    enough, whole = options.bitmap_area_threshold, max(WHOLE, options.bitmap_area_threshold)
    names = ["page", "part", "decision", *"ltrb"]

    def decided(page, width, height, raster):
        spread, begin = raster.rows()
        points = float((spread.sum(1) * np.diff(begin)).sum())
        part = points / (width * height) if width * height > 0 else 0.0
        if options.force_full_page_ocr or part > whole:
            return [(page, part, "page", 0.0, 0.0, width, height)]
        if part > enough:
            return [(page, part, "regions", float(l), float(begin[t]), float(r), float(begin[b + 1] - 1)) for l, t, r, b in parts(spread)]
        return [(page, part, "skip", None, None, None, None)]

    def run(batches):
        now, raster = None, None
        for batch in itertools.chain(batches, [None]):
            out: list[tuple] = []
            for k, page, width, height, *box in [(None,) * 8] if batch is None else zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or k != now[0]:
                    if now is not None:
                        out += decided(*now[1:], raster)
                    now, raster = (k, page, width, height), None if batch is None else Raster(round(width), round(height))
                if box[0] is not None:
                    raster.paint(*box)
            kinds = (pa.int64(), pa.float64(), pa.string(), *[pa.float64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

    return rows.mapInArrow(run, "page long, part double, decision string, l double, t double, r double, b double")


def ocr_regions_sql(fixtures: str, options: OcrOptions = OcrOptions()) -> str:
    """ocr_regions() over CTEs bitmaps and sizes: boxes that touch, by reachability; covered points, by the runs of each row."""
    grown = f"greatest(greatest(round_even(l, 0), 0) - {GROW_BEFORE}, 0)::BIGINT AS x0, least(least(round_even(r, 0), w - 1) + {GROW_AFTER}, w - 1)::BIGINT AS x1, greatest(greatest(round_even(t, 0), 0) - {GROW_BEFORE}, 0)::BIGINT AS y0, least(least(round_even(b, 0), h - 1) + {GROW_AFTER}, h - 1)::BIGINT AS y1"
    touch = "((p.x0 <= q.x1 AND q.x0 <= p.x1 AND p.y0 <= q.y1 + 1 AND q.y0 <= p.y1 + 1) OR (p.x0 <= q.x1 + 1 AND q.x0 <= p.x1 + 1 AND p.y0 <= q.y1 AND q.y0 <= p.y1))"
    whole = max(WHOLE, options.bitmap_area_threshold)
    return f"""WITH RECURSIVE {fixtures},
boxes AS (SELECT page, row_number() OVER (PARTITION BY page ORDER BY x0, x1, y0, y1) AS k, x0, x1, y0, y1 FROM (SELECT DISTINCT page, {grown} FROM bitmaps JOIN (SELECT page, round_even(width, 0) AS w, round_even(height, 0) AS h FROM sizes) USING (page)
  WHERE round_even(l, 0) <= round_even(r, 0) AND round_even(t, 0) <= round_even(b, 0) AND round_even(r, 0) >= 0 AND round_even(b, 0) >= 0 AND round_even(l, 0) < w AND round_even(t, 0) < h)),
ways AS (SELECT p.page, p.k AS x, q.k AS y FROM boxes p JOIN boxes q ON p.page = q.page AND p.k <> q.k AND {touch}),
reach AS (SELECT page, k AS x, k AS y FROM boxes UNION SELECT r.page, r.x, w.y FROM reach r JOIN ways w ON w.page = r.page AND w.x = r.y),
named AS (SELECT page, x AS k, min(y) AS grp FROM reach GROUP BY page, x),
merged AS (SELECT page, min(x0)::DOUBLE AS l, min(y0)::DOUBLE AS t, max(x1)::DOUBLE AS r, max(y1)::DOUBLE AS b FROM boxes JOIN named USING (page, k) GROUP BY page, grp),
runs AS (SELECT page, x0, x1, unnest(range(y0, y1 + 1)) AS y FROM boxes),
fresh AS (SELECT page, greatest(0, x1 - greatest(x0 - 1, coalesce(max(x1) OVER (PARTITION BY page, y ORDER BY x0, x1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1))) AS n FROM runs),
covered AS (SELECT s.page, width, height, coalesce(sum(n), 0)::DOUBLE / (width * height) AS part FROM sizes s LEFT JOIN fresh f ON f.page = s.page GROUP BY s.page, width, height)
SELECT page, part, 'page' AS decision, 0.0::DOUBLE AS l, 0.0::DOUBLE AS t, width::DOUBLE AS r, height::DOUBLE AS b FROM covered WHERE part > {whole}
UNION ALL SELECT c.page, part, 'regions', l, t, r, b FROM covered c JOIN merged USING (page) WHERE part > {options.bitmap_area_threshold} AND part <= {whole}
UNION ALL SELECT page, part, 'skip', NULL, NULL, NULL, NULL FROM covered WHERE part <= {options.bitmap_area_threshold}"""
