"""Boxes that meet on a page, for pages of any number of boxes: a page is cut into tiles, as many as it has boxes for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellumflow.functions.geometry import Box

#: Boxes that a tile is to have about, and tiles of a page in each direction at most.
PER_TILE, MOST_TILES = 256, 64


def tiled(boxes: DataFrame, pages: DataFrame, prefix: str = "") -> DataFrame:
    """``boxes`` once for each tile (tx, ty) of their page that they touch."""

    def span(low: str, high: str, start: str, size: str) -> Column:
        place = lambda c: F.least(F.floor((F.col(f"{prefix}{c}") - F.col(start)) / F.col(size)), F.col("__tiles") - 1)
        return F.sequence(place(low), place(high))

    rows = boxes.join(pages, "page").withColumn("tx", F.explode(span("l", "r", "__l", "__w"))).withColumn("ty", F.explode(span("t", "b", "__t", "__h")))
    return rows


def meeting(left: DataFrame, right: DataFrame, prefix: str = "p_", closed: bool = False) -> DataFrame:
    """The pairs of rows of ``left`` (page, l, t, r, b, ...) and ``right`` (page, and its box with ``prefix``) whose boxes overlap, or with
    ``closed`` touch; each once, in the tile that holds the top left corner of what they share. A page of few boxes is one tile; a
    box is in as many tiles as it covers of its page's. Boxes with a null edge, or turned inside out, meet nothing."""
    sound = lambda df, p: df.where((F.col(f"{p}l") <= F.col(f"{p}r")) & (F.col(f"{p}t") <= F.col(f"{p}b")))
    left, right = sound(left, ""), sound(right, prefix)
    both = left.select("page", *"ltrb").unionByName(right.select("page", *(F.col(f"{prefix}{x}").alias(x) for x in "ltrb")))
    tiles = F.greatest(F.lit(1), F.least(F.lit(MOST_TILES), F.floor(F.sqrt(F.count("*") / PER_TILE)))).cast("long")
    size = lambda low, high: F.greatest((F.max(high) - F.min(low)) / tiles, F.lit(1e-9))
    pages = both.groupBy("page").agg(tiles.alias("__tiles"), F.min("l").alias("__l"), F.min("t").alias("__t"), size("l", "r").alias("__w"), size("t", "b").alias("__h"))
    a, b = Box.of(), Box.of(prefix)
    own = tiled(left, pages)
    other = tiled(right, pages, prefix).drop("__tiles", "__l", "__t", "__w", "__h")
    hits = own.join(other, ["page", "tx", "ty"]).where(a.touches(b) if closed else a.overlaps(b))
    corner = lambda x, start, step: F.least(F.floor((F.greatest(x, f"{prefix}{x}") - F.col(start)) / F.col(step)), F.col("__tiles") - 1)
    once = hits.where((F.col("tx") == corner("l", "__l", "__w")) & (F.col("ty") == corner("t", "__t", "__h")))
    return once.drop("tx", "ty", "__tiles", "__l", "__t", "__w", "__h")
