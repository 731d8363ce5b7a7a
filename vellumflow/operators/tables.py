"""Tables out of words: which rows and columns a table has, by the gaps between its words, and which of them each cell spans.

Stands in for a model of table structure: where there is a plug-in for one, its cells take the place of these. Words are cells (page, idx, text, l,
t, r, b), tables clusters (page, cid, l, t, r, b).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.functions.geometry import Box
from vellumflow.operators.layout import CELL_OVERLAP, area_sql, assign_sql, shared_sql

#: The part of a word that has to lie in a table; of a line's height that may overlap the next; what is too wide or tall to tell columns or rows.
IN_TABLE, OVERLAP, WIDE, TALL = 0.8, 0.2, 1 / 3, 1.5


def words_of(words: DataFrame, tables: DataFrame) -> DataFrame:
    """(page, table, idx, text, l, t, r, b, w) with w the table's width: the words that are not blank and lie in a table with most of their
    area; in a table that has none, the cells that the layout gives it (those that it covers more of than any other table)."""
    t = tables.select("page", F.col("cid").alias("table"), (F.col("r") - F.col("l")).alias("w"), *(F.col(x).alias(f"t_{x}") for x in "ltrb"))
    pairs = words.where(F.trim("text") != "").join(t, "page").where(Box.of().overlaps(Box.of("t_"))).withColumn("part", Box.of().inside(Box.of("t_"))).where(F.col("part") > CELL_OVERLAP)
    first = F.row_number().over(Window.partitionBy("page", "idx").orderBy(-F.round("part", 9), "table")) == 1
    full = F.max(F.col("part") > IN_TABLE).over(Window.partitionBy("page", "table"))
    found = pairs.withColumn("best", first).withColumn("full", full).where((F.col("part") > IN_TABLE) | (~F.col("full") & F.col("best")))
    return found.select("page", "table", "idx", "text", *"ltrb", "w")


def words_of_sql(words: str, tables: str, out: str) -> str:
    return f"""{out}_inside AS (SELECT c.page, k.cid AS "table", c.idx, c.text, c.l, c.t, c.r, c.b, k.r - k.l AS w FROM {words} c JOIN {tables} k ON k.page = c.page WHERE trim(c.text) <> '' AND {area_sql('c')} > 0 AND {shared_sql('c', 'k')} / {area_sql('c')} > {IN_TABLE}),
{assign_sql(tables, f'{out}_given').replace('cells c', f'{words} c')},
{out} AS (SELECT * FROM {out}_inside UNION ALL SELECT c.page, k.cid, c.idx, c.text, c.l, c.t, c.r, c.b, k.r - k.l FROM {out}_given g JOIN {words} c ON c.page = g.page AND c.idx = g.idx JOIN {tables} k ON k.page = g.page AND k.cid = g.cid
  WHERE NOT EXISTS (SELECT 1 FROM {out}_inside i WHERE i.page = k.page AND i."table" = k.cid))"""


def bands(intervals: Column) -> Column:
    """What an array of (lo, hi) covers, as an array of the same: an interval that begins beyond all before it begins a band."""

    def add(found: Column, x: Column) -> Column:
        last = F.element_at(found, -1)
        grown = F.concat(F.slice(found, F.lit(1), F.size(found) - 1), F.array(F.named_struct(F.lit("lo"), last["lo"], F.lit("hi"), F.greatest(last["hi"], x["hi"]))))
        return F.when((F.size(found) > 0) & (F.try_element_at(found, F.lit(-1))["hi"] > x["lo"]), grown).otherwise(F.concat(found, F.array(x)))

    return F.aggregate(F.array_sort(intervals), F.array().cast("array<struct<lo:double,hi:double>>"), add)


def bands_sql(words: str, low: str, high: str, band: str, out: str) -> str:
    return f"""{out} AS (SELECT page, "table", {band}, min({low}) AS lo, max({high}) AS hi FROM (SELECT *, sum(new) OVER (PARTITION BY page, "table" ORDER BY {low}, {high}, idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS {band} FROM (
  SELECT *, CASE WHEN {low} < max({high}) OVER (PARTITION BY page, "table" ORDER BY {low}, {high}, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM {words})) GROUP BY page, "table", {band})"""


def _crossed(found: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """How many of the bands end before (low, high), and the last that begins before its end: if it overlaps any, its first and last."""
    return F.size(F.filter(found, lambda x: x["hi"] <= low)), F.size(F.filter(found, lambda x: x["lo"] < high)) - 1


def _spanned(first: str, last: str) -> tuple[Column, Column]:
    """The first and last of the bands that a word overlaps, from _crossed(); where it overlaps none, the last band before it, else the first."""
    alone = F.greatest(F.col(first) - 1, F.lit(0))
    return F.when(F.col(last) < F.col(first), alone).otherwise(F.col(first)).alias(first), F.when(F.col(last) < F.col(first), alone).otherwise(F.col(last)).alias(last)


def _crossed_sql(words: str, band: str, low: str, high: str, number: str, first: str, last: str, out: str) -> str:
    on = f"b.lo < w.{high} AND b.hi > w.{low}"
    return f"""{out} AS (SELECT w.*, coalesce(min(b.{number}) FILTER ({on}), max(b.{number}) FILTER (b.hi <= w.{low}), 0)::INTEGER AS {first}, coalesce(max(b.{number}) FILTER ({on}), max(b.{number}) FILTER (b.hi <= w.{low}), 0)::INTEGER AS {last}
  FROM {words} w LEFT JOIN {band} b ON b.page = w.page AND b."table" = w."table" GROUP BY ALL)"""


def table_cells(words: DataFrame, tables: DataFrame) -> DataFrame:
    """(page, table, r0, r1, c0, c1, text): cells of tables with the rows and columns (from 0, the last included) that they span.

    Rows are told by words of ordinary height (up to TALL times the table's median), whose lines may overlap a little; columns by words that
    are not wide (up to WIDE of the table). Words that span the same bands are one cell, joined by spaces from the top left on."""
    height = F.col("b") - F.col("t")
    word = F.struct("idx", F.trim("text").alias("x"), *(F.col(c).cast("double").alias(c) for c in "ltrb"), (F.col("t") + OVERLAP * height).alias("u"), (F.col("b") - OVERLAP * height).alias("v"))
    held = words_of(words, tables).groupBy("page", "table").agg(F.collect_list(word).alias("words"), F.first("w").alias("w"), F.median(height).alias("height"))
    between = lambda keep, low, high: bands(F.transform(F.filter("words", keep), lambda x: F.named_struct(F.lit("lo"), x[low], F.lit("hi"), x[high])))
    rows = between(lambda x: x["b"] - x["t"] <= TALL * F.col("height"), "u", "v")
    columns = between(lambda x: x["r"] - x["l"] <= WIDE * F.col("w"), "l", "r")
    told = held.select("page", "table", "words", rows.alias("rows"), columns.alias("columns")).select("page", "table", "rows", "columns", F.explode("words").alias("word"))
    names = ("r0", "r1", "c0", "c1")
    crossed = (*_crossed(F.col("rows"), F.col("word.u"), F.col("word.v")), *_crossed(F.col("columns"), F.col("word.l"), F.col("word.r")))
    placed = told.select("page", "table", "word", *(c.alias(n) for c, n in zip(crossed, names))).select("page", "table", "word", *_spanned("r0", "r1"), *_spanned("c0", "c1"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word.t", "word.l", "word.idx", "word.x"))), lambda x: x["x"]), " ")
    return placed.groupBy("page", "table", *names).agg(said.alias("text"))


def table_cells_sql(words: str, tables: str, out: str) -> str:
    return f"""{words_of_sql(words, tables, f'{out}_words')},
{out}_found AS (SELECT *, t + {OVERLAP} * (b - t) AS u, b - {OVERLAP} * (b - t) AS v, median(b - t) OVER (PARTITION BY page, "table") AS height FROM {out}_words),
{out}_lines AS (SELECT * FROM {out}_found WHERE b - t <= {TALL} * height), {out}_narrow AS (SELECT * FROM {out}_found WHERE r - l <= {WIDE} * w),
{bands_sql(f'{out}_lines', 'u', 'v', 'row_no', f'{out}_rows')},
{bands_sql(f'{out}_narrow', 'l', 'r', 'col_no', f'{out}_columns')},
{_crossed_sql(f'{out}_found', f'{out}_rows', 'u', 'v', 'row_no', 'r0', 'r1', f'{out}_in_rows')},
{_crossed_sql(f'{out}_in_rows', f'{out}_columns', 'l', 'r', 'col_no', 'c0', 'c1', f'{out}_placed')},
{out} AS (SELECT page, "table", r0, r1, c0, c1, string_agg(trim(text), ' ' ORDER BY t, l, idx) AS text FROM {out}_placed GROUP BY page, "table", r0, r1, c0, c1)"""


def assembled(elements: DataFrame, cells: DataFrame) -> DataFrame:
    """(page, cid, kind, n_rows, n_cols, n_cells) of page elements: a table with the shape of its cells, one that has none as an empty
    table; pictures, containers and texts by their label. ``cells``: as table_cells() or a plug-in gives them."""
    shape = cells.groupBy("page", F.col("table").alias("cid")).agg((F.max("r1") + 1).alias("n_rows"), (F.max("c1") + 1).alias("n_cols"), F.count("*").alias("n_cells"))
    kind = F.when(F.col("label").isin("table", "document_index"), "table").when(F.col("label") == "picture", "figure").when(F.col("label").isin("form", "key_value_region"), "container").otherwise("text")
    found = elements.withColumn("kind", kind).join(shape, ["page", "cid"], "left")
    of = lambda c, kind: F.when(F.col("kind") == "table", F.coalesce(c, F.lit(0).cast(kind))).alias(c)
    return found.select("page", "cid", "kind", of("n_rows", "int"), of("n_cols", "int"), of("n_cells", "long"))
