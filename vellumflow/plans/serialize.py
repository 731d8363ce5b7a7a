"""Items to Markdown, text, outline, tagged text, JSON and HTML."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.sources.tree import pipe_table

#: Labels whose own text is not written: their children's is.
HOLDERS = ("inline", "list", "section", "chapter")


def table_markdown(cells: str | Column) -> Column:
    """Pipe tables: columns as wide as their widest cell and their header with two spaces, numbers to the right."""
    return F.pandas_udf(_tables, "string")(cells)


def _tables(cells: pd.Series) -> pd.Series:
    return cells.map(_table)


def _table(cells) -> str | None:
    return None if cells is None or not len(cells) else pipe_table(_grid(cells))


def styled(text: Column, style: Column, link: Column, label: Column) -> Column:
    """A text with its marks of style and its link; code is not escaped."""
    out = F.when(label.isin("code", "formula"), text).otherwise(F.regexp_replace(escaped(text), r"(?<!\\)_", r"\\_"))
    for name, mark in (("strikethrough", "~~"), ("italic", "*"), ("bold", "**")):
        out = F.when(F.coalesce(style, F.lit("")).contains(name), F.concat(F.lit(mark), out, F.lit(mark))).otherwise(out)
    return F.when(link.isNotNull() & (F.length(link) > 0) & ~label.isin("picture"), F.concat(F.lit("["), out, F.lit("]("), link, F.lit(")"))).otherwise(out)


def of_layers(items: DataFrame, layers: tuple[str, ...]) -> DataFrame:
    """The items of these layers, without rows that stand for an error."""
    live = items.where(F.col("layer").isin(*layers))
    return live.where(F.col("error").isNull()) if "error" in items.columns else live


def blocks(items: DataFrame, key: str = "doc_id", layers: tuple[str, ...] = ("body",)) -> DataFrame:
    """(key, ord, place, label, depth, list, block): the Markdown of each block; inline runs are put into the block they belong to, and
    ``list`` numbers the outermost lists."""
    live = of_layers(items, layers)
    said = live.withColumn("said", styled(F.col("text"), F.col("style"), F.col("link"), F.col("label")))
    up = live.select(F.col(key).alias("k"), F.col("ord").alias("p"), F.col("label").alias("p_label"), F.coalesce("text", F.lit("")).alias("p_text"))
    joined = said.join(up, (F.col(key) == F.col("k")) & (F.col("parent") == F.col("p")), "left")
    inner = F.when(F.col("label") == "code", F.concat(F.lit("`"), "said", F.lit("`"))).otherwise(F.col("said"))
    runs = joined.where(F.col("p_label") == "inline").groupBy(key, F.col("parent").alias("ord")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", inner.alias("t")))), lambda x: x["t"]), " ").alias("run"))
    own = joined.where((F.col("p_label") != "inline") | F.col("p_label").isNull()).drop("k").withColumnRenamed("p", "over")
    own = own.join(runs, [key, "ord"], "left")
    # the first inline group below a title, heading or list item without a text of its own is its text
    leads = (F.col("label") == "inline") & F.coalesce(F.col("p_label").isin("title", "section_header", "list_item") & (F.col("p_text") == ""), F.lit(False))
    led = own.where(leads).groupBy(key, F.col("parent").alias("ord")).agg(F.min_by("run", "ord").alias("led"))
    own = own.where(~leads).join(led, [key, "ord"], "left")
    text = F.when(F.length("said") > 0, F.col("said")).otherwise(F.coalesce("led", "said", F.lit("")))
    indent = F.repeat(F.lit("    "), F.coalesce(F.col("level"), F.lit(1)) - 1)
    first = F.when((F.col("label") == "list") & (F.coalesce("level", F.lit(1)) == 1), 1).otherwise(0)
    own = own.withColumn("run", F.when(F.col("label") == "list_item", F.lit(None).cast("string")).otherwise(F.col("run"))).withColumn("list", F.sum(first).over(Window.partitionBy(key).orderBy("ord")))
    block = (
        F.when(F.col("label") == "title", F.concat(F.lit("# "), text)).when(F.col("label") == "section_header", F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(1)) + 1), F.lit(" "), text))
        .when(F.col("label") == "list_item", F.concat(indent, F.when(F.coalesce("enumerated", F.lit(False)), F.concat("marker", F.lit(" "))).otherwise(F.lit("- ")), text))
        .when(F.col("label") == "code", F.concat(F.lit("```\n"), "text", F.lit("\n```")))
        .when(F.col("label") == "formula", F.concat(F.lit("$$"), "text", F.lit("$$"))).when(F.col("label") == "picture", F.lit("<!-- image -->")).when(F.col("label") == "table", table_markdown("cells"))
        .when(F.col("label") == "inline", F.col("run")).when(F.col("label").isin(*HOLDERS), F.lit(None).cast("string")).otherwise(text)
    )
    place = F.when((F.col("label") == "caption") & F.col("p_label").isin("picture", "table"), F.col("over") - 0.5).otherwise(F.col("ord"))  # a caption stands before what it is of
    return own.select(key, "ord", place.cast("double").alias("place"), "label", "depth", "list", block.alias("block")).where(F.length("block") > 0)


def markdown(items: DataFrame, key: str = "doc_id", layers: tuple[str, ...] = ("body",)) -> DataFrame:
    """(key, markdown): blocks in order, a blank line between them, but not between the items of one list and the lists in it."""
    b = blocks(items, key, layers)
    ordered = F.array_sort(F.collect_list(F.struct("place", "ord", "label", "list", "block")))
    listed = lambda last, x: (last["label"] == "list_item") & (x["label"] == "list_item") & (last["list"] == x["list"])
    rows = b.groupBy(key).agg(ordered.alias("rows"))
    before = F.concat(F.array(F.lit(None).cast(rows.schema["rows"].dataType.elementType)), F.slice("rows", F.lit(1), F.size("rows") - 1))
    joined = F.zip_with("rows", before, lambda x, last: F.concat(F.when(last.isNull(), "").when(listed(last, x), "\n").otherwise("\n\n"), x["block"]))
    return rows.select(key, F.array_join(joined, "").alias("markdown"))


def outline(items: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, outline): a line for each item, indented by its depth."""
    line = F.concat(F.repeat(F.lit("  "), F.col("depth")), F.lit("item-"), F.col("ord").cast("string"), F.lit(" at level "), F.col("depth").cast("string"), F.lit(": "), "label", F.when(F.length("text") > 0, F.concat(F.lit(": "), "text")).otherwise(""))
    return items.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n").alias("outline"))


def tagged(items: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, tagged): each text between tags of its label."""
    line = F.concat(F.lit("<"), "label", F.lit(">"), F.coalesce("text", F.lit("")), F.lit("</"), "label", F.lit(">"))
    return of_layers(items, ("body",)).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))), lambda x: x["l"]), "\n").alias("tagged"))


def as_json(items: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, json): all items of a document, none of their fields lost."""
    fields = [c for c in items.columns if c not in (key, "error", "ord")]
    return items.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct("ord", *fields)))).alias("json"))


def table_html(cells: str | Column) -> Column:
    """A table element with a row for each row of cells, spans as attributes, header cells as th; built-in functions only."""
    cells = F.col(cells) if isinstance(cells, str) else cells
    span = lambda a, b, name: F.when(b - a > 1, F.concat(F.lit(f' {name}="'), (b - a).cast("string"), F.lit('"'))).otherwise("")
    tag = lambda c: F.when(c["column_header"] | c["row_header"], "th").otherwise("td")
    one = lambda c: F.concat(F.lit("<"), tag(c), span(c["r0"], c["r1"], "rowspan"), span(c["c0"], c["c1"], "colspan"), F.lit(">"), escaped(c["text"]), F.lit("</"), tag(c), F.lit(">"))
    order = F.array_sort(cells, lambda a, b: F.when((a["r0"] < b["r0"]) | ((a["r0"] == b["r0"]) & (a["c0"] < b["c0"])), -1).otherwise(1))
    first = F.transform(order, lambda c, k: F.when(k == 0, "<tr>").when(F.get(order, k - 1)["r0"] < c["r0"], "</tr><tr>").otherwise(""))
    return F.concat(F.lit("<table>"), F.array_join(F.zip_with(order, first, lambda c, f: F.concat(f, one(c))), ""), F.when(F.size(cells) > 0, "</tr>").otherwise(""), F.lit("</table>"))


def table_csv(cells: str | Column) -> Column:
    """The rectangular table as separated values; fields that hold a comma, a quote or a line end are quoted. A cell that spans
    several places stands in each of them."""
    return F.pandas_udf(_separated, "string")(cells)


def _separated(cells: pd.Series) -> pd.Series:
    def one(cells):
        if cells is None or not len(cells):
            return None
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(_grid(cells))
        return out.getvalue()

    return cells.map(one)


def _grid(cells) -> list[list[str]]:
    grid = [[""] * max(c["c1"] for c in cells) for _ in range(max(c["r1"] for c in cells))]
    for c in cells:
        for r in range(c["r0"], c["r1"]):
            for k in range(c["c0"], c["c1"]):
                grid[r][k] = c["text"] or ""
    return grid


def plain(items: DataFrame, key: str = "doc_id", layers: tuple[str, ...] = ("body",)) -> DataFrame:
    """(key, text): the texts of a document without marks, a blank line between them; tables as their cells, row by row."""
    live = of_layers(items, layers).where(~F.col("label").isin(*HOLDERS))
    cells = F.array_join(F.transform("cells", lambda c: F.coalesce(c["text"], F.lit(""))), " ")
    said = F.coalesce(F.nullif("text", F.lit("")), cells)
    return live.where(F.length(said) > 0).groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", said.alias("t")))), lambda x: x["t"]), "\n\n").alias("text"))


def escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def as_html(items: DataFrame, key: str = "doc_id", split_pages: bool = False) -> DataFrame:
    """(key, html): headings, paragraphs, list entries, code, tables and pictures as elements; with ``split_pages`` a section
    for each page."""
    safe = escaped(F.col("text"))
    tag = F.when(F.col("label") == "title", "h1").when(F.col("label") == "section_header", F.concat(F.lit("h"), (F.coalesce("level", F.lit(1)) + 1).cast("string"))).when(F.col("label") == "list_item", "li").when(F.col("label") == "code", "pre").otherwise("p")
    whole = F.col("label").isin("table", "picture")
    live = of_layers(items, ("body",)).where(((F.length("text") > 0) | whole) & ~F.col("label").isin(*HOLDERS))
    plain_element = F.concat(F.lit("<"), tag, F.lit(">"), safe, F.lit("</"), tag, F.lit(">"))
    element = F.when(F.col("label") == "table", F.coalesce(table_html("cells"), F.lit("<table></table>"))).when(F.col("label") == "picture", F.concat(F.lit("<figure>"), safe, F.lit("</figure>"))).otherwise(plain_element)
    row = F.struct(F.coalesce("page", F.lit(1)).alias("page"), "ord", element.alias("l"))
    if not split_pages:
        return live.groupBy(key).agg(F.concat(F.lit("<body>"), F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["l"]), "\n"), F.lit("</body>")).alias("html"))
    page = live.groupBy(key, F.coalesce("page", F.lit(1)).alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["l"]), "\n").alias("b"))
    return page.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "b"))), lambda x: F.concat(F.lit("<section>"), x["b"], F.lit("</section>"))), "\n").alias("html"))
