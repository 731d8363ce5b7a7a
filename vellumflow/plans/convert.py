"""The public face: convert files or text columns, with limits, statuses and exports."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow import scratch
from vellumflow.plans import serialize
from vellumflow.plans.options import PipelineOptions
from vellumflow.plans.plugins import Registry, enrich
from vellumflow.sources import archives, reader
from vellumflow.sources.tree import ITEM_FIELDS


class BaseError(RuntimeError):
    """Anything this library raises on purpose."""


class ConversionError(BaseError):
    """A document could not be converted and errors were to be raised."""


class OperationNotAllowed(BaseError):
    """Something remote was asked for and remote services are off."""


@dataclass(frozen=True)
class Limits:
    """Bounds of what is converted; page ranges count from 1 and include both ends."""

    max_num_pages: int | None = None
    max_file_size: int | None = None
    page_range: tuple[int, int] = (1, 2**31 - 1)

    def __post_init__(self):
        if self.page_range[0] < 1 or self.page_range[1] < self.page_range[0]:
            raise ValueError("a page range begins at 1 or later and does not end before it begins")


@dataclass(frozen=True)
class Result:
    """Documents with their statuses, and the items of those that were converted."""

    documents: DataFrame
    items: DataFrame

    def markdown(self) -> DataFrame:
        return serialize.markdown(self.items)

    def json(self) -> DataFrame:
        return serialize.as_json(self.items)

    def html(self, split_pages: bool = False) -> DataFrame:
        return serialize.as_html(self.items, split_pages=split_pages)

    def text(self) -> DataFrame:
        return serialize.plain(self.items)

    def doctags(self) -> DataFrame:
        return serialize.tagged(self.items)

    def outline(self) -> DataFrame:
        return serialize.outline(self.items)

    def tables(self) -> DataFrame:
        """(doc_id, ord, markdown, html, csv) of every table."""
        made = (serialize.table_markdown("cells").alias("markdown"), serialize.table_html("cells").alias("html"), serialize.table_csv("cells").alias("csv"))
        return self.items.where("label = 'table'").select("doc_id", "ord", *made)

    def save(self, path: str) -> None:
        self.documents.drop("content").write.mode("overwrite").parquet(f"{path}/documents")
        self.items.write.mode("overwrite").parquet(f"{path}/items")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Result:
        return Result(spark.read.parquet(f"{path}/documents"), spark.read.parquet(f"{path}/items"))

    def save_archives(self, path: str, overwrite: bool = False) -> None:
        """One zip archive for each document, <doc_id>.zip, with JSON members: version, status, errors, pages, document. A failed
        task leaves nothing in the folder."""
        archives.register(self.documents.sparkSession)
        pages = self.items.where("page IS NOT NULL").groupBy("doc_id").agg(F.to_json(F.array_sort(F.collect_set("page"))).alias("pages"))
        status = F.to_json(F.struct("status", "file", "format", "filesize"))
        docs = self.documents.where("doc_id IS NOT NULL").select("doc_id", F.lit(json.dumps({"archive": 1})).alias("version"), status.alias("status"), F.to_json(F.array_compact(F.array("error"))).alias("errors"))
        rows = docs.join(pages, "doc_id", "left").join(self.json().withColumnRenamed("json", "document"), "doc_id", "left")
        rows.write.format("conversion_archives").mode("overwrite" if overwrite else "append").save(path)

    @staticmethod
    def load_archives(spark: SparkSession, path: str) -> Result:
        """What save_archives() wrote; members that are missing leave their columns null, and documents without items have none."""
        archives.register(spark)
        found = scratch.save(spark.read.format("conversion_archives").load(path), "archives")
        status = F.from_json("status", "status string, file string, format string, filesize long")
        documents = found.select("doc_id", status.alias("s"), F.array_join(F.from_json("errors", "array<string>"), "; ").alias("error")).select("doc_id", "s.*", F.nullif("error", F.lit("")).alias("error"))
        items = found.select("doc_id", F.explode(F.from_json("document", f"array<struct<{ITEM_FIELDS}>>")).alias("item")).select("doc_id", "item.*")
        return Result(documents, items)

    def export(self, path: str, kinds: tuple[str, ...] = ("md", "json")) -> DataFrame:
        """Writes the full successes, one folder for each kind; returns how many documents there are of each status."""
        good = self.documents.where("status = 'success'").select("doc_id")
        made = {"md": self.markdown, "json": self.json, "html": self.html, "outline": self.outline, "text": self.text, "doctags": self.doctags, "html_split_page": lambda: self.html(split_pages=True)}
        for kind in kinds:
            made[kind]().join(good, "doc_id", "left_semi").write.mode("overwrite").parquet(f"{path}/{kind}")
        return self.documents.groupBy("status").count()


class DocumentConverter:
    """Converts files of the allowed formats (all, if none are named).

    ``parsers`` are the caller's, by format (content -> Tree), for PDF, sound or instead of the library's own. ``plugins`` are the
    models of the enrichments that ``options`` ask for (series of texts -> series of answers), by name."""

    def __init__(self, spark: SparkSession, allowed_formats: tuple[str, ...] | None = None, document_timeout: float | None = None, options: PipelineOptions = PipelineOptions(), parsers: dict | None = None, plugins: dict | None = None):
        self.spark, self.allowed, self.options, self.parsers, self.plugins = spark, allowed_formats, options, parsers, plugins or {}
        self.timeout = document_timeout if document_timeout is not None else options.document_timeout
        self.pipelines: dict[str, tuple] = {}

    def initialize_pipeline(self) -> tuple:
        """The (plug-in, label, model) of each enrichment, made once for each set of options; a missing or barred one is an error."""
        key = self.options.key()
        if key not in self.pipelines:
            made = []
            for name, label in self.options.enrichments().items():
                registry = Registry(name, self.options.allow_external_plugins)
                if name in self.plugins:
                    registry.register(name, lambda f=self.plugins[name]: f, origin=self.plugins[name])
                made.append((name, label, registry.create(name)))
            self.pipelines[key] = tuple(made)
        return self.pipelines[key]

    def convert_all(self, path: str, limits: Limits = Limits(), patterns: str | None = None, raises_on_error: bool = False) -> Result:
        """Files are parsed here, once; what is made of the result reads the table of their items in the shared folder."""
        found = reader.inputs(reader.files(self.spark, path, patterns), self.allowed, limits.max_file_size)
        return self._result(found, limits, raises_on_error)

    convert = convert_all

    def convert_string(self, df: DataFrame, kind: str, content: str, key: str, limits: Limits = Limits(), base: str | None = None) -> Result:
        """A column of Markdown or HTML."""
        if kind not in ("md", "html"):
            raise ValueError("only Markdown and HTML come as strings")
        rows = df.select(F.col(key).alias("doc_id"), F.lit(kind).alias("format"), F.octet_length(content).alias("filesize"), F.lit("pending").alias("status"), F.lit(None).cast("string").alias("error"), F.col(content).alias("content"), (F.col(base) if base else F.lit(None).cast("string")).alias("base"))
        return self._result(rows, limits, False, "base")

    def _result(self, found: DataFrame, limits: Limits, strict: bool, base: str | None = None) -> Result:
        wanted = self.initialize_pipeline()
        parsed = scratch.save(reader.items(found.where("status = 'pending'"), base=base, timeout=self.timeout, parsers=self.parsers), "items")
        first, last = limits.page_range
        pages = parsed.groupBy("doc_id").agg(F.max(F.when(F.col("error") != reader.TOO_LATE, F.col("error"))).alias("parse_error"), F.bool_or(F.coalesce(F.col("error") == reader.TOO_LATE, F.lit(False))).alias("late"), F.max("page").alias("n_pages"))
        docs = scratch.save(found.drop("content"), "documents").join(pages, "doc_id", "left")
        many = F.col("n_pages") > limits.max_num_pages if limits.max_num_pages is not None else F.lit(False)
        beyond = F.coalesce(F.col("n_pages") < first, F.lit(False))
        live = F.col("status") == "pending"
        error = F.coalesce(F.col("error"), F.when(live & F.col("parse_error").isNotNull(), F.col("parse_error")).when(live & many, "too many pages").when(live & beyond, "first page beyond the end"))
        docs = docs.withColumn("error", error).withColumn("status", F.when(~live, F.col("status")).when(F.col("error").isNotNull(), "failure").when(F.coalesce("late", F.lit(False)), "partial_success").otherwise("success"))
        docs = docs.withColumn("error", F.when(F.col("status") == "partial_success", reader.TOO_LATE).otherwise(F.col("error"))).drop("parse_error", "late")
        if strict and (bad := docs.where("status NOT IN ('success', 'partial_success')").select("file", "error").first()):
            raise ConversionError(f"{bad['file']}: {bad['error']}")
        good = docs.where("status IN ('success', 'partial_success')").select("doc_id").distinct()
        kept = parsed.where(F.col("error").isNull() & (F.col("page").isNull() | F.col("page").between(first, last))).join(good, "doc_id", "left_semi")
        for name, label, model in wanted:
            kept = enrich(kept, F.col("label") == label, model, name)
        return Result(docs, kept)
