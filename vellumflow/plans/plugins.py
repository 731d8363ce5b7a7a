"""Plug-ins: registered kinds of models, enrichment of items and extraction by page, with models of the caller's."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUPS = ("ocr", "layout", "table_structure", "picture_description", "picture_classification", "code", "formula", "parser")


def admitted(module: Column, own: str, allowed: Column) -> Column:
    """Whether a plug-in may be used: it comes from the library's own module, or those from outside are allowed."""
    return module.startswith(own) | allowed


class Registry:
    """Names of one group of plug-ins; what comes from outside this library needs to be allowed."""

    def __init__(self, group: str, allow_external: bool = False):
        if group not in GROUPS:
            raise ValueError(f"no group named {group}")
        self.group, self.allow_external = group, allow_external
        self.made: dict[str, Callable[..., Any]] = {}

    def register(self, kind: str, factory: Callable[..., Any], origin: Callable[..., Any] | None = None) -> None:
        """``origin``: whose module counts, if not the factory's."""
        if kind in self.made:
            raise ValueError(f"{kind} is registered already")
        module = (origin or factory).__module__
        if not self.allow_external and module.split(".")[0] != __name__.split(".")[0]:
            raise PermissionError(f"{module} is not part of this library")
        self.made[kind] = factory

    def create(self, kind: str, **options) -> Any:
        if kind not in self.made:
            raise KeyError(f"{kind}: known are {', '.join(sorted(self.made))}")
        return self.made[kind](**options)

    def first(self, order: tuple[str, ...], **options) -> Any | None:
        """The first of ``order`` that can be made here, or None."""
        for kind in order:
            try:
                return self.create(kind, **options)
            except (KeyError, ImportError):
                continue
        return None


def enrich(items: DataFrame, where: Column, model: Callable[[pd.Series], pd.Series], column: str, kind: str = "string", of: str = "text") -> DataFrame:
    """``items`` with ``column``: the model's answer for the items that fit, null for the others. The model gets Arrow
    batches of the texts in question only."""
    answer = F.pandas_udf(model, kind)
    return items.where(where).withColumn(column, answer(F.col(of))).unionByName(items.where(~where | where.isNull()).withColumn(column, F.lit(None).cast(kind)))


def extract(pages: DataFrame, model: Callable[[pd.Series], pd.Series], key: str = "doc_id", page: str = "page_no", content: str = "content") -> tuple[DataFrame, DataFrame]:
    """(pages, documents): a model's JSON answer for every page, null if it is none, and each document's status."""
    raw = pages.withColumn("raw_text", F.pandas_udf(model, "string")(F.col(content)))
    done = raw.select(key, page, "raw_text", F.when(F.expr("try_parse_json(raw_text) IS NOT NULL"), F.col("raw_text")).alias("extracted_data"))
    done = done.withColumn("error", F.when(F.col("extracted_data").isNull(), "the answer is not JSON"))
    status = F.when((F.count("*") > 0) & (F.count("error") == 0), "success").otherwise("failure")
    return done, done.groupBy(key).agg(status.alias("status"), F.count("*").alias("pages"))


def transform_text(items: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    """The items with their texts, and those of their table cells, changed."""
    cells = F.transform("cells", lambda c: c.withField("text", change(c["text"])))
    return items.withColumn("text", change(F.col("text"))).withColumn("cells", cells)
