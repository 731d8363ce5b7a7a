"""All named queries of the library and the SQL that they are held against."""

from __future__ import annotations

import importlib
import pkgutil

from pyspark.sql import DataFrame, SparkSession

from vellumflow import operators
from vellumflow.registry import QUERIES, SQL


def _load() -> None:
    for module in pkgutil.iter_modules(operators.__path__):
        if module.name.endswith("_queries"):
            importlib.import_module(f"vellumflow.operators.{module.name}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict:
    _load()
    return dict(SQL)


def entry(spark: SparkSession, folder: str) -> DataFrame:
    """The cells of each page put into their layout clusters."""
    return queries()["cell_cluster_assign"](spark, folder)
