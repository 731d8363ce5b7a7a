"""What the operators need of a session: a shared folder, tables written there, batch sizes, tests of membership."""

from __future__ import annotations

import ctypes
import functools
import operator
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellumflow.scratch import discard, save, shared_dir  # noqa: F401

#: Rows that an Arrow batch holds at most, so that a Python worker sees some megabytes of text at a time.
BATCH_ROWS = 1000
#: And bytes, so that long texts come in smaller batches.
BATCH_BYTES = 4 << 20


def tune(spark: SparkSession) -> None:
    """Bounds the batches that Python workers get and lets shuffle files go as soon as the action that needs them has ended
    (what is used again is a table); to be called before a plan with Python in it runs."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def trim() -> None:
    """Gives memory that is free in this process back to the system; Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if give := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give(0)


def lean(run: Callable) -> Callable:
    """``run`` (of mapInArrow), with a worker that keeps no free memory once its task has ended."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


class Sieve:
    """A test that holds for every value of ``ids.column`` and for few others, in built-in functions.

    A blocked Bloom filter: a value names one block of BLOCK_BITS bits and TESTS bits in it. The number of blocks follows
    the number of values (PER_VALUE bits each, so some 2 percent of the others pass at any size), the blocks are the rows of
    a table, and that table is broadcast: at most MOST_BLOCKS of 4 KB. With more values than fit there is no sieve: all
    pass, and the joins that follow shuffle whole tables. It only spares work and never decides.
    """

    BLOCK_BITS, PER_VALUE, TESTS, MOST_BLOCKS = 1 << 15, 12, 2, 1 << 13

    def __init__(self, ids: DataFrame, column: str):
        tune(ids.sparkSession)
        self.blocks = max(1, -(-ids.count() * self.PER_VALUE // self.BLOCK_BITS))
        self.full = self.blocks > self.MOST_BLOCKS
        if not self.full:
            bits = ids.select(self._block(column).alias("__block"), F.explode(F.array(*self._bits(column))).alias("bit"))
            self.table = save(bits.groupBy("__block").agg(F.bitmap_construct_agg("bit").alias("__map")), "sieve")

    def _block(self, column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column)), F.lit(self.blocks).cast("long"))

    def _bits(self, column: str) -> list[Column]:
        h = F.xxhash64(F.col(column), F.lit(1))
        return [F.shiftright(h, 20 * k).bitwiseAND(F.lit(self.BLOCK_BITS - 1).cast("long")) for k in range(self.TESTS)]

    def _tested(self, df: DataFrame, column: str) -> DataFrame:
        if self.full:
            return df.withColumn("__in", F.lit(True))
        whole = lambda x: F.conv(F.hex(x), 16, 10).cast("int")
        set_ = lambda b: F.getbit(whole(F.substring("__map", F.shiftright(b, 3).cast("int") + 1, F.lit(1))), b.bitwiseAND(F.lit(7).cast("long")).cast("int")) == 1
        found = df.withColumn("__block", self._block(column)).join(F.broadcast(self.table), "__block", "left")
        test = functools.reduce(operator.and_, map(set_, self._bits(column)))
        return found.withColumn("__in", F.coalesce(test, F.lit(False))).drop("__block", "__map")

    def passing(self, df: DataFrame, column: str) -> DataFrame:
        return self._tested(df, column).where("__in").drop("__in")

    def failing(self, df: DataFrame, column: str) -> DataFrame:
        return self._tested(df, column).where("NOT __in").drop("__in")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the least node reachable, of every node in ``edges`` (a, b). Labels fall to the least neighbour's
    and then to their own label's label, until none changes; every round is a table in the shared folder."""
    both = save(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    last = save(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), "labels")
    labels = last
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("m"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", "comp", F.least("comp", "m").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("comp").alias("top"))
        step = save(low.join(up, "low", "left").select("node", "comp", F.least("low", "top").alias("next")), "labels")
        changed = step.where("next < comp").limit(1).count()
        discard(last)
        last, labels = step, step.select("node", F.col("next").alias("comp"))
        if not changed:
            discard(both)
            labels._saved_at = step._saved_at
            return labels
