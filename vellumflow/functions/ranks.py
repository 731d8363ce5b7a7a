"""Numbers that depend on the order of all rows of a group, for groups of any size: running sums, quantiles, mergeable sketches.

Rows are dealt to tasks by ranges of (keys, order), so a group of any size is cut into ranges; what a range adds up is a few numbers, and
the ranges before it give it its start. No task ever holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow import scratch


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & a[k].eqNullSafe(b[f"__{k}"])
    return on


def running(df: DataFrame, keys: list[str], order: list[str], weight: str | None = None, name: str = "before") -> DataFrame:
    """``df`` with ``name``: what the rows of the same keys that come before it in ``order`` weigh together (1 each without ``weight``).
    Rows of equal keys and order come in any order. Null keys are a key."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = F.col(weight) if weight else F.lit(1).cast("long")
    ranged = scratch.save(df.repartitionByRange(n, *keys, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*keys, "__range").agg(F.sum(own).alias("__sum"))
    start = F.coalesce(F.sum("__sum").over(Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = scratch.save(sums.withColumn("__start", start), "starts").select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__range").alias("__of"), "__start")
    within = F.coalesce(F.sum(own).over(Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = ranged.withColumn("__within", within)
    joined = rows.join(starts, (rows["__range"] == starts["__of"]) & _same(rows, starts, keys))
    return joined.select(*df.columns, (F.col("__start") + F.col("__within")).alias(name))


def percentiles(df: DataFrame, keys: list[str], value: str, asked: dict[str, float]) -> DataFrame:
    """keys and a column for each of ``asked`` (name: part from 0 to 1): exact quantiles with linear interpolation between the two nearest
    values. Null and NaN values do not count; a group of none is left out."""
    counted = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__c"))
    ranks = running(counted, keys, ["__v"], "__c", "__before")
    totals = counted.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.sum("__c").alias("__n"))
    rows = ranks.join(totals, _same(ranks, totals, keys))
    out = []
    for name, part in asked.items():
        at = (F.col("__n") - 1) * F.lit(part)
        holds = lambda rank: (F.col("__before") <= rank) & (rank < F.col("__before") + F.col("__c"))
        low, high = F.max(F.when(holds(F.floor(at)), F.col("__v"))), F.max(F.when(holds(F.ceil(at)), F.col("__v")))
        out.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    return rows.groupBy(*keys).agg(*out)


#: Values up to which a sketch keeps all, and the size that says so. A quantile of a larger sketch is a value whose rank is off by less than
#: SKETCH_ERROR of the number of values, in 99 of 100 cases.
SKETCH_EXACT, SKETCH_K, SKETCH_ERROR = 400, 400, 0.0075


def sketches(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, sketch, n): a mergeable sketch of each group's values, made by every task of its own rows before the shuffle. Null and NaN do not count."""
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    return df.groupBy(*keys).agg(F.kll_sketch_agg_double(v, SKETCH_K).alias("sketch"), F.count(v).alias("n"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, sketch, n) of sketches (..., sketch, n) put together by coarser keys, such as days into months."""
    return parts.where("n > 0").groupBy(*keys).agg(F.kll_merge_agg_double("sketch", SKETCH_K).alias("sketch"), F.sum("n").alias("n"))


def sketched(parts: DataFrame, asked: dict[str, float]) -> DataFrame:
    """``parts`` with a column for each of ``asked``: the least value whose rank reaches that part; of no values, null."""
    return parts.withColumns({name: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(part))) for name, part in asked.items()}).drop("sketch")
