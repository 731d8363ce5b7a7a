"""Numbers from folds over the ordered rows of a group, where what a row gets depends on all before it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def folded(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], of: tuple[str, ...], step: Callable[..., list[int]], number: str) -> DataFrame:
    """``df`` with ``number``: what ``step`` gives for each row of a group from the columns ``of`` (numpy, in ``order``).

    A group's rows are one array and an Arrow batch holds many groups; only the columns ``of`` go to Python, and only numbers come back."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias("rows"))

    @F.arrow_udf("array<int>")
    def numbers(*columns: pa.Array) -> pa.Array:
        at = np.concatenate([[0], np.cumsum(columns[0].value_lengths().to_numpy())]).astype(np.int32)
        flat = [c.flatten().to_numpy(zero_copy_only=False) for c in columns]
        out = np.zeros(at[-1], np.int32)
        for a, z in zip(at[:-1], at[1:]):
            out[a:z] = step(*(c[a:z] for c in flat))
        return pa.ListArray.from_arrays(pa.array(at), pa.array(out))

    zipped = grouped.withColumn("numbers", numbers(*(F.col(f"rows.{c}") for c in of))).select(*keys, F.explode(F.arrays_zip("rows", "numbers")).alias("z"))
    return zipped.select(*keys, *(F.col(f"z.rows.{c}").alias(c) for c in (*order, *rest)), F.col("z.numbers").alias(number))
