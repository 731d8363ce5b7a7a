"""Aggregates of the caller's with a state that tasks make and merge: nothing but states is shuffled."""

from __future__ import annotations

import pickle
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Groups whose states a task holds at a time.
MOST_GROUPS = 10_000


class Aggregate(Protocol):
    """States can be pickled; merge() is associative and commutative, and zero() changes nothing in it."""

    def zero(self) -> Any: ...

    def update(self, state: Any, *columns) -> Any:
        """``state`` with the values of some rows of its group (arrays of equal length)."""

    def merge(self, a: Any, b: Any) -> Any: ...

    def finish(self, state: Any) -> Any: ...


def aggregate(df: DataFrame, keys: list[str], columns: list[str], how: Aggregate, result: str, name: str = "value") -> DataFrame:
    """(keys, name): what ``how`` makes of the columns of each group, of the type ``result`` (one type: a struct as struct<...>).

    Every task gathers the states of its own rows; states are merged in two steps, so a group that all tasks have is
    no long list. Null keys are a group; an empty table has no groups."""
    spark = df.sparkSession
    kinds = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def partial(batches):
        states: dict[tuple, list] = {}
        for b in batches:
            schema = b.schema
            pdf = b.to_pandas()
            for row, place in pdf.groupby([pdf[k] for k in keys], dropna=False, sort=False).indices.items() if keys else [((), range(len(pdf)))]:
                part = pdf.iloc[list(place)]
                first = place[0] if len(place) else 0
                key = tuple(b.column(n)[int(first)].as_py() for n in range(len(keys)))
                states[key] = how.update(states[key] if key in states else how.zero(), *(part[c].to_numpy() for c in columns))
            if len(states) > MOST_GROUPS:
                yield sent(states, schema)
                states = {}
        if states:
            yield sent(states, schema)

    def sent(states: dict, schema: pa.Schema) -> pa.RecordBatch:
        own = [pa.array([k[n] for k in states], schema.field(n).type) for n in range(len(keys))]
        return pa.RecordBatch.from_arrays([*own, pa.array([pickle.dumps(s) for s in states.values()], pa.binary())], [*keys, "state"])

    def step(states: DataFrame, last: bool, *more: str) -> DataFrame:
        field = StructType.fromDDL(f"`{name}` {result}" if last else "state binary").fields[0]
        kind = to_arrow_schema(StructType([field])).field(0).type

        def merged(batches):
            for b in batches:
                out = []
                for listed in b.column(b.num_columns - 1).to_pylist():
                    state = how.zero()
                    for s in listed:
                        state = how.merge(state, pickle.loads(s))
                    out.append(how.finish(state) if last else pickle.dumps(state))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, kind)], [*keys, field.name])

        listed = states.groupBy(*keys, *more).agg(F.collect_list("state").alias("states")).select(*keys, "states")
        return listed.mapInArrow(merged, StructType([*listed.schema.fields[:-1], field]))

    states = df.select(*keys, *columns).mapInArrow(partial, f"{kinds}{', ' if keys else ''}state binary")
    salts = max(1, round(int(spark.conf.get("spark.sql.shuffle.partitions")) ** 0.5))
    return step(step(states.withColumn("__salt", F.spark_partition_id() % salts), False, "__salt"), True)


def register(spark: SparkSession, name: str, how: Aggregate, result: str) -> None:
    """Makes ``how`` known to SQL as an aggregate function of any columns. Spark hands it a whole group at a time there; aggregate()
    is the way that merges."""

    def whole(*columns: pd.Series):
        return how.finish(how.update(how.zero(), *(c.to_numpy() for c in columns)))

    spark.udf.register(name, F.pandas_udf(whole, result, F.PandasUDFType.GROUPED_AGG))
