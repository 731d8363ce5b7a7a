"""Boxes that meet, tile by tile; aggregates with states that are merged."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.functions import aggregates
from vellumflow.operators import spatial


def boxes(rng, pages, n, size):
    return [(rng.choice(pages), k, x, y, x + rng.uniform(0, size), y + rng.uniform(0, size)) for k in range(n) for x, y in [(rng.choice([5.0, rng.uniform(-50, 500)]), rng.choice([5.0, rng.uniform(0, 700)]))]]


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("per_tile", [4, spatial.PER_TILE])
def test_pairs_once(spark, monkeypatch, closed, per_tile):
    monkeypatch.setattr(spatial, "PER_TILE", per_tile)
    rng = random.Random(per_tile)
    a, b = boxes(rng, [1, 1, 1, 2, None], 300, 60), boxes(rng, [1, 1, 3], 200, 200)
    a += [(1, 900, 5.0, 5.0, 5.0, 5.0), (1, 901, None, 0.0, 1.0, 1.0), (1, 902, 9.0, 0.0, 1.0, 1.0), (1, 903, -1e6, -1e6, 1e6, 1e6)]
    frame = lambda rows, p: spark.createDataFrame(rows, f"page long, {p}id long, {p}l double, {p}t double, {p}r double, {p}b double")
    got = spatial.meeting(frame(a, ""), frame(b, "p_"), closed=closed).select("id", "p_id").collect()
    sound = lambda r: None not in r and r[2] <= r[4] and r[3] <= r[5]
    meets = lambda p, q: p[2] <= q[4] and p[4] >= q[2] and p[3] <= q[5] and p[5] >= q[3] if closed else p[2] < q[4] and p[4] > q[2] and p[3] < q[5] and p[5] > q[3]
    assert sorted(map(tuple, got)) == sorted((p[1], q[1]) for p in a for q in b if sound(p) and sound(q) and p[0] == q[0] and meets(p, q))


def test_a_dense_page_is_split(spark):
    rng = random.Random(1)
    rows = spark.createDataFrame([(1, k, x, y, x + 2, y + 2) for k in range(20000) for x, y in [(rng.uniform(0, 600), rng.uniform(0, 800))]], "page long, id long, l double, t double, r double, b double")
    pages = rows.groupBy("page").agg(F.lit(8).cast("long").alias("__tiles"), F.min("l").alias("__l"), F.min("t").alias("__t"), F.lit(76.0).alias("__w"), F.lit(101.0).alias("__h"))
    tiles = spatial.tiled(rows, pages).groupBy("tx", "ty").count().collect()
    assert len(tiles) == 64 and max(t["count"] for t in tiles) < 600
    spread = spatial.tiled(rows, pages).repartition(8, "page", "tx", "ty").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) > 4 and max(r["count"] for r in spread) < 10000


class Moments:
    """Mean and deviation, with missing values left out."""

    def zero(self):
        return (0, 0.0, 0.0)

    def update(self, state, x, w):
        x = np.asarray(x, float)[np.asarray(w) > 0]
        x = x[~np.isnan(x)]
        return self.merge(state, (len(x), float(x.mean()), float(((x - x.mean()) ** 2).sum()))) if len(x) else state

    def merge(self, a, b):
        n = a[0] + b[0]
        if not n:
            return a
        d = b[1] - a[1]
        return (n, a[1] + d * b[0] / n, a[2] + b[2] + d * d * a[0] * b[0] / n)

    def finish(self, state):
        return {"n": state[0], "mean": state[1], "std": (state[2] / state[0]) ** 0.5 if state[0] else None}


@pytest.mark.parametrize("most", [aggregates.MOST_GROUPS, 3])
def test_states_are_merged(spark, monkeypatch, most):
    monkeypatch.setattr(aggregates, "MOST_GROUPS", most)
    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 9 + ["a", "b", "c", "d", None]), rng.choice([1, 2]), rng.choice([None, rng.gauss(5, 2), rng.gauss(5, 2)]), rng.choice([0, 1, 1])) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "k string, j int, x double, w int").repartition(6)
    got = {(r["k"], r["j"]): r["value"] for r in aggregates.aggregate(frame, ["k", "j"], ["x", "w"], Moments(), "struct<n:int,mean:double,std:double>").collect()}
    by = {}
    for k, j, x, w in rows:
        by.setdefault((k, j), []).extend([x] if x is not None and w else [])
    assert set(got) == set(by)
    for key, xs in by.items():
        assert got[key]["n"] == len(xs) and got[key]["mean"] == pytest.approx(np.mean(xs)) and got[key]["std"] == pytest.approx(np.std(xs))
    assert aggregates.aggregate(frame.limit(0), ["k"], ["x", "w"], Moments(), "struct<n:int,mean:double,std:double>").count() == 0


class Longest:
    def zero(self):
        return ""

    def update(self, state, texts):
        return max([state, *texts], key=lambda t: (len(t), t))

    def merge(self, a, b):
        return max(a, b, key=lambda t: (len(t), t))

    def finish(self, state):
        return state


def test_in_sql(spark):
    aggregates.register(spark, "longest", Longest(), "string")
    spark.createDataFrame([(1, "a"), (1, "bbb"), (2, "cc")], "k int, t string").createOrReplaceTempView("texts")
    assert [tuple(r) for r in spark.sql("SELECT k, longest(t) AS t FROM texts GROUP BY k ORDER BY k").collect()] == [(1, "bbb"), (2, "cc")]
