"""Names, ranks, quantiles and sketches against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.functions import ranks
from vellumflow.operators import names


def plain_spans(text, known):
    """Leftmost, then longest, one after the other."""
    out, at = [], 0
    while at < len(text or ""):
        hit = max((n for n in known if n and text.startswith(n, at)), key=len, default=None)
        if hit:
            out.append((at, at + len(hit), hit))
        at += len(hit) if hit else 1
    return out


@pytest.mark.parametrize("letters", [names.SHARD_LETTERS, 400])
def test_spans_of_thousands_of_names(spark, monkeypatch, letters):
    monkeypatch.setattr(names, "SHARD_LETTERS", letters)
    rng = random.Random(1)
    known = {"".join(rng.choice("abé") for _ in range(rng.randint(2, 9))) for _ in range(2500)} if letters > 1000 else {"".join(rng.choice("ab") for _ in range(rng.randint(3, 8))) for _ in range(150)}
    texts = [(k, "".join(rng.choice("abé ") for _ in range(rng.randint(0, 120)))) for k in range(60)] + [(100, None), (101, ""), (102, "zzz")]
    dictionary = spark.createDataFrame([(n, "x") for n in known] + [("", "x"), ("ab", "y")], "name string, label string")
    got = names.spans(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), dictionary)
    known.add("ab")
    assert sorted(tuple(r) for r in got.collect()) == sorted((k, *s) for k, t in texts for s in plain_spans(t, known))
    assert names.spans(spark.createDataFrame(texts, "doc_id long, text string"), dictionary.limit(0)).count() == 0


def test_stable_ids_and_replacement(spark):
    rng = random.Random(2)
    mentions = [(rng.randrange(50), rng.randrange(30), f"n{rng.randrange(300)}", rng.choice(["person", "person", "org", None])) for _ in range(2000)]
    frame = spark.createDataFrame(mentions, "doc_id long, begin int, name string, label string").repartition(5)
    got = {r["name"]: (r["label"], r["stable_id"]) for r in names.stable_ids(frame, ["doc_id", "begin"]).collect()}
    first, counts, want = {}, {}, {}
    for d, b, n, label in mentions:
        first[n] = min(first.get(n, (99, 99, True, "")), (d, b, label is not None, label or ""))
    for _, n in sorted((f[:2], n) for n, f in first.items()):
        label = first[n][3] or None
        counts[label] = counts.get(label, 0) + 1
        want[n] = (label, f"{label}-{counts[label]}" if label else str(counts[label]))
    assert got == want
    texts = spark.createDataFrame([(1, "Ann met Bob and Ann's aunt Anna"), (2, "Bob"), (3, None), (4, "nobody")], "doc_id long, text string")
    known = spark.createDataFrame([("Ann", "person"), ("Anna", "person"), ("Bob", "org")], "name string, label string")
    found = names.spans(texts, known).join(known, "name")
    new = names.replaced(texts, found, names.stable_ids(found, ["doc_id", "begin"]))
    assert dict(map(tuple, new.collect())) == {1: "person-1 met org-1 and person-1's aunt person-2", 2: "org-1", 3: None, 4: "nobody"}


def test_normal_forms_and_merges(spark):
    rows = spark.createDataFrame([("  A \n b  ", "Date of-Birth!"), ("", "--"), (None, None)], "n string, l string")
    assert [tuple(r) for r in rows.select(names.normal_name(F.col("n")), names.normal_label(F.col("l"))).collect()] == [("A b", "date_of_birth"), ("", "pii"), (None, "pii")]
    spans = [("a", 0, 3), ("a", 3, 5), ("a", 7, 8), ("b", 1, 9), ("b", 2, 3), ("b", 9, 10), (None, 1, 2)]
    got = names.merged(spark.createDataFrame(spans, "k string, begin int, stop int"), ["k"]).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([("a", 0, 5, 2), ("a", 7, 8, 1), ("b", 1, 10, 3), (None, 1, 2, 1)], key=str)


def test_running_sums_of_a_group_over_many_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "hot", "x", None]), rng.random(), rng.randrange(5)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "k string, v double, w long").repartition(6)
    got = ranks.running(frame, ["k"], ["v"], "w").collect()
    by = {}
    for k, v, w in sorted(rows, key=lambda r: r[1]):
        by.setdefault(k, []).append((v, w))
    want = [(k, v, w, sum(x for _, x in own[:n])) for k, own in by.items() for n, (v, w) in enumerate(own)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


SKEWED = {"skewed": [float(int(x)) for x in np.random.default_rng(4).pareto(1.0, 4000) * 10], "constant": [7.0] * 3000, "one": [3.0], "two": [1.0, 2.0], "negative": [-5.0, float("inf"), 0.0]}


def values(spark):
    rows = [(k, v) for k, vs in SKEWED.items() for v in vs] + [("skewed", None), ("skewed", float("nan")), ("none", None), (None, 4.0)]
    return spark.createDataFrame(rows, "k string, v double").repartition(5)


def test_percentiles_are_exact(spark):
    asked = {"low": 0.1, "median": 0.5, "p90": 0.9, "least": 0.0, "most": 1.0}
    got = {r["k"]: r for r in ranks.percentiles(values(spark), ["k"], "v", asked).collect()}
    assert set(got) == {*SKEWED, None}
    for k, vs in SKEWED.items():
        if k != "negative":
            assert all(got[k][n] == pytest.approx(np.quantile(vs, p), rel=1e-12) for n, p in asked.items())
    assert got["negative"]["median"] == 0.0 and got["negative"]["least"] == -5.0 and got[None]["median"] == 4.0
    plan = ranks.percentiles(values(spark).where("k = 'skewed'"), ["k"], "v", {"m": 0.5})
    assert plan.count() == 1


def test_no_range_holds_a_whole_group(spark):
    rows = spark.range(4000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).cast("double").alias("v"))
    spread = rows.repartitionByRange(4, "k", "v").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) == 4 and max(r["count"] for r in spread) < 2000


def test_sketches_merge_and_stay_near(spark):
    parts = ranks.sketches(values(spark).withColumn("day", F.spark_partition_id()), ["k", "day"], "v")
    got = {r["k"]: r for r in ranks.sketched(ranks.merged(parts, ["k"]), {"low": 0.1, "median": 0.5, "p90": 0.9}).collect()}
    assert set(got) == {*SKEWED, None}
    for k in ("skewed", "constant"):
        own = np.sort(SKEWED[k])
        for name, part in (("low", 0.1), ("median", 0.5), ("p90", 0.9)):
            first, last = np.searchsorted(own, got[k][name]), np.searchsorted(own, got[k][name], side="right")
            assert first / len(own) - ranks.SKETCH_ERROR <= part <= last / len(own) + ranks.SKETCH_ERROR
    assert got["constant"]["median"] == 7.0 and got["one"]["p90"] == 3.0
    few = spark.createDataFrame([(float(x),) for x in range(ranks.SKETCH_EXACT)], "v double")
    exact = ranks.sketched(ranks.sketches(few, [], "v"), {"m": 0.5}).first()
    assert exact["m"] in (199.0, 200.0) and exact["n"] == 400
