"""What operators hold and send where rows repeat: bounded by tasks, not by rows."""

import itertools
import zlib

from pyspark.sql import functions as F

from vellumflow.llm import fingerprint, labelled, queries, substring, topk, wavelet

from . import cases


def test_sample_of_a_repeated_id(spark):
    """One id of 2000 documents gives one training row, its least text."""
    hot = next(k for k in range(50) if zlib.crc32(str(k).encode()) % labelled.FOLDS != labelled.HELD_OUT)
    docs = cases.frame(spark, [(hot, f"text {k:04d}") for k in range(2000)] + [(k, f"own {k}") for k in range(100, 140)]).repartition(4)
    rows = [(hot, 1, 1)] + [(k, k % 2, 0) for k in range(100, 140)]
    texts, y = labelled.sample(docs, spark.createDataFrame(rows + rows, "doc_id long, quality int, toxic int"), "quality", 60, True)
    assert len(texts) == len(y) <= 41 and texts.to_pylist().count("text 0000") == 1 and sum(t.startswith("text") for t in texts.to_pylist()) == 1


def test_fingerprints_of_equal_rows_are_spread(spark):
    """Equal rows are folded by the tasks that read them; results are as if each were sent."""
    rows = [(None, "the same text for all of them")] * 3000 + [(k, f"text {k} of its own\nwith a line") for k in range(40)] + [(5, "text 5 of its own\nwith a line")] * 700
    docs = cases.frame(spark, rows).repartition(4)
    sizes = [r["n"] for r in fingerprint.with_next(docs.select("doc_id", "text")).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) < 200
    got = fingerprint.report(docs)
    assert got.count() == len(rows) and got.where("doc_id IS NULL").count() == 3000 and got.where("doc_id = 5").count() == 701
    assert got.where("doc_id IS NULL AND near_next = 1").count() == 2999 and got.where("doc_id = 5 AND near_next = 1").count() == 700
    few = cases.frame(spark, [(None, "the same text for all of them")] * 2 + [(k, f"text {k} of its own\nwith a line") for k in range(40)] + [(5, "text 5 of its own\nwith a line")])
    assert got.distinct().exceptAll(fingerprint.report(few).distinct()).count() == 0


def test_passages_of_equal_rows_are_looked_at_once(spark):
    """Of many rows of one id and text, one is scanned; all are cut."""
    shared = " ".join(f"w{k}" for k in range(30))
    rows = [(1, "before " + shared + " after")] + [(None, shared + " and something else")] * 800
    docs = cases.frame(spark, rows).repartition(4)
    keyed, repeated = substring._keyed(docs, "doc_id", "text")
    copies, cuts = substring.repeats(keyed, "text", repeated)
    assert repeated and copies.count() == 0 or copies.select("id", "tag").distinct().count() == copies.count()
    assert [len(r["cut"]) for r in cuts.collect()] == [18]
    got = substring.report(docs).where("doc_id IS NULL").groupBy("n_removed").count().collect()
    assert [(r["n_removed"], r["count"]) for r in got] == [(30, 800)]


def test_empty_vectors_take_part(spark):
    """An empty vector holds nothing that is null: it scores 0 with every other."""
    rows = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [], 1), (2, [0.5, -1.0], 1), (3, [0.25, -1.0], 1), (4, None, 1), (20, [], 1)], "vec_id long, embedding array<float>, label int")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(rows).collect())
    assert got == [(0, 1, 1, 0), (0, 2, 20, 0), (0, 3, 2, -6144), (0, 4, 3, -7168), (20, 1, 0, 0), (20, 2, 1, 0), (20, 3, 2, 0), (20, 4, 3, 0)]


def test_token_files_of_a_repeated_id(spark, tmp_path):
    """Rows of one id are spread over the partitions that their texts fill, equal ones too."""
    rows = [(None, "the same text for all")] * 600 + [(3, f"text number {k}") for k in range(600)] + [(k, "own") for k in range(10, 20)]
    folder = f"file://{tmp_path}/shards"
    wavelet.write(cases.frame(spark, rows).repartition(3), folder, queries.tokenizer_path())
    sizes = [r["n"] for r in spark.read.parquet(folder).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()]
    assert len(sizes) > 2 and max(sizes) < 0.6 * sum(sizes)
    got = [tuple(r) for r in wavelet.read(spark, folder).orderBy("start").collect()]
    assert [r[0] for r in got] == [None] * 600 + [3] * 600 + list(range(10, 20))
    assert [r[1] for r in got] == [0, *itertools.accumulate(r[2] for r in got)][:-1]
