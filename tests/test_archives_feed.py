"""Archives read by page ranges and written whole; documents out of pages that arrive one by one."""

import datetime
import io
import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.test_convert import folder  # noqa: F401
from vellumflow.plans.convert import DocumentConverter, Result
from vellumflow.sources import archives, xmldocs
from vellumflow.streaming import pages


def layout(n, bad=()):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("OFD.xml", "<OFD><DocBody><DocRoot>Doc_0/Document.xml</DocRoot></DocBody></OFD>")
        z.writestr("Doc_0/Document.xml", "<Document><Pages>" + "".join(f'<Page ID="{k}" BaseLoc="Pages/{k}.xml"/>' for k in range(n)) + "</Pages></Document>")
        for k in range(n):
            text = "".join(f'<TextObject Boundary="{10 + 5 * j} {20 * j} 0 8" Size="5"><TextCode>page {k + 1} line {j}</TextCode></TextObject>' for j in range(3))
            z.writestr(f"Doc_0/Pages/{k}.xml", "<Page><broken" if k + 1 in bad else f"<Page><Content>{text}</Content></Page>")
    return raw.getvalue()


@pytest.fixture(scope="module")
def books(tmp_path_factory):
    top = tmp_path_factory.mktemp("ofd")
    (top / "large.ofd").write_bytes(layout(40, {7}))
    (top / "small.ofd").write_bytes(layout(2))
    (top / "none.ofd").write_bytes(b"not an archive")
    (top / "other.txt").write_bytes(b"x")
    return top


def read(spark, books, **options):
    archives.register(spark)
    return spark.read.format("fixed_layout_pages").options(**options).load(str(books))


def test_a_large_archive_is_read_by_several_tasks(spark, books):
    found = read(spark, books, largeBytes=2000, pagesPerTask=8)
    large = found.where("path LIKE '%large.ofd'")
    tasks = large.select("page", F.spark_partition_id().alias("task")).distinct().groupBy("task").agg(F.count("*").alias("n"), F.min("page").alias("first"), F.max("page").alias("last")).collect()
    assert len(tasks) == 5 and all(t["n"] == 8 and t["last"] - t["first"] == 7 for t in tasks)
    rows = large.orderBy("page", "n").collect()
    assert [r["page"] for r in rows] == sorted([k for k in range(1, 41) for _ in range(1 if k == 7 else 3)])
    assert [(r["page"], "Error" in r["error"]) for r in rows if r["error"]] == [(7, True)]
    whole = [x for p in range(1, 41) if p != 7 for x in xmldocs.Layout(zipfile.ZipFile(str(books / "large.ofd"))).texts(p)]
    assert [(r["page"], r["text"], r["l"], r["r"]) for r in rows if not r["error"]] == [(x["page"], x["text"], x["l"], x["r"]) for x in whole]
    assert found.where("path LIKE '%none.ofd'").select("page", F.col("error").isNotNull()).collect() == [(None, True)]
    assert found.where("path LIKE '%small.ofd'").count() == 6


def test_page_and_path_filters_reach_the_reader(spark, books):
    found = read(spark, books, largeBytes=2000, pagesPerTask=8).where((F.col("page") >= 10) & (F.col("page") < 12) & (F.col("path") == str(books / "large.ofd")))
    assert sorted({r["page"] for r in found.collect()}) == [10, 11] and found.rdd.getNumPartitions() == 1
    assert sorted({r["page"] for r in read(spark, books, largeBytes=2000).where(F.col("page").isin(1, 30)).collect()}) == [1, 30]
    wanted = archives.Wanted()
    assert wanted.push(archives.GreaterThan(("page",), 3)) and not wanted.push(archives.EqualTo(("text",), "x")) and not wanted.takes(3) and wanted.takes(4)


def test_archives_of_conversions(spark, folder, tmp_path):  # noqa: F811
    r = DocumentConverter(spark).convert_all(folder)
    place = str(tmp_path / "out")
    r.save_archives(place)
    n = r.documents.where("doc_id IS NOT NULL").count()
    assert len(list((tmp_path / "out").iterdir())) == n
    back = Result.load_archives(spark, place)
    assert sorted((x["doc_id"], x["status"], x["file"]) for x in back.documents.collect()) == sorted((x["doc_id"], x["status"], x["file"]) for x in r.documents.where("doc_id IS NOT NULL").collect())
    assert {x["doc_id"]: x["markdown"] for x in back.markdown().collect()} == {x["doc_id"]: x["markdown"] for x in r.markdown().collect()}
    one = next(p for p in (tmp_path / "out").iterdir())
    with zipfile.ZipFile(one) as z:
        assert {"version.json", "status.json", "errors.json"} <= set(z.namelist()) and json.loads(z.read("version.json")) == {"archive": 1}
    with zipfile.ZipFile(one, "w") as z:
        z.writestr("errors.json", "no JSON")
    (tmp_path / "out/junk.zip").write_bytes(b"junk")
    back = Result.load_archives(spark, place)
    assert back.documents.count() == n + 1 and {x["doc_id"]: x["error"] for x in back.documents.collect()}["junk"] == "not an archive"
    r.save_archives(place, overwrite=True)
    assert len(list((tmp_path / "out").iterdir())) == n


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    archives.register(spark)
    rows = spark.createDataFrame([(f"d{k}", "{}") for k in range(20)] + [("not/a name", "{}")], "doc_id string, status string").repartition(4)
    with pytest.raises(Exception, match="no file can be named"):
        rows.write.format("conversion_archives").mode("append").save(str(tmp_path))
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []
    with pytest.raises(Exception, match="two rows have one doc_id"):
        spark.createDataFrame([("a", "{}"), ("a", "{}")], "doc_id string, status string").write.format("conversion_archives").mode("append").save(str(tmp_path))
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []


PAGE = "doc_id long, page_no int, n_pages int, ts timestamp, ok boolean"


def fed(rows):
    return sorted((r["doc_id"], r["status"], r["n_pages"], r["ok"], r["failed"], tuple(r["missing"]), r["error"]) for r in rows.collect())


def when(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_documents_of_pages(spark):
    rows = [
        (1, 1, 2, when(0), True), (1, 2, 2, when(5), True), (1, 2, 2, when(6), False), (2, 1, 2, when(0), True), (2, 2, 2, when(50), True), (3, 1, 1, when(0), False), (4, 1, 3, when(0), True), (4, 2, 3, when(1), False), (4, 3, 3, when(2), True),
        (5, 9, 2, when(0), True), (None, 1, 1, when(0), True), (6, 1, 2, None, True), (7, 2, 2, when(0), None),
    ]
    got = fed(pages.documents(spark.createDataFrame(rows, PAGE), 10))
    late = pages.TOO_LATE
    assert got == [(1, "success", 2, 2, 0, (), None), (2, "partial_success", 2, 1, 0, (2,), late), (3, "failure", 1, 0, 1, (), None), (4, "partial_success", 3, 2, 1, (), None), (7, "failure", 2, 0, 1, (1,), late)]
    assert fed(pages.documents(spark.createDataFrame([], PAGE), 10)) == []


def test_a_stream_of_pages_gives_the_same_and_goes_on_after_a_restart(spark, tmp_path):
    rng = random.Random(1)
    arriving = []
    for doc in range(150):  # pages up to 20 seconds out of order; some missing, some too late, some twice
        for page in range(1, 5):
            if rng.random() < 0.85:
                at = 4 * doc + rng.choice([0, 10, 30, 90, 200]) + rng.randrange(10)
                arriving.append((at + rng.randrange(20), (doc, page, 4, when(at), rng.random() < 0.8)))
    arriving = [r for _, r in sorted(arriving, key=lambda x: x[0]) for _ in range(1 + (r[0] % 9 == 0))]
    folder, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"  # noqa: F811
    for part in range(3):  # a run of its own for each: the state lives in the checkpoint
        spark.createDataFrame(arriving[part * len(arriving) // 3 : (part + 1) * len(arriving) // 3], PAGE).coalesce(1).write.mode("append").parquet(str(folder))
        stream = pages.documents_stream(spark.readStream.schema(PAGE).parquet(str(folder)), 60, "30 seconds")
        stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(pages.DOCUMENT).parquet(str(out))
    assert got.count() == got.select("doc_id").distinct().count() > 50
    until = max(r[3] for r in arriving) - datetime.timedelta(seconds=30)
    want = pages.documents(spark.createDataFrame(arriving, PAGE), 60, F.lit(until))
    assert fed(got) == fed(want)
