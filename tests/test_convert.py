import pytest
from pyspark.sql import functions as F

from tests.test_sources import ARTICLE, book, slides, word
from vellumflow.functions import text as T
from vellumflow.functions.geometry import Box
from vellumflow.operators import layout
from vellumflow.plans import chunk, plugins, serialize
from vellumflow.plans.convert import ConversionError, DocumentConverter, Limits, Result
from vellumflow.plans.options import LayoutOptions, PipelineOptions
from vellumflow.sources import formats, reader
from vellumflow.sources.tree import Tree
from vellumflow.streaming import stream


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("in")
    for name, content in {"a.docx": word(), "b.pptx": slides(), "sub/c.xlsx": book(), "d.xml": ARTICLE.encode(), "e.md": b"# T\n\n- a\n- b\n\n| x | n |\n|--|--|\n| y | 10 |\n", "f.html": b"<h1>H</h1><p>a &amp; <b>b</b></p>", "g.csv": b"a;b\n1;2\n", "bad.vtt": b"nothing", "h.dat": b"plain text", "~$a.docx": b"lock", "i.pdf": b"%PDF-1.4"}.items():
        path = top / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(content)
    return str(top)


def test_convert_files(spark, folder, tmp_path):
    r = DocumentConverter(spark).convert_all(folder)
    status = {x["file"]: (x["status"], x["error"]) for x in r.documents.collect()}
    assert len(status) == 10 and sum(s == "success" for s, _ in status.values()) == 7
    assert status["h.dat"] == ("failure", "format unknown") and status["bad.vtt"][0] == "failure" and "no parser" in status["i.pdf"][1]
    md = {x["file"]: x["markdown"] for x in r.documents.join(r.markdown(), "doc_id").collect()}
    assert md["e.md"] == "# T\n\n- a\n- b\n\n| x   |   n |\n|-----|-----|\n| y   |  10 |"
    assert md["f.html"] == "# H\n\na &amp; **b**"
    assert "running head" not in md["a.docx"] and "| h1   | h1   |" in md["a.docx"] and "secret" not in md["c.xlsx"]
    r.save(str(tmp_path))
    assert Result.load(spark, str(tmp_path)).items.count() == r.items.count()
    assert {x["status"]: x["count"] for x in r.export(str(tmp_path / "out"), ("md", "json", "text", "doctags", "html_split_page")).collect()} == {"success": 7, "failure": 3}
    assert spark.read.parquet(str(tmp_path / "out/json")).count() == 7
    assert r.tables().count() == 8 and r.outline().count() == 7
    assert r.html(split_pages=True).where("html LIKE '%<section>%'").count() > 3
    assert serialize.tagged(r.items).where("tagged LIKE '%<title>T</title>%'").count() == 1


def test_equal_files_and_plugged_parsers(spark, tmp_path):
    for name in ("a/x.md", "b/x.md"):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_bytes(b"# T\n\nhello world\n\n```\nx = 1\n```\n")
    (tmp_path / "c.pdf").write_bytes(b"%PDF-1.4 words")

    def pdf(content):
        tree = Tree()
        tree.add("text", text=bytes(content).decode()[9:])
        return tree

    options = PipelineOptions(do_code_enrichment=True, allow_external_plugins=True)
    r = DocumentConverter(spark, options=options, parsers={"pdf": pdf}, plugins={"code": lambda s: s.str.upper()}).convert_all(str(tmp_path))
    docs = r.documents.collect()
    assert len({x["doc_id"] for x in docs}) == 3 and len({x["hash"] for x in docs}) == 2 and {x["status"] for x in docs} == {"success"}
    md = {x["path"].rsplit("/", 2)[1]: x["markdown"] for x in r.documents.join(r.markdown(), "doc_id").collect()}
    assert md["a"] == md["b"] == "# T\n\nhello world\n\n```\nx = 1\n```" and "words" in md.values()
    assert {x["code"] for x in r.items.where("label = 'code'").collect()} == {"X = 1"}
    assert "MapInArrow" not in r.markdown()._jdf.queryExecution().toString()  # parsed once, when converted
    with pytest.raises(KeyError):
        DocumentConverter(spark, options=options).convert_all(str(tmp_path))
    with pytest.raises(PermissionError):
        DocumentConverter(spark, options=PipelineOptions(do_code_enrichment=True), plugins={"code": lambda s: s}).convert_all(str(tmp_path))


def test_markdown_of_lists_cells_and_breaks(spark):
    page = "<h1>T</h1><ul><li>a<ul><li>b_c</li></ul></li></ul><ol><li>d</li></ol><img alt='cap' src='x'><div>one<br>two</div><table><tr><th>A</th></tr><tr><td><p>p</p><ul><li>x</li><li><b>y</b></li></ul></td></tr></table>"
    df = spark.createDataFrame([(1, page, "Head\n====\n\nSub\n---\n\n```\na\n---\n```\n")], "id long, h string, m string")
    c = DocumentConverter(spark)
    want = ["# T", "- a\n    - b\\_c", "1. d", "cap", "<!-- image -->", "one", "two", "| A               |\n|-----------------|\n| p  - x - **y** |"]
    got = c.convert_string(df, "html", "h", "id").markdown().first()["markdown"].split("\n\n")
    assert got[:7] == want[:7] and "| p  - x - **y** |" in got[7]
    assert c.convert_string(df, "md", "m", "id").markdown().first()["markdown"] == "# Head\n\n## Sub\n\n```\na\n---\n```"


def test_sniffing_of_a_part():
    whole = word()
    assert formats.detect("x", whole[:8192], whole[-4000:]) == formats.detect("x", whole) == "docx"
    assert formats.detect("x.docx", whole[:8192], whole[-30:]) == "docx" and formats.detect("x", whole[:8192], whole[-30:]) is None
    assert formats.detect("a.xml", b"<?xml version='1.0'?><article><front/></article>") == "xml_jats"
    assert formats.detect("a.xml", b"<us-patent-grant lang='EN'/>") == "xml_uspto"


def test_tables_and_pieces(spark):
    df = spark.createDataFrame([(1, "| a | b |\n|---|---|\n| x, y | 2 |\n")], "id long, t string")
    t = DocumentConverter(spark).convert_string(df, "md", "t", "id").tables().first()
    assert t["csv"] == 'a,b\n"x, y",2\n' and t["html"] == "<table><tr><th>a</th><th>b</th></tr><tr><td>x, y</td><td>2</td></tr></table>"
    for text in ("a b c d e f g", "aaaaaaaa b", "", "a", "aaa aaa aaa"):
        got = list(chunk._pieces(text, 5, len))
        assert " ".join(got) == text and all(len(p) <= 5 or " " not in p for p in got)
        assert all(len(p + " " + q.split(" ")[0]) > 5 for p, q in zip(got, got[1:]))


def test_layout_options(spark):
    cells = spark.createDataFrame([(1, 0, "a", 0.9, 0.0, 0.0, 10.0, 10.0), (1, 1, "b", 0.8, 100.0, 0.0, 110.0, 10.0)], "page long, idx long, text string, confidence double, l double, t double, r double, b double")
    clusters = spark.createDataFrame([(1, 1, "text", 0.9, 0.0, 0.0, 12.0, 12.0), (1, 2, "text", 0.9, 200.0, 0.0, 212.0, 12.0)], "page long, cid long, label string, confidence double, l double, t double, r double, b double")
    n = lambda **o: sorted(r["cid"] for r in layout.postprocess(cells, clusters, 1e6, LayoutOptions(**o)).collect())
    assert n() == [1, 3] and n(create_orphan_clusters=False) == [1] and n(keep_empty_clusters=True) == [1, 2, 3] and n(skip_cell_assignment=True) == [1, 2]


def test_limits(spark, folder):
    c = DocumentConverter(spark, ("md", "pptx", "xlsx"))
    got = {x["file"]: x["status"] for x in c.convert_all(folder, Limits(max_num_pages=1)).documents.collect()}
    assert got["e.md"] == got["b.pptx"] == "success" and got["c.xlsx"] == "failure" and got["f.html"] == "skipped"
    first = c.convert_all(folder, Limits(page_range=(2, 2)))
    assert first.items.where("page = 1").count() == 0 and {x["error"] for x in first.documents.where("file = 'b.pptx'").collect()} == {"first page beyond the end"}
    small = c.convert_all(folder, Limits(max_file_size=5)).documents.where("error = 'file too large'")
    assert small.count() == 10 and small.where("doc_id IS NOT NULL").count() == 0
    with pytest.raises(ConversionError):
        c.convert_all(folder, raises_on_error=True)
    for bad in ((0, 1), (3, 2)):
        with pytest.raises(ValueError):
            Limits(page_range=bad)


def test_convert_strings(spark):
    df = spark.createDataFrame([(1, "# A\n\n`x` **y**"), (2, None), (3, "")], "id long, t string")
    r = DocumentConverter(spark).convert_string(df, "md", "t", "id")
    assert {x["doc_id"]: x["status"] for x in r.documents.collect()} == {1: "success", 2: "failure", 3: "success"}
    assert r.markdown().collect()[0]["markdown"] == "# A\n\n`x` **y**"
    with pytest.raises(ValueError):
        DocumentConverter(spark).convert_string(df, "csv", "t", "id")


def test_stream(spark, folder, tmp_path):
    q = stream.write(stream.convert_stream(stream.arriving(spark, folder, 3)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = reader.items(reader.inputs(reader.files(spark, folder)).where("status = 'pending'"))
    assert sorted(map(str, got.select("doc_id", "ord", "text", "error").collect())) == sorted(map(str, batch.select("doc_id", "ord", "text", "error").collect()))


def test_windowed_status(spark, tmp_path):
    e = spark.createDataFrame([(k, "a", f"2024-01-01 00:{k:02d}:00") for k in range(50)], "event_id long, event_type string, t string").select("event_id", "event_type", F.to_timestamp("t").alias("ts"))
    e.write.parquet(str(tmp_path / "e"))
    s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "e"))
    q = stream.windowed_status(s, window="10 minutes").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(x["n"], x["failed"]) for x in spark.table("w").collect()} == {(10, 1)}


def test_plugins(spark):
    r = plugins.Registry("ocr", allow_external=True)
    r.register("plain", lambda **o: ("plain", o))
    assert r.create("plain", lang="en") == ("plain", {"lang": "en"}) and r.first(("none", "plain"))[0] == "plain" and r.first(("none",)) is None
    with pytest.raises(ValueError):
        r.register("plain", print)
    with pytest.raises(PermissionError):
        plugins.Registry("ocr").register("x", test_plugins)
    with pytest.raises(ValueError):
        plugins.Registry("other")
    items = spark.createDataFrame([(1, "picture", "p"), (2, "text", "t"), (3, None, "n")], "ord int, label string, text string")
    got = plugins.enrich(items, F.col("label") == "picture", lambda s: s.str.upper(), "said").collect()
    assert {x["ord"]: x["said"] for x in got} == {1: "P", 2: None, 3: None}
    pages = spark.createDataFrame([(1, 1, '{"a": 1}'), (1, 2, "no"), (2, 1, "[]")], "doc_id long, page_no int, content string")
    done, docs = plugins.extract(pages, lambda s: s)
    assert {x["doc_id"]: x["status"] for x in docs.collect()} == {1: "failure", 2: "success"} and done.where("error IS NULL").count() == 2


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(T.web_clean(F.lit(" a​–‘“…"))) == " a-'\"..." and one(T.print_clean(F.lit(" ⁄•’ "))) == "/·'"
    assert one(T.vtt_seconds(F.lit("01:00:00.250"))) == 3600.25 and one(T.vtt_seconds(F.lit("1:00"))) is None
    assert one(T.quality(F.lit("fine"))) == 1.0 and one(T.quality(F.lit("GLYPH<1A>"))) == 0.0 and one(T.quality(F.lit("/G1/G22"))) == 0.0
    assert one(T.span_value(F.lit(" 12px"))) == 12 and one(T.span_value(F.lit("x"))) == 1 and one(T.private_use(F.lit("\ue000a"))) == 1


def test_rotation(spark):
    for angle, want in {0: (1, 2, 3, 5), 90: (2, 7, 5, 9), 180: (7, 15, 9, 18), 270: (15, 1, 18, 3)}.items():
        box = Box(*map(F.lit, (1.0, 2.0, 3.0, 5.0))).rotated(F.lit(angle), F.lit(10.0), F.lit(20.0))
        assert tuple(spark.range(1).select(*box.columns()).first()) == want
