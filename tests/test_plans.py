import pytest

from vellumflow.plans.options import AcceleratorOptions, PipelineOptions
from vellumflow.sources import doctags
from vellumflow.sources.tree import grid


def test_options():
    assert PipelineOptions().key() == PipelineOptions().key() != PipelineOptions(do_code_enrichment=True).key()
    assert AcceleratorOptions().resolved(("cpu", "mps")) == "mps" and AcceleratorOptions(device="cuda:1").resolved() == "cpu"
    with pytest.raises(ValueError):
        AcceleratorOptions(device="tpu")


def test_tagged_output():
    page = "<doctag><section_header_level_1><loc_1><loc_2><loc_3><loc_4>Head</section_header_level_1><text>para</text><unordered_list><list_item>a</list_item><list_item>b</list_item></unordered_list><otsl><ched>h<lcel><nl><fcel>1<fcel>2<nl><ucel><fcel>3<nl></otsl><picture><caption>cap</caption></picture><page_footer>7</page_footer></doctag><end_of_utterance>junk"
    t = doctags.parse(page)
    assert [(x.label, x.text) for x in t.items] == [("section_header", "Head"), ("text", "para"), ("list", "list"), ("list_item", "a"), ("list_item", "b"), ("table", None), ("picture", None), ("caption", "cap"), ("page_footer", "7")]
    assert grid(t.items[5].cells) == [["h", "h"], ["1", "2"], ["1", "3"]] and t.items[-1].layer == "furniture"
    assert doctags.boxes("<loc_0><loc_250><loc_500><loc_500>", 100, 200) == (0, 100, 100, 200) and doctags.boxes("<loc_1>", 1, 1) is None


def test_pages_of_answers():
    t = doctags.pages(["```markdown\n# A\n\nx\n```", "- b", None], "markdown")
    assert [(x.label, x.text, x.page) for x in t.items] == [("title", "A", 1), ("text", "x", 1), ("list", "list", 2), ("list_item", "b", 2)]
    assert t.items[3].parent == 2 and len(doctags.pages(["<text>a</text>", "<text>b</text>"]).items) == 2


def test_command_line(spark, tmp_path, capsys):
    from vellumflow import cli

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("# A")
    (tmp_path / "in/b.dat").write_text("?")
    assert cli.main([str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--to", "md", "outline"]) == 1
    assert capsys.readouterr().out.strip() == "1 failure, 1 success"
    assert spark.read.parquet(str(tmp_path / "out/md")).first()["markdown"] == "# A"


def test_sql_functions(spark):
    from vellumflow.plans import sql

    sql.register(spark)
    spark.createDataFrame([(1, "md", "# A\n\nb"), (2, "csv", "a,b\n1,2"), (3, "none", "x")], "id int, kind string, content string").createOrReplaceTempView("docs_in")
    got = spark.sql("SELECT id, label, text, error FROM docs_in, LATERAL parse_document(kind, content)").collect()
    assert sorted((r["id"], r["label"], r["text"]) for r in got if r["error"] is None) == [(1, "text", "b"), (1, "title", "A"), (2, "table", None)]
    assert [r["id"] for r in got if r["error"]] == [3]
    assert spark.sql("SELECT detect_format('x.html', encode('x', 'utf-8'))").first()[0] == "html"


def test_timeout(spark, tmp_path):
    from vellumflow.plans.convert import DocumentConverter

    (tmp_path / "a.md").write_text("# A")
    r = DocumentConverter(spark, document_timeout=-1.0).convert_all(str(tmp_path))
    assert [(x["status"], x["error"]) for x in r.documents.collect()] == [("partial_success", "document timeout exceeded")] and r.items.count() == 1


def test_pictures():
    import struct

    from vellumflow.sources import images

    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 30, 20)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 20, 30) + b"\0" * 9
    entry = lambda tag, v: struct.pack("<HHII", tag, 4, 1, v)
    ifd = lambda w, nxt: struct.pack("<H", 2) + entry(256, w) + entry(257, 20) + struct.pack("<I", nxt)
    tiff = b"II*\x00" + struct.pack("<I", 8) + ifd(30, 38) + ifd(31, 0)
    assert images.frames(png) == images.frames(jpeg) == [(30, 20)] and images.frames(tiff) == [(30, 20), (31, 20)]
    assert images.frames(b"BM" + b"\0" * 16 + struct.pack("<ii", 30, -20)) == [(30, 20)] and images.frames(b"GIF89a" + struct.pack("<HH", 30, 20)) == [(30, 20)]
    assert [(x.label, x.page) for x in images.parse(tiff).items] == [("chapter", 1), ("picture", 1), ("chapter", 2), ("picture", 2)]


def test_split_options():
    from vellumflow.plans.options import split_list
    from vellumflow.sources.xmldocs import text_width

    assert split_list("html,md;docx") == ("html", "md", "docx") and split_list("") == ("",) and split_list(None) is None
    assert text_width("abc", 10) == 18.0 and text_width("", None) == pytest.approx(3.6) and text_width("ab", -1) == pytest.approx(7.2)
