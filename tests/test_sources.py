import gzip
import io
import tarfile
import zipfile

import pytest

from vellumflow.sources import formats, html, markup, office, reader, xmldocs
from vellumflow.sources.tree import grid, outline


def labels(tree):
    return [(x.label, x.text) for x in tree.items]


def archive(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


@pytest.mark.parametrize("start, first", [("", "1."), ("3", "3."), ("0", "1."), ("-2", "1."), ("x", "1."), ("10", "10.")])
def test_html_list_start(start, first):
    t = html.parse(f"<ol start='{start}'><li>a</li><li>b</li></ol>")
    assert [x.marker for x in t.items if x.label == "list_item"][0] == first


def test_html_layers_and_headings():
    t = html.parse("<title>T</title><nav>menu</nav><h1>Head</h1><p>one</p><h3>Sub</h3><p>two</p><footer><p>end</p></footer>")
    by = {x.text: x for x in t.items}
    assert by["T"].layer == by["menu"].layer == by["end"].layer == "furniture" and by["one"].layer == "body"
    assert by["Head"].label == "title" and by["Sub"].level == 2
    assert t.items[by["Sub"].parent].text == "header-2" and t.items[by["Sub"].parent].layer == "invisible"
    assert html.parse("<p>only</p>").items[0].layer == "body"


def test_html_inline_links_and_unclosed():
    t = html.parse('<p>a <b>b</b> <a href="../x">c</a></p><p><b>open<br><p>next</body>', "http://h/d/e/f")
    assert [(x.text, x.style, x.link) for x in t.items if x.label == "text"][:3] == [("a", None, None), ("b", "bold", None), ("c", None, "http://h/d/x")]
    assert {"open", "next"} <= set(" ".join(x.text or "" for x in t.items).split())
    assert html.parse("<div hidden>no</div><script>no</script>yes").items[0].text == "yes"


def test_html_tables():
    t = html.parse("<table><tr><th>a</th><th colspan=2>b</th></tr><tr><td rowspan='2'>1</td><td>2</td><td>3</td></tr><tr><td>4</td><td>5</td></tr></table>")
    assert grid(t.items[0].cells) == [["a", "b", "b"], ["1", "2", "3"], ["1", "4", "5"]]
    assert [c.column_header for c in t.items[0].cells] == [True, True, False, False, False, False, False]


def test_markdown():
    t = markup.markdown("# T\n\na **b** [c](u) `d` \\*e\n\n- x\n  1. y\n  2. z\n- w\n\n```py\ncode\n```\n\n| a | b |\n|--|--|\n| 1 | 2 |\n\n![cap](i.png)\n\n__________________")
    got = labels(t)
    assert got[0] == ("title", "T") and ("code", "code") in got and ("caption", "cap") in got
    assert [(x.text, x.marker) for x in t.items if x.label == "list_item"] == [("x", "-"), ("y", "1."), ("z", "2."), ("w", "-")]
    assert [x.style for x in t.items if x.text == "b"] == ["bold"] and [x.link for x in t.items if x.text == "c"] == ["u"]
    assert grid(next(x for x in t.items if x.label == "table").cells) == [["a", "b"], ["1", "2"]]
    assert any(x.label == "table" for x in markup.markdown("# A\n\n<table><tr><td>x</td></tr></table>\n\n- b").items)


def test_separated_values():
    for d in ",;\t|":
        t = markup.separated(f'a{d}b{d}c\n1{d}"x{d}y"\n2{d}3{d}4{d}5\n')
        assert grid(t.items[0].cells) == [["a", "b", "c", ""], ["1", f"x{d}y", "", ""], ["2", "3", "4", "5"]]
    assert markup.separated("").items == []


def test_asciidoc():
    t = markup.asciidoc("= Doc\n\npara one\nline two\n\n== Sec\n\n* a\n** b\n* c\n\n. Cap\n.Table\n|===\n|x|y\n|1|2\n|===\n\nimage::p.png[Alt]\n")
    got = labels(t)
    assert ("text", "para one line two") in got and ("caption", "Table") in got and ("caption", "Alt") in got
    assert [x.depth for x in t.items if x.label == "list_item" and x.text in "abc"] == [3, 4, 3]


def test_webvtt():
    assert markup.seconds("01:02.500") == 62.5 and markup.seconds("123:00:00.000") == 442800 and markup.seconds("00:60.000") is None and markup.seconds("0:01.000") is None
    t = markup.webvtt("WEBVTT\n\nNOTE x\n\nid\n00:01.000 --> 00:02.000\n<v.loud Bob>Hi <i>there</i>\n\n00:05.000 --> 00:04.000\nbad\n\n00:06.000 --> 00:07.000\nplain &amp; simple")
    assert [x[1] for x in labels(t) if x[0] == "text"] == ["id", "00:01.000 --> 00:02.000", "Bob (loud): ", "Hi", "there", "00:06.000 --> 00:07.000", "plain & simple"]
    with pytest.raises(ValueError):
        markup.webvtt("no")


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{}</Relationships>'
REL = '<Relationship Id="{}" Type="http://x/{}" Target="{}"/>'


def word():
    p = lambda text, style="", num="": f'<w:p><w:pPr>{f"<w:pStyle w:val=\'{style}\'/>" if style else ""}{f"<w:numPr><w:ilvl w:val=\'{num[0]}\'/><w:numId w:val=\'{num[1]}\'/></w:numPr>" if num else ""}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'
    tc = lambda text, pr="": f"<w:tc><w:tcPr>{pr}</w:tcPr>{p(text)}</w:tc>"
    frac = "<m:oMath><m:f><m:num><m:r><m:t>a</m:t></m:r></m:num><m:den><m:sSup><m:e><m:r><m:t>π</m:t></m:r></m:e><m:sup><m:r><m:t>2</m:t></m:r></m:sup></m:sSup></m:den></m:f></m:oMath>"
    body = p("My Title", "Title") + p("Intro", "Heading1") + f'<w:p><w:r><w:rPr><w:b/></w:rPr><w:t>bold</w:t></w:r><w:r><w:t> plain</w:t></w:r></w:p><w:p>{frac}</w:p>' + p("one", num="01") + p("deep", num="12") + p("two", num="01")
    body += f'<w:tbl><w:tr>{tc("h1", "<w:gridSpan w:val=\'2\'/>")}</w:tr><w:tr>{tc("a", "<w:vMerge w:val=\'restart\'/>")}{tc("b")}</w:tr><w:tr>{tc("", "<w:vMerge/>")}{tc("c")}</w:tr></w:tbl><w:tbl><w:tr>{tc("framed")}</w:tr></w:tbl>'
    numbering = f'<w:numbering {W}><w:abstractNum w:abstractNumId="0"><w:lvl w:ilvl="0"><w:numFmt w:val="decimal"/></w:lvl></w:abstractNum><w:abstractNum w:abstractNumId="1"><w:lvl w:ilvl="1"><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="0"/></w:num><w:num w:numId="2"><w:abstractNumId w:val="1"/></w:num></w:numbering>'
    return archive({"word/document.xml": f"<w:document {W}><w:body>{body}</w:body></w:document>", "word/numbering.xml": numbering, "word/_rels/document.xml.rels": RELS.format(REL.format("h", "header", "header1.xml")), "word/header1.xml": f"<w:hdr {W}>{p('running head')}</w:hdr>"})


def test_word():
    t = office.docx(word())
    got = labels(t)
    assert got[:2] == [("title", "My Title"), ("section_header", "Intro")] and ("formula", r"\frac{a}{\pi ^{2}}") in got
    assert [(x.text, x.marker, x.depth) for x in t.items if x.label == "list_item"] == [("one", "1.", 3), ("deep", "", 4), ("two", "2.", 3)]
    assert grid(next(x for x in t.items if x.label == "table").cells) == [["h1", "h1"], ["a", "b"], ["a", "c"]]
    assert ("text", "framed") in got and t.items[-1].layer == "furniture" and [x.style for x in t.items if x.text == "bold"] == ["bold"]


def slides():
    a = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sp = lambda kind, paras: f'<p:sp><p:nvSpPr><p:nvPr><p:ph type="{kind}"/></p:nvPr></p:nvSpPr><p:txBody>{paras}</p:txBody></p:sp>'
    para = lambda t, pr="": f"<a:p>{pr}<a:r><a:t>{t}</a:t></a:r></a:p>"
    auto = "<a:pPr><a:buAutoNum type='arabicPeriod'/></a:pPr>"
    cell = lambda t, x="": f"<a:tc {x}><a:txBody>{para(t)}</a:txBody></a:tc>"
    tree = sp("title", para("Deck")) + sp("body", para("x", auto) + para("y", auto)) + f'<p:graphicFrame><a:graphic><a:tbl><a:tr>{cell("h", "gridSpan=\'2\'")}{cell("", "hMerge=\'1\'")}</a:tr><a:tr>{cell("1")}{cell("2")}</a:tr></a:tbl></a:graphic></p:graphicFrame><p:pic/>'
    return archive({"ppt/presentation.xml": f'<p:presentation {a}><p:sldIdLst><p:sldId r:id="s1"/></p:sldIdLst></p:presentation>', "ppt/_rels/presentation.xml.rels": RELS.format(REL.format("s1", "slide", "slides/slide1.xml")), "ppt/slides/slide1.xml": f"<p:sld {a}><p:cSld><p:spTree>{tree}</p:spTree></p:cSld></p:sld>", "ppt/slides/_rels/slide1.xml.rels": RELS.format(REL.format("n", "notesSlide", "../notesSlides/n1.xml")), "ppt/notesSlides/n1.xml": f"<p:notes {a}>{sp('body', para('a note'))}</p:notes>"})


def test_slides():
    t = office.pptx(slides())
    got = labels(t)
    assert got[:2] == [("chapter", "slide-0"), ("title", "Deck")] and [(x.text, x.marker) for x in t.items if x.label == "list_item"] == [("x", "1."), ("y", "2.")]
    assert grid(next(x for x in t.items if x.label == "table").cells) == [["h", "h"], ["1", "2"]]
    assert got[-1] == ("text", "a note") and t.items[-1].layer == "furniture"


def book():
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    c = lambda ref, v: f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
    one = f'<worksheet {s}><dimension ref="A1:XFD1048576"/><sheetData><row r="1">{c("A1", "h")}</row><row r="2">{c("A2", "1")}{c("B2", "2")}</row><row r="9"><c r="F9" t="s"><v>0</v></c></row></sheetData><mergeCells><mergeCell ref="A1:B1"/></mergeCells></worksheet>'
    return archive({"xl/workbook.xml": f'<workbook {s}><sheets><sheet name="S1" r:id="a"/><sheet name="S2" state="hidden" r:id="b"/></sheets></workbook>', "xl/_rels/workbook.xml.rels": RELS.format(REL.format("a", "worksheet", "worksheets/s1.xml") + REL.format("b", "worksheet", "worksheets/s2.xml")), "xl/worksheets/s1.xml": one, "xl/worksheets/s2.xml": f"<worksheet {s}><sheetData><row r='1'>{c('A1', 'secret')}</row></sheetData></worksheet>", "xl/sharedStrings.xml": f"<sst {s}><si><t>far</t></si></sst>"})


def test_spreadsheet():
    t = office.xlsx(book())
    tables = [x for x in t.items if x.label == "table"]
    assert [grid(x.cells) for x in tables] == [[["h", "h"], ["1", "2"]], [["far"]], [["secret"]]]
    assert [x.layer for x in tables] == ["body", "body", "invisible"] and office.address("AB12") == (11, 27)


ARTICLE = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//NLM//DTD JATS//EN" "JATS-archivearticle1.dtd"><article><front><article-meta><title-group><article-title>A <italic>study</italic></article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Doe</surname><given-names>J</given-names></name><xref ref-type="aff" rid="a1"/><xref ref-type="aff" rid="zz"/></contrib></contrib-group><aff id="a1"><label>1</label>Lab &eacute;</aff>
<abstract><p>Short.</p></abstract></article-meta></front><body><sec><title>Intro</title><p>Text.</p><sec><title>Deep</title><table-wrap><label>T1</label><table><tr><th>a</th></tr><tr><td>1</td></tr></table></table-wrap></sec></sec></body>
<back><ref-list><ref id="r"><element-citation><name><surname>Roe</surname><given-names>K</given-names></name><article-title>Paper.</article-title><source>J</source><year>2001</year><volume>3</volume><fpage>4</fpage><lpage>5</lpage></element-citation></ref></ref-list></back></article>"""


def test_article():
    t = xmldocs.jats(ARTICLE)
    got = labels(t)
    assert got[:5] == [("title", "A study"), ("text", "J Doe"), ("text", "Lab é"), ("section_header", "Abstract"), ("text", "Short.")]
    assert [(x.text, x.level) for x in t.items if x.label == "section_header"] == [("Abstract", 1), ("Intro", 1), ("Deep", 2), ("References", 1)]
    assert got[-1] == ("list_item", "Roe K. Paper. J (2001) 3:4-5") and ("caption", "T1") in got


def test_patents():
    t = xmldocs.patent('<?xml version="1.0"?><!DOCTYPE us-patent-grant SYSTEM "x.dtd" [ ]><us-patent-grant><invention-title>Widget</invention-title><abstract><p>Ab H<sub>2</sub>O</p></abstract><description><heading>FIELD</heading><p>Text <b>b</b>.</p></description><claims><claim><claim-text>1. A thing.</claim-text></claim></claims></us-patent-grant>')
    assert labels(t) == [("title", "Widget"), ("section_header", "ABSTRACT"), ("text", "Ab H₂O"), ("section_header", "FIELD"), ("text", "Text b."), ("section_header", "CLAIMS"), ("text", "1. A thing.")]
    a = xmldocs.patent("PATN\nTTL  Old\n     widget\nABST\nPAL  Short.\n##STR1##\nBSUM\nPAC  FIELD\nPAR  One\n     two\nCLMS\nNUM  1.\nPAR  1. A thing\n")
    assert [x[1] for x in labels(a)] == ["Old widget", "ABSTRACT", "Short.", "FIELD", "One two", "CLAIMS", "1. 1. A thing"]


def test_oasis_table():
    x = xmldocs._root('<table><tgroup cols="2"><colspec colname="a" colwidth="10pt"/><colspec colname="b" colwidth="20pt"/><thead><row><entry namest="a" nameend="b">H</entry></row></thead><tbody><row><entry morerows="1">x</entry><entry>y</entry></row><row><entry>z</entry></row></tbody></tgroup><tgroup cols="1"><colspec colname="1" colwidth="30pt"/><tbody><row><entry>wide</entry></row><row><entry/></row></tbody></tgroup></table>')
    assert grid(xmldocs.oasis_table(x)) == [["H", "H"], ["x", "y"], ["x", "z"], ["wide", "wide"]]


def test_fixed_layout_and_scans():
    assert xmldocs.positions("g 3 2.5 1", 5) == [2.5, 2.5, 2.5, 1.0, 0.0]
    obj = lambda box, t: f'<TextObject Boundary="{box}" Size="4"><TextCode X="0" Y="0">{t}</TextCode></TextObject>'
    ns = 'xmlns="http://www.ofdspec.org/2016"'
    content = archive({"OFD.xml": f"<OFD {ns}><DocBody><DocRoot>Doc_0/Document.xml</DocRoot></DocBody></OFD>", "Doc_0/Document.xml": f'<Document {ns}><Pages><Page ID="1" BaseLoc="Pages/P0.xml"/></Pages></Document>', "Doc_0/Pages/P0.xml": f"<Page {ns}>{obj('0 0 8 4', 'Hel')}{obj('8 0 8 4', 'lo')}{obj('30 0 8 4', 'World')}{obj('0 40 8 4', 'Next')}</Page>"})
    assert [x.text for x in xmldocs.ofd(content).items] == ["Hello World", "Next"]
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as tar:
        for name, text in {"m.mets.xml": '<mets xmlns:x="l"><fileGrp USE="coordOCR"><file ID="F1"><FLocat x:href="p1.html"/></file></fileGrp><div ORDER="1"><fptr FILEID="F1"/><fptr FILEID="no"/></div></mets>', "p1.html": "<span class='ocrx_word' title='bbox 1 2 3 4; x_wconf 90'>Word</span>"}.items():
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    assert labels(xmldocs.mets(out.getvalue())) == [("chapter", "page 1"), ("text", "Word")]
    assert xmldocs.hocr("<span class='ocrx_word' title='bbox 1 2 3 4; x_wconf 90'>W</span>") == [("W", (1, 2, 3, 4), 0.9)]
    assert formats.detect("x.tar.gz", out.getvalue()) == "mets_gbs" and gzip.decompress(out.getvalue())


def test_detection():
    cases = [("a.bin", word(), "docx"), ("a", slides(), "pptx"), ("a", book(), "xlsx"), ("x.pdf", b"%PDF-1.4", "pdf"), ("x", b"\x89PNG..", "image"), ("x.html", b"hello", "html"), ("x", b"<!-- c --><html>", "html"), ("x.xml", ARTICLE.encode(), "xml_jats"), ("x", b"PATN\r\n", "xml_uspto"), ("x", b"WEBVTT\n", "vtt"), ("x.md", b"# a", "md"), ("x", b"a,b\n1,2\n", "csv"), ("x", b"plain", None), ("x.json", b"{}", "json_tree")]
    assert [formats.detect(n, c) for n, c, _ in cases] == [k for _, _, k in cases]


def test_saved_tree():
    doc = '{"body": {"children": [{"$ref": "#/texts/0"}]}, "texts": [{"label": "title", "text": "T", "children": [{"$ref": "#/tables/0"}]}], "tables": [{"label": "table", "data": {"table_cells": [{"start_row_offset_idx": 0, "start_col_offset_idx": 0, "text": "x"}]}}]}'
    t = reader.parse("json_tree", doc)
    assert outline(t) == "item-0 at level 0: title: T\n  item-1 at level 1: table" and grid(t.items[1].cells) == [["x"]]
    with pytest.raises(ValueError):
        reader.parse("json_tree", "{}")


def test_items_leave_a_worker_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    from vellumflow.sources import reader

    ran, df = [], spark.createDataFrame([(1, "x")], "doc_id long, content string")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: ran.append(f) or self)
    reader.items(df, "html")
    page = "<body>" + "<p>some words</p>" * 50 + "</body>"
    batch = pa.RecordBatch.from_pydict({"key": list(range(300)), "content": [page] * 300, "format": ["html"] * 300, "base": pa.nulls(300, pa.string())})
    sizes = [b.num_rows for b in ran[0](iter([batch]))]
    assert sum(sizes) >= 300 * 50 and max(sizes) < reader.BATCH_ITEMS + 100
