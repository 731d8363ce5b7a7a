from vellumflow.plans import chunk, generation
from vellumflow.sources import reader

TEXT = "# Doc\n\nintro text\n\n## Sec\n\n- a\n- b\n  - c\n\n![cap](i.png)\n\n| x | y |\n|---|---|\n| 1 | 2 |\n\nsome **bold** words\n\n## Other\n\nlast one"


def test_chunks(spark):
    items = reader.items(spark.createDataFrame([("d", TEXT)], "doc_id string, content string"), "md")
    h = chunk.hierarchical(items)
    got = [(r["text"], r["headings"], r["captions"]) for r in h.orderBy("chunk_no").collect()]
    assert got[0] == ("intro text", ["Doc"], []) and got[1] == ("- a\n- b\n- c", ["Doc", "Sec"], []) and got[2] == ("", ["Doc", "Sec"], ["cap"])
    assert got[3][0].startswith("|   x |") and got[4][0] == "some bold words" and got[5] == ("last one", ["Doc", "Other"], [])
    small = chunk.hybrid(h, 4).orderBy("chunk_no").collect()
    assert all(r["n_tokens"] <= 4 for r in small) and [r["chunk_no"] for r in small] == list(range(len(small)))
    large = chunk.hybrid(h, 1000).orderBy("chunk_no").collect()
    assert [r["headings"] for r in large] == [["Doc"], ["Doc", "Sec"], ["Doc", "Sec"], ["Doc", "Sec"], ["Doc", "Other"]]
    assert chunk.contextualize(h).orderBy("chunk_no").first()["context"] == "Doc\nintro text"


def test_documents_go_to_python_as_arrow_with_what_chunks_are_made_of(spark):
    rows = [("d", 1, -1, "text", "body", None, "b"), ("d", 0, -1, "section_header", "body", "## ", "h"), (None, 0, -1, "text", "body", None, "no id"), ("d", 2, -1, "text", "furniture", None, "no chunk"), ("e", 0, -1, "text", "furniture", None, "no chunk")]
    items = spark.createDataFrame(rows, "doc_id string, ord int, parent int, label string, layer string, marker string, text string").selectExpr("*", "CAST(NULL AS array<struct<r0: int>>) cells", "'kept out' orig")
    made = chunk.hierarchical(items)
    for df in (made, chunk.hybrid(made, 4)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroupsInArrow" in plan and "InPandas" not in plan and "kept out" not in plan
        assert sorted(map(tuple, df.select("doc_id", "chunk_no", "text", "item_refs", "n_tokens").collect()), key=str) == [("d", 0, "b", [1], 1), (None, 0, "no id", [0], 2)]


def test_generation():
    assert generation.template_prompt("x") == "x" and generation.template_prompt({"a": 1}) == '{\n  "a": 1\n}'

    class T:
        def __init__(self):
            self.b = 2

    assert generation.template_prompt(T) == generation.template_prompt(T()) == '{\n  "b": 2\n}'
    lines = ['data: {"choices": [{"delta": {"content": "he"}}]}', "", "data: nonsense", 'data: {"choices": [{"delta": {"content": "llo"}}]}', "data: [DONE]", 'data: {"choices": [{"text": "no"}]}']
    assert generation.streamed(lines) == "hello" and generation.streamed(lines, lambda t: t == "he") == "he"
    stop = generation.RepetitionStopper()
    block = lambda y, t="same": f"<text><loc_10><loc_{y}><loc_90><loc_{y + 5}>{t}</text>"
    assert stop(block(10) + block(20) + block(30)) and stop(block(10) * 3) and not stop(block(10) + block(20)) and not stop(block(10) + block(20) + block(90)) and not stop(block(10, "a") + block(20, "b") + block(30, "c"))
    assert list(generation.in_batches(range(5), 2)) == [[0, 1], [2, 3], [4]]
