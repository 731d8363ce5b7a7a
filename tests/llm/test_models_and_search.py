import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm import cases
from tests.llm.test_text_operators import brute_components, brute_removed, brute_spans
from vellumflow.llm import labelled, quality, topk, toxicity

import random


def labelled_corpus(n=900, seed=4):
    """Toxic documents hold one of a few words in one sentence; poor ones shout or repeat."""
    rng = random.Random(seed)
    bad = ["vermin", "rotter", "cretin", "wretch"]
    rows, labels = [], []
    for k in range(n):
        toxic, poor = rng.random() < 0.3, rng.random() < 0.3
        sentences = [cases.prose(rng, rng.randint(4, 12)).replace("\n", " ").replace(".", "") + "." for _ in range(rng.randint(1, 12))]
        if toxic:
            j = rng.randrange(len(sentences))
            w = sentences[j].split(" ")
            w.insert(rng.randrange(len(w)), rng.choice(bad))
            sentences[j] = " ".join(w)
        text = " ".join(sentences)
        if poor:
            text = text.upper() if k % 2 else " ".join(x for x in text.split(" ") for _ in range(3))
        rows.append((k, text))
        labels.append((k, int(not poor), int(toxic)))
    return rows, labels


def test_fold(spark):
    df = spark.createDataFrame([(k,) for k in range(300)], "doc_id long").select("doc_id", labelled.fold().alias("f"))
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 4 for r in df.collect())


@pytest.mark.parametrize("module, column", [(toxicity, 2), (quality, 1)])
def test_held_out_accuracy(spark, module, column):
    rows, labels = labelled_corpus()
    docs, marks = cases.frame(spark, rows + [(5000, None), (5001, ""), (None, "x")]), spark.createDataFrame(labels + [(7777, None, None)], "doc_id long, quality int, toxic int")
    got = module.report(docs, marks).collect()
    assert len(got) == len(rows) + 3
    by = {r["doc_id"]: r for r in got}
    held = [(by[x[0]]["predicted"], x[column]) for x in labels if by[x[0]]["held_out"]]
    assert len(held) > 100 and np.mean([p == y for p, y in held]) > 0.93
    assert all(r["predicted"] == int(r["score"] >= module.THRESHOLD) and 0 <= r["score"] <= 1 for r in got)
    assert by[5000]["score"] == by[5001]["score"]


def test_offending_sentences(spark):
    rows, labels = labelled_corpus()
    model = toxicity.train(pa.array([t for _, t in rows]), np.array([x[2] for x in labels]))
    text = "Ü kan lomi ture. You vermin, listen.\nAnother lon kar."
    r = toxicity.score(cases.frame(spark, [(1, text)]), model).collect()[0]
    assert [text[slice(*map(int, s.split(":")))] for s in r["offending"].split(",")] == ["You vermin, listen."]
    assert toxicity.score(cases.frame(spark, [(1, text)]), None).collect()[0]["score"] == 0
    assert toxicity.train(pa.array(["a", "b"]), np.array([1, 1])) is None


def test_sentences_in_pieces(monkeypatch):
    from vellumflow.llm import textscan

    rows, labels = labelled_corpus(200)
    texts = pa.array([t for _, t in rows])
    model = quality.train(texts, np.array([x[1] for x in labels]))
    poison = toxicity.train(texts, np.array([x[2] for x in labels]))
    long = pa.array([*texts.to_pylist(), "\n".join(t for _, t in rows), " ".join(t for _, t in rows)])

    def toxic(column):
        none = np.zeros(len(column))
        for f, sentence, first, _, doc in toxicity.scan(column):
            none += np.bincount(doc, np.log1p(-poison.sentence_scores(f, sentence, len(first))), len(column))
        return none

    whole, bags = model.scores(long), toxic(long.slice(0, 201))
    monkeypatch.setattr(textscan, "PIECE_BYTES", 300)
    assert np.allclose(whole, model.scores(long))
    monkeypatch.setattr(textscan, "PIECE_BYTES", 1 + max(len(t.encode()) for _, t in rows))  # no line is longer
    assert np.allclose(bags, toxic(long.slice(0, 201)))


def brute_top(vectors, k, every):
    ints = {i: np.floor(64 * np.asarray(v, np.float64)) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in ints:
        if q % every == 0:
            n = lambda a, b: int(sum(x * y for x, y in zip(a, b)))
            best = sorted((-n(ints[q], v), i) for i, v in ints.items() if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("shard, block, seed", [(4096, 8192, 4096), (37, 3, 64), (150, 8192, 10)])
def test_top_k(spark, monkeypatch, shard, block, seed):
    rng = np.random.default_rng(1)
    vectors = [(int(i), [float(x) for x in np.float32(rng.normal(size=10) * rng.choice([0.1, 1, 5]))]) for i in range(300)]
    for i in range(40, 80):
        vectors[i] = (i, vectors[40][1])
    vectors[3], vectors[4], vectors[5], vectors[6] = (3, None), (4, [None] + [1.0] * 9), (5, [float("nan")] * 10), (6, [float("inf")] * 10)
    vectors[7] = (7, [0.5, 0.25])
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SEED", seed)
    monkeypatch.setattr(topk, "POSTINGS", 4)
    df = spark.createDataFrame([(*v, 1.0, "x") for v in vectors], "vec_id long, embedding array<float>, score double, v string").repartition(3)
    assert sorted(tuple(r) for r in topk.top_k(df, 20, 20).collect()) == brute_top(vectors, 20, 20)
    few = spark.createDataFrame(vectors[20:25], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_k(few).collect()) == brute_top(vectors[20:25], 20, 20)
    assert topk.top_k(df.limit(0)).count() == 0
    again = spark.createDataFrame(vectors[18:120] + vectors[20:22], "vec_id long, embedding array<float>")  # a query's row twice, a candidate's twice
    got = [tuple(r) for r in topk.top_k(again, 5, 20).collect()]
    assert len(got) == 5 * len({i for i, _ in vectors[18:120] if i % 20 == 0}) and [r[:2] for r in sorted(got)] == [(q, r) for q in range(20, 120, 20) for r in range(1, 6)]


def test_postings_are_traversed_in_part():
    rng = np.random.default_rng(2)
    ids, vectors = np.arange(4000), np.floor(rng.normal(size=(4000, 6)) * np.array([600, 20, 20, 5, 5, 5]))
    q = np.floor(rng.normal(size=(3, 6)) * 60)
    shard = topk.Postings(vectors, ids)
    best = topk.Best(3, 5)
    met = []
    reached = shard.reached
    shard.reached = lambda *a: met.append(reached(*a)) or met[-1]
    topk.search_shard(q, np.array([-1, -1, -1]), shard, best)
    topk.search_shard(q, np.array([-1, -1, -1]), shard, best)  # theta is known now
    assert met and all(m is not None and len(m) < 1000 for m in met)
    for k in range(3):
        score = vectors @ q[k]
        want = sorted(zip(-score, ids))[:5]
        assert [(-s, i) for s, i in want] == list(dict.fromkeys(zip(best.score[k].tolist(), best.id[k].tolist())))[:5] or best.theta[k] >= -want[-1][0]


def test_large_components(spark):
    df = spark.createDataFrame([(20, [1e30, -0.5]), (21, [-1e30, 2.0**60])], "vec_id long, embedding array<double>")
    assert [r["v"] for r in topk.integers(df).orderBy("vec_id").collect()] == [[64e30, -32.0], [-64e30, 2.0**66]]


def plain_bucket(word, bits, salt):
    from vellumflow.llm.textscan import Prefix

    return int(Prefix(np.frombuffer(word, np.uint8)).buckets(np.array([0]), len(word), bits, salt)[0])


def test_toxicity_against_a_plain_scorer(spark):
    import re

    rows, labels = labelled_corpus(300)
    model = toxicity.train(pa.array([t for _, t in rows]), np.array([x[2] for x in labels]))
    outer, sigmoid = bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]), lambda z: 1 / (1 + np.exp(-z))

    def plain(text):
        none = 1.0
        for line in (text or "").split("\n"):
            for sentence in re.findall(r"(?:\S*[^\s.!?](?=\s|$)\s*|\s+)*(?:\S*[.!?](?=\s|$))?", line):
                own = sentence.split()
                total = 0.0
                for w in own:
                    b = toxicity.lowered(np.frombuffer(w.encode(), np.uint8)).tobytes()
                    for _ in range(4):  # at most four marks on either side
                        b = b[1:] if b[:1] and b[0] in outer else b
                        b = b[:-1] if b[-1:] and b[-1] in outer else b
                    if b:
                        total += model.weights[plain_bucket(b, toxicity.BITS, 1)]
                    total += sum(model.weights[plain_bucket(b[:k], toxicity.BITS, 100 + k)] for k in toxicity.PREFIXES if len(b) >= k)
                if own:
                    base = sigmoid(model.bias)
                    none *= 1 - max(0.0, (sigmoid(model.bias + total) - base) / (1 - base))
        return 1 - none

    texts = [*rows[:60], (9000, "You vermin! (Cretin), é wretch.\nrotter"), (9001, ""), (9002, None), (9003, "a. " * 5000 + "vermin"), (9003, rows[0][1])]
    got = toxicity.score(cases.frame(spark, texts), model).collect()
    assert sorted((r["doc_id"], round(r["score"], 6)) for r in got) == sorted((i, round(float(plain(t)), 6)) for i, t in texts)


def test_quality_against_a_plain_scorer(spark):
    rows, labels = labelled_corpus(300)
    model = quality.train(pa.array([t for _, t in rows]), np.array([x[1] for x in labels]))

    def plain(text):
        own, parts, last = (text or "").split(), [], None
        for w in own:
            parts.append(model.parts_of[plain_bucket(w.encode(), quality.BITS, 1)])
            parts.append(model.parts_of[quality.SAME[int(w == last)]])
            parts += [model.parts_of[plain_bucket(w[k : k + n].encode(), quality.BITS, 10 + n)] for n in quality.GRAMS for k in range(len(w) - n + 1)]
            last = w
        return 1 / (1 + np.exp(-((float(np.mean(parts, dtype=np.float64)) if parts else 0.0) + model.bias)))

    texts = [*rows[:60], (9000, "Ünïcödé wörd wörd 你好吗"), (9001, ""), (9002, None), (9003, "xy " * 4000)]
    got = {r["doc_id"]: r["score"] for r in quality.score(cases.frame(spark, texts), model).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-6 for i, t in texts)


def test_models_without_rows(spark):
    none, marks = cases.frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows, labels = labelled_corpus(40)
    for module in (toxicity, quality):
        assert module.report(none, marks).count() == 0 and module.report(none, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0
        got = module.report(cases.frame(spark, rows), marks).collect()
        assert len(got) == 40 and {r["score"] for r in got} == {0.0 if module is toxicity else 0.5}


def test_pipeline(spark, tmp_path):
    rows, labels = labelled_corpus(160)
    rows = rows + [(10_000 + i, t) for i, t in cases.documents(9)]
    cases.frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        kept.append(len(after))
        texts, left = {r["doc_id"]: r["text"] for r in before}, {r["doc_id"]: r for r in after}
        assert len(left) == len(after) and left.keys() <= texts.keys()
        if k < 4:
            assert docs.columns == names
        if name == "toxicity":
            bad = {i for i, _, t in labels if t}
            gone = texts.keys() - left.keys()
            assert len(gone & bad) > 0.9 * len(bad) and len(gone - bad) < 0.03 * len(texts)
            assert all(left[i]["text"] == texts[i] for i in left)
        if name == "near_duplicates":
            assert left.keys() == {i for i, _, c in brute_components(list(texts.items())) if i == c}
        if name == "repeated_passages":
            want = {i: n - m for i, n, m, _ in brute_removed(list(texts.items()))}
            assert {i: len([w for w in (r["text"] or "").split() if w]) for i, r in left.items() if "é" * 9 not in (r["text"] or "")}.items() <= want.items()
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after)
        if name == "secrets":
            assert all((r["text"] == texts[i]) == (brute_spans(texts[i] or "")[2] == "") for i, r in left.items() if texts[i] is not None)
        if name == "packing":
            assert left.keys() == texts.keys()
    assert kept[0] < len(rows) and kept[1] < kept[0] and kept[4] == kept[1]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_stages_with_odd_rows(spark, tmp_path):
    rows, labels = labelled_corpus(60)
    odd = [*cases.with_odd_ids(cases.documents(3, 12)), (None, None), (None, None), (None, "a lone text of null id"), *rows]
    frame = cases.frame(spark, odd)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs, n in ((frame, len(odd)), (frame.limit(0), 0)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs.count()
            stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}")
            assert docs.columns == frame.columns if k < 4 else "slot" in docs.columns
            assert docs.count() <= before and (docs.count() == before or k < 2) and (docs.count() > 0) == (n > 0)
            if n and k < 4:
                assert docs.where("text = 'a lone text of null id'").count() == 1
