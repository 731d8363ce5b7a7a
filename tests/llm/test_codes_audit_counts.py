"""Operators 11, 12 and 13 against plain versions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumflow.llm import audit, lloyd, queries, tokencount

from . import cases

BYTES = "byte_bpe_50k.json"


# Operator 11


def plain_codes(rows, rounds=lloyd.ROUNDS, entries=lloyd.ENTRIES):
    """{row: (code, error)} and the final entries, by full scans in whole numbers."""
    kept = [(i, label, [int(np.floor(np.float64(x) * 1024)) for x in v]) for i, label, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max((len(v) for *_, v in kept), default=0) // 4) * 4
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    w = width // 4
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * w : p * w + w] for r in start] for p in range(4)]
    for last in [False] * rounds + [True]:
        near = [[min((sum((a - b) ** 2 for a, b in zip(r[2][p * w : p * w + w], e)), j) for j, e in enumerate(books[p])) for r in kept] for p in range(4)]
        if last:
            break
        for p in range(4):
            for j in range(len(books[p])):
                own = [r[2][p * w : p * w + w] for r, (_, k) in zip(kept, near[p]) if k == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    return [(i, label, "".join(f"{near[p][n][1]:02x}" for p in range(4)), sum(near[p][n][0] for p in range(4))) for n, (i, label, _) in enumerate(kept)], books


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, label, v in rows], "vec_id long, embedding array<double>, label int, code string, error string").repartition(3)


def held(spark, rows):
    want, books = plain_codes(rows)
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for part in books for e in part for x in e).encode()).hexdigest()
    got = [tuple(r) for r in lloyd.report(vectors(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(i, code, error, sums[label], digest) for i, label, code, error in want], key=str)


def test_codes(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "ENTRIES", 12)
    monkeypatch.setattr(plain_codes, "__defaults__", (lloyd.ROUNDS, 12))
    monkeypatch.setattr(lloyd, "BLOCK", 8 * 20)  # several blocks in a task
    rng = random.Random(3)
    rows = [(k, rng.choice([1, 2, None]), [rng.choice([-0.5, 0.25, 0.1, rng.gauss(0, 0.3)]) for _ in range(8)]) for k in range(150)]
    rows += [(7, 1, rows[9][2]), (None, 2, rows[11][2]), (None, None, rows[11][2]), (900, 1, None), (901, 1, [None] * 8), (902, 1, [float("nan")] * 8), (903, 1, [float("-inf")] + [0.0] * 7)]
    held(spark, rows)
    held(spark, [(k, 1, [0.125] * 8) for k in range(40)])  # all equal: one entry takes all


def test_codes_of_few_ragged_and_large_vectors(spark):
    held(spark, [(3, 1, [0.5, -0.5, 1.5]), (1, None, []), (2, 1, [0.1] * 6)])
    held(spark, [(3, 1, [90000.5, -90000.0, 1.5, 2.0]), (1, None, [1e-9, -1e-9, 0.0, 7.0]), (2, 1, [0.1] * 4)])  # beyond exact doubles
    held(spark, [(1, 1, []), (2, 1, [])])
    assert lloyd.report(vectors(spark, [(1, 1, None)])).count() == lloyd.report(vectors(spark, [])).count() == 0
    with pytest.raises(ValueError):
        lloyd.report(vectors(spark, [(1, 1, [1e30, 0.0, 0.0, 0.0])]))


def test_heaps_spare_scans(spark):
    """Once entries hardly move, hardly a part is popped; yet the assignment is that of full scans."""
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(3000, 1, 8)) + 40 * rng.normal(size=(1, 16, 8)))[np.arange(3000), rng.integers(0, 1, 3000)]
    x = np.floor(x * 1024).astype(np.int32)
    x[:1500] += 100_000
    books = lloyd.Codebooks(np.concatenate([x[:4], x[-4:]]))
    block, scanned = lloyd.Block(x, 8), []
    for _ in range(8):
        changes = np.zeros((4, 8, 3), np.int64)
        scanned.append(block.assign(books.entries.astype(float), books.drift, changes, float))
        packed = lloyd.Block(x, 8, block.packed())
        assert packed.heaps == block.heaps and (packed.own == block.own).all()
        block = packed
        for p in range(4):
            assert (lloyd.scan(x[:, 2 * p : 2 * p + 2].astype(float), books.entries[p].astype(float))[0] == block.own[p]).all()
        books.move(changes)
        for p, j in itertools.product(range(4), range(8)):
            own = x[block.own[p] == j, 2 * p : 2 * p + 2].astype(object)
            assert books.totals[p, j, 0] == len(own) and (len(own) == 0 or (books.totals[p, j, 1:] == own.sum(0)).all())
    assert scanned[0] == 12000 and scanned[-1] < scanned[0] / 2


# Operator 12


def plain_audit(docs, labels):
    big = 1 << 63
    least, good, toxic = {}, set(), set()
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", big), big if i is None else i)
    for i, q, x in labels:
        good |= {i} if q == 1 and i is not None else set()
        toxic |= {i} if x == 1 and i is not None else set()
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = [x for x in re.split("[ \t-\r]+", t) if x]
        bad = ("A" if len(w) < 200 else "") + ("B" if 100 * len(set(w)) < 50 * len(w) else "") + ("C" if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else "") + ("D" if any(c in "#$%&*|" for c in t) else "")
        rows.append((lang or "", bad + ("E" if least[t] < (big if i is None else i) else ""), i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        here = [r for r in rows if r[0] == part]
        shap = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = here
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shap[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in r[1] for r in here) - len(gone), sum(r[1] == f for r in here), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shap[order[step - 1]])
    return out


def audited(spark, docs, labels):
    d = spark.createDataFrame([(i, t, lang, "m", 1) for i, t, lang in docs], "doc_id long, text string, lang string, mask string, part int").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {tuple(r[:3]): list(r[3:]) for r in audit.report(d, lab).collect()}


@pytest.mark.parametrize("room", [audit.ROOM, 300])
def test_audit(spark, monkeypatch, room):
    monkeypatch.setattr(audit, "ROOM", room)
    rng = random.Random(4)
    texts = [t for _, t in cases.documents(5, 30)] + ["many " * 250, "AB# " * 250, " ".join(f"w{k}" for k in range(260)), " ".join(f"w{k}" for k in range(260)) + " $5"]
    docs = [(rng.choice([None, k % 37, k]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for k in range(400)]
    docs += [(None, "only null ids", "en")] * 30 + [(5, "one id, many rows", "en")] * 20
    labels = [(rng.randrange(400), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)] + [(None, 1, 1)]
    assert audited(spark, docs, labels) == plain_audit(docs, labels)


def test_audit_of_equal_fingerprints(monkeypatch):
    """Texts behind one fingerprint are told apart."""
    chains = audit.Chains()
    assert chains.meet(1, "a", 5, {"x": 1}, None) == (True, [])
    assert chains.meet(1, "b", 4, {"x": 1}, None) == (True, [])
    assert chains.meet(1, "a", 3, {"y": 2}, None) == (False, [(5, "x", audit.failed("a") | audit.SAME, 1)])
    assert chains.meet(1, "a", 9, {"y": 2}, None) == (False, [(9, "y", audit.failed("a") | audit.SAME, 2)])
    assert sorted(x[1][0] for x in chains.links()) == ["a", "b"]


def test_audit_sends_few_copies(spark):
    """However many copies, a task sends one text and ids."""
    sent = list(audit._route((k, "en", 7, "copy") for k in range(5000, 0, -1)))
    assert len(sent) == 5000 and sum(isinstance(r[1], list) for r in sent) == 1
    assert len(list(audit._route((None, "en", 7, "copy") for _ in range(5000)))) == 1


def test_audit_of_nothing(spark):
    assert audited(spark, [], []) == {}
    assert len(audited(spark, [(None, None, None)], [])) == 600


# Operator 13


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_path(BYTES)
    model = tokenizers.Tokenizer.from_file(path)
    return path, lambda text: len(model.encode(text or "", add_special_tokens=False).ids)


def test_counter(library):
    path, count = library
    tokens = tokencount.Counter(path)
    rng = random.Random(6)
    parts = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "1", "23", "²", "é", "你", "😀", "́", "‍", "\x85", "\xa0", " ", "\x1c", "<|endoftext|>", "<|", "--", "!"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert tokens.count(t) == count(t), t
    other = queries.tokenizer_path()
    import tokenizers

    model = tokenizers.Tokenizer.from_file(other)
    assert tokencount.Counter(other).count("Hello  <|endoftext|> World") == len(model.encode("Hello  <|endoftext|> World", add_special_tokens=False).ids)
    import sentencepiece

    other = queries.tokenizer_path("piece_bpe_32k.model")
    assert tokencount.Counter(other).count("Hello  World") == len(sentencepiece.SentencePieceProcessor(model_file=other).encode("Hello  World"))
    assert len({tokencount.version(queries.tokenizer_path(n)) for n in (BYTES, "word_bpe_49k.json", "piece_bpe_32k.model")}) == 3


def test_token_counts(spark, library):
    path, count = library
    rows = cases.with_odd_ids(cases.documents(8)) + [(9999, "long " * 2000)]
    got = [tuple(r) for r in tokencount.report(cases.frame(spark, rows), path).collect()]
    want = [(i, len((t or "").encode()), count(t), count(t) > 1024) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str) and any(w[3] for w in want)
    assert tokencount.report(cases.frame(spark, []), path).count() == 0


def test_cache(spark, library, tmp_path, monkeypatch):
    """What the cache holds is not encoded again; what it lacks is, once for each text, and appended."""
    path, count = library
    cache = tokencount.create(spark, f"file://{tmp_path}/cache")
    rows = cases.documents(9, 20)
    texts = {t or "" for _, t in rows}
    run = lambda r: sorted(((x["doc_id"], x["n_tokens"]) for x in tokencount.counts(cases.frame(spark, r).repartition(3), path, cache).collect()), key=str)
    assert run(rows) == sorted(((i, count(t)) for i, t in rows), key=str)
    entries = spark.read.parquet(cache)
    assert entries.count() == len(texts) and {r["version"] for r in entries.select("version").distinct().collect()} == {tokencount.version(path)}
    spark.createDataFrame([(tokencount.version(path), bytearray(hashlib.sha256(b"a new text").digest()), 77)], tokencount.CACHE).write.mode("append").partitionBy("version").parquet(cache)
    more = [*rows, (50001, "a new text"), (50002, "another"), (50003, "another")]
    assert dict(run(more))[50001] == 77  # taken from the cache
    assert spark.read.parquet(cache).count() == len(texts) + 2
    run(more)
    assert spark.read.parquet(cache).count() == len(texts) + 2
    entries = spark.read.parquet(cache)
    entries.where(F.col("n_tokens") == 77).write.mode("append").partitionBy("version").parquet(cache)
    assert len(run(more)) == len(more)  # an entry written twice counts once
    monkeypatch.setattr(tokencount, "version", lambda p: "another tokenizer")
    assert dict(run(more))[50001] == count("a new text") != 77


def test_pieces():
    tokens = tokencount.Counter.__new__(tokencount.Counter)
    tokens.whole, tokens.special, tokens.cuts = (lambda text: 1), (), True
    assert tokens.count("a b  c\n") == 5 and set(tokens) == {"a", " b", " ", " c", "\n"}
