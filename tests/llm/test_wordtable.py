"""Chunks of texts as numbers, and the table of what is known of them."""

import random

import numpy as np
import pyarrow as pa
import pytest

from vellumflow.llm import queries, wavelet, wordtable


def words(texts):
    return [[c for c in (t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if c] for t in texts]


def texts_of(rng, n):
    parts = ["a", "b", "ab", "a\0", "a\0\0", "x" * 8, "x" * 9, "x" * 16, "x" * 17, "x" * 16 + "y", "x" * 40, "é", "你好你好你好", "\x0b", "\xa0", " ", "  ", "\n", "\t", "\r", "'s", "1", "²", "<|endoftext|>", "Zz"]
    return [None if rng.random() < 0.05 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("collide", [False, True])
def test_divide(monkeypatch, collide):
    if collide:  # every hash is the same: all but one distinct chunk go through the dict
        monkeypatch.setattr(wordtable, "_MASK", np.zeros(9, np.uint64))
    rng = random.Random(1)
    for n in (0, 1, 2, 50):
        texts = texts_of(rng, n)
        d = wordtable.divide(pa.array(["before it", *texts, "and after"], pa.string()).slice(1, n))
        got = [[d.chunk(k).decode() for k in d.which[a:b]] for a, b in zip(d.of_text[:-1], d.of_text[1:])]
        assert collide or got == words(texts)
        assert (np.diff(d.keys[0].astype(object)) > 0).all()


def test_table():
    rng, asked = random.Random(2), []
    table = wordtable.Table(40)

    def learn(chunks):
        asked.extend(chunks)
        return [np.frombuffer(c.ljust(-(-len(c) // 4) * 4, b"\0"), "<u4").tobytes() for c in chunks]

    for _ in range(60):
        d = wordtable.divide(pa.array(texts_of(rng, 6) + [f"w{rng.randrange(200)} " * 3], pa.string()))
        begin, size = table.places(d, learn)
        for k in set(d.which.tolist()):
            assert table.ids[begin[k] : begin[k] + size[k]].tobytes().rstrip(b"\0") == d.chunk(k).rstrip(b"\0")
        assert len(table.begin) <= 40 + len(d.begin) and (np.diff(table.keys[0].astype(object)) > 0).all()
    assert len(set(asked)) < len(asked) < 2000  # some were forgotten and asked for again, most not


def test_ids_are_the_library_s(monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    path = queries.tokenizer_path()
    library = tokenizers.Tokenizer.from_file(path)
    monkeypatch.setattr(wavelet, "CHUNKS", 30)
    monkeypatch.setattr(wavelet, "ASKED", 7)
    encoder, rng = wavelet.ChunkEncoder(path), random.Random(3)
    for _ in range(30):
        texts = texts_of(rng, 20)
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder(texts)] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
