"""Operator 10: removal of word spans that repeat across documents, by suffix automata of reference shards.

A window is 13 consecutive words. A word is removed if a window that covers it also starts in a document with a
smaller doc_id.

Two forms stand here. ``against`` is the plain one: a given reference (say, a benchmark), whose size is checked, is cut into
shards of a bounded number of words, the shards are broadcast, each worker makes their suffix automata, and all documents are
streamed through each: the matching statistics give the maximal spans of 13 words and more that the reference holds, too. Its
cost is documents times shards, which is right for a reference of fixed size.

``repeats`` serves where the corpus is its own reference, so that shards would grow with it. The work is dealt out by
minimisers: each window belongs to the least hash among its nine 5-word seeds, so equal windows of different documents always
meet; consecutive windows of one minimiser form a run of 13 to 21 words. Only runs whose minimiser occurs in at least two
documents go on (with random text, few). Their distinct texts are the reference, dealt to shards of a bounded number of
words; each shard is a suffix automaton whose states carry the least doc_id of their occurrences, and the shard's runs
stream through it: the matching statistics, cut to 13 words, give each window's least doc_id.

A minimiser with very many runs is taken apart: each of its windows is dealt by the window's own hash. Runs of equal
text are reduced to one before they are dealt, so copies and frequent passages weigh nothing. Minimisers, runs and the windows
of very frequent minimisers are told apart by 64-bit hashes of their words, copies of whole texts by 128 bits; within a shard
the words themselves are compared.

Null texts have no words. Rows of equal doc_id never remove from each other. A null doc_id counts as larger than all.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime
from .textscan import U64, column_bytes, stretches, windows, words

WINDOW, SEED = 13, 5
SPAN = WINDOW - SEED + 1
HOT_RUNS = 2000
SHARD_WORDS = 40_000
#: Words of a reference that is broadcast.
REFERENCE_WORDS = 2_000_000
WORD = r"[^\x20\x09-\x0D]+"
LAST = 2**63 - 1


def batch_runs(column: pa.Array):
    """(row, minimiser, text, first window, windows) of every run of an Arrow column of texts: consecutive windows of one
    document and one minimiser, at most SPAN in a run."""
    hashes, _, _, counts = words(*column_bytes(column))
    none = np.zeros(0, np.int64)
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return none, np.zeros(0, U64), np.zeros(0, U64), none, none
    base = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])  # windows that lie in one document
    seeds = windows(hashes, SEED)
    least = seeds[:n].copy()
    for k in range(1, SPAN):
        np.minimum(least, seeds[k : k + n], out=least)
    least = least[at]
    begins = np.ones(len(at), bool)
    begins[1:] = (least[1:] != least[:-1]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(begins)
    count = np.diff(np.concatenate([first, [len(at)]]))
    if (count > SPAN).any():  # a seed that repeats within the document
        parts = -(-count // SPAN)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, count = np.repeat(first, parts) + SPAN * k, np.minimum(np.repeat(count, parts) - SPAN * k, SPAN)
    start = at[first]
    row = doc[start]
    return row, least[first], stretches(hashes, start, start + count + WINDOW - 1), start - base[row], count


class Automaton:
    """A generalised suffix automaton over words; ``first`` is the least document of each state's occurrences."""

    def __init__(self):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [LAST]

    def add(self, text: list[str], doc: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for w in text:
            p = last
            q = nxt[p].get(w)
            if q is not None and length[q] == length[p] + 1:
                last = q
            else:
                if q is None:
                    cur = len(nxt)
                    nxt.append({})
                    length.append(length[p] + 1)
                    link.append(0)
                    first.append(LAST)
                    while p >= 0 and w not in nxt[p]:
                        nxt[p][w] = cur
                        p = link[p]
                    last = cur
                    q = nxt[p][w] if p >= 0 else -1
                    if q < 0:
                        link[cur] = 0
                    elif length[q] == length[p] + 1:
                        link[cur] = q
                    else:
                        link[cur] = self._clone(p, q, w)
                else:
                    last = self._clone(p, q, w)
            if doc < first[last]:
                first[last] = doc

    def _clone(self, p: int, q: int, w: str) -> int:
        new = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.first.append(LAST)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def finish(self) -> None:
        """Hands the least document of each state up its suffix links."""
        link, first = self.link, self.first
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if first[s] < first[link[s]]:
                first[link[s]] = first[s]

    def least(self, text: list[str], size: int = WINDOW) -> list[int]:
        """For each window of ``size`` words of ``text`` the least document that holds it (LAST: none)."""
        nxt, link, length = self.next, self.link, self.length
        s = matched = 0
        out = []
        for k, w in enumerate(text):
            while s and w not in nxt[s]:
                s = link[s]
                matched = length[s]
            if w in nxt[s]:
                s = nxt[s][w]
                matched += 1
            if matched >= size:
                while length[link[s]] >= size:
                    s = link[s]
                matched = min(matched, length[s])
            if k >= size - 1:
                out.append(self.first[s] if matched >= size else LAST)
        return out


def against(df: DataFrame, reference: DataFrame, key: str = "doc_id", text: str = "text", reference_id: str = "id", reference_text: str = "text", most_words: int = REFERENCE_WORDS) -> DataFrame:
    """(key, least array<long>) of every row: for each window of its text the least ``reference_id`` whose text holds it (LAST: none).

    The reference goes to all workers, so its size is checked: more than ``most_words`` words are refused."""
    spark = df.sparkSession
    runtime.tune(spark)
    size = reference.agg(F.sum(F.regexp_count(F.coalesce(F.col(reference_text), F.lit("")), F.lit(WORD)))).first()[0] or 0
    if size > most_words:
        raise ValueError(f"the reference has {size} words; at most {most_words} are broadcast")
    shards: list[list[tuple[int, bytes]]] = [[]]
    held = 0
    for i, t in reference.select(F.col(reference_id).cast("long"), reference_text).orderBy(reference_id).toLocalIterator():
        own = (t or "").encode().split()
        if held and held + len(own) > SHARD_WORDS:
            shards.append([])
            held = 0
        shards[-1].append((i, b" ".join(own)))
        held += len(own)
    sent = spark.sparkContext.broadcast(shards)

    def run(batches):
        automata = []
        for shard in sent.value:
            a = Automaton()
            for i, t in shard:
                a.add(t.split(b" "), i)
            a.finish()
            automata.append(a)
        for b in batches:
            out = []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                own = (t or b"").split()
                out.append(list(map(min, zip(*(a.least(own) for a in automata)))) if len(own) >= WINDOW else [])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], ["key", "least"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(runtime.lean(run), f"key {kind}, least array<bigint>").withColumnRenamed("key", key)


def _scan(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            row, h, c, first, size = batch_runs(b.column(2))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), b.column(0).take(at), b.column(1).take(at), pa.array(first.astype(np.int32)), pa.array(size.astype(np.int8))], ["h", "c", "id", "tag", "first", "size"])

    return docs.mapInArrow(runtime.lean(run), "h long, c long, id long, tag binary, first int, size byte")


def _texts(joined: DataFrame) -> DataFrame:
    """(h, c, off, id, hot, text) of the runs listed for each document; a hot one as single windows under their own
    hash, with ``off`` the window's place in the run."""
    names = ["h", "c", "off", "id", "hot", "text"]

    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in names]
            hs, cs, offs, ids, hots, texts = out
            for i, text, runs in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                own = text.split()  # at the same six bytes as everywhere here
                flat = b" ".join(own)
                stop = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
                begin = np.concatenate([[0], stop[:-1] + 1]).tolist()
                stop = stop.tolist()
                hashes = words(*column_bytes(pa.array([text])))[0] if any(x["hot"] for x in runs) else None
                for x in runs:
                    first, size = x["first"], x["size"]
                    if x["hot"]:
                        hs += windows(hashes[first : first + size + WINDOW - 1], WINDOW).view(np.int64).tolist()
                        texts += [flat[begin[p] : stop[p + WINDOW - 1]] for p in range(first, first + size)]
                        offs += range(size)
                    else:
                        texts.append(flat[begin[first] : stop[first + size + WINDOW - 2]])
                        hs.append(x["h"])
                        offs.append(0)
                    new = len(hs) - len(cs)
                    cs += [x["c"]] * new
                    ids += [i] * new
                    hots += [x["hot"]] * new
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(out, kinds)), pa.array(texts, pa.binary()).cast(pa.string())], names)

    return joined.select("id", "text", "runs").mapInArrow(runtime.lean(run), "h long, c long, off int, id long, hot boolean, text string")


def _shards(reference: DataFrame) -> DataFrame:
    """(h, c, least array<long>) of each distinct run (h, c, id, text), in shards of whole minimisers."""

    def run(batches):
        held: list[tuple] = []
        total, last = 0, None

        def flush():
            a = Automaton()
            texts = [x[3].split(" ") for x in held]
            for x, t in zip(held, texts):
                a.add(t, x[2])
            a.finish()
            out = [a.least(t) for t in texts]
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["h", "c", "least"])

        for b in batches:
            for x in zip(*(b.column(k).to_pylist() for k in range(4))):
                if total >= SHARD_WORDS and x[0] != last:
                    yield flush()
                    held, total = [], 0
                held.append(x)
                total += x[3].count(" ") + 1
                last = x[0]
        if held:
            yield flush()

    return reference.repartition(runtime.partitions(reference.sparkSession), "h").sortWithinPartitions("h").mapInArrow(runtime.lean(run), "h long, c long, least array<long>")


def _keyed(df: DataFrame, key: str, text: str) -> tuple[DataFrame, bool]:
    """``df`` with __id (null ids as LAST) and __tag: where ids repeat (the second value), the 128-bit digest of the row's text, so
    that only rows of equal id and text, which are treated alike, share both."""
    rows = df.withColumn("__id", F.coalesce(F.col(key).cast("long"), F.lit(LAST)))
    size = rows.agg(F.count("*").alias("n"), F.count_distinct("__id").alias("ids")).first()
    repeated = size["n"] != size["ids"]
    return rows.withColumn("__tag", F.unhex(F.md5(runtime.text_of(text))) if repeated else F.lit(b"")), repeated


def repeats(keyed: DataFrame, text: str, repeated: bool) -> tuple[DataFrame, DataFrame]:
    """(copies, cuts) with key (id, tag): ``copies`` are whole copies of a text of a smaller id, of which all
    is covered if a window fits in; ``cuts`` hold the first words of the windows to remove from the others.

    Where rows of an id and text are ``repeated``, one of them is looked at: all are treated alike.
    What is summed up for a key is a table before it is joined, so that Spark can split the join's large keys."""
    spark = keyed.sparkSession
    runtime.tune(spark)
    docs = keyed.select(F.col("__id").alias("id"), F.col("__tag").alias("tag"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if repeated:
        docs = runtime.save(docs.groupBy("id", "tag").agg(F.any_value("text").alias("text")), "docs")

    marks = runtime.save(docs.select("id", "tag", F.unhex(F.md5("text")).alias("mark")), "marks")
    first = runtime.save(marks.groupBy("mark").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi"), "first")
    copies = runtime.save(marks.join(first.hint("merge"), "mark").where("id > lo").select("id", "tag").distinct(), "copies")
    runtime.discard(marks, first)
    maybe = runtime.Sieve(copies, "id")
    fresh = maybe.failing(docs, "id").unionByName(maybe.passing(docs, "id").join(copies.hint("merge"), ["id", "tag"], "left_anti").select(docs.columns))

    found = _scan(fresh)
    shared = runtime.save(found.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("n")).where("lo < hi").select("h", (F.col("n") > HOT_RUNS).alias("hot")), "shared")
    runs = runtime.save(runtime.Sieve(shared, "h").passing(found, "h").join(shared.hint("merge"), "h"), "runs")
    runtime.discard(shared)

    of_text = runs.groupBy("h", "c").agg(F.min(F.struct("id", "tag", "first", "size", "hot")).alias("r"))
    listed = of_text.groupBy("r.id", "r.tag").agg(F.collect_list(F.struct("h", "c", "r.first", "r.size", "r.hot")).alias("runs"))
    listed = runtime.save(listed, "listed")
    work = runtime.save(_texts(runtime.Sieve(listed, "id").passing(docs, "id").join(listed.hint("merge"), ["id", "tag"])), "texts")
    runtime.discard(listed)

    cold = work.where("not hot").select("h", "c", "id", "text")
    hot = work.where("hot").groupBy("h").agg(F.min(F.struct("id", "text")).alias("m")).select("h", F.col("h").alias("c"), "m.id", "m.text")
    least = runtime.save(_shards(cold.unionByName(hot)), "least")

    of_run = work.select("h", F.when(F.col("hot"), F.col("h")).otherwise(F.col("c")).alias("k"), "c", "off").join(least.withColumnRenamed("c", "k"), ["h", "k"])
    of_text = runtime.save(of_run.groupBy("c").agg(F.flatten(F.transform(F.array_sort(F.collect_set(F.struct("off", "least"))), lambda x: x["least"])).alias("least")), "places")
    places = F.filter(F.transform("least", lambda x, k: F.when(x < F.col("id"), F.col("first") + k)), lambda x: x.isNotNull())
    cuts = runs.select("c", "id", "tag", "first").join(of_text.hint("merge"), "c").select("id", "tag", places.alias("at")).where(F.size("at") > 0)
    cuts = cuts.groupBy("id", "tag").agg(F.flatten(F.collect_list("at")).alias("cut"))
    cuts = runtime.save(cuts, "cuts")
    runtime.discard(runs, work, least, of_text, *([docs] if repeated else []))
    return copies, cuts


def _marked(n: int, cut) -> np.ndarray:
    gone = np.zeros(n + 1, np.int64)
    at = np.unique(np.asarray(cut, np.int64))
    np.add.at(gone, at, 1)
    np.add.at(gone, at + WINDOW, -1)
    return np.cumsum(gone[:-1]) > 0


def _cut_rows(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with __cut (first words of the windows to remove, or null) and __whole (a copy: all is covered)."""
    keyed, repeated = _keyed(df, key, text)
    copies, cuts = repeats(keyed, text, repeated)
    gone = copies.select("id", "tag", F.array().cast("array<int>").alias("cut"), F.lit(True).alias("whole")).unionByName(cuts.withColumn("whole", F.lit(False)))
    gone = runtime.save(gone.select(F.col("id").alias("__id"), F.col("tag").alias("__tag"), F.col("cut").alias("__cut"), F.col("whole").alias("__whole")), "gone")
    runtime.discard(copies, cuts)
    touched = runtime.Sieve(gone, "__id")
    none = touched.failing(keyed, "__id").withColumns({"__cut": F.lit(None).cast("array<int>"), "__whole": F.lit(False)})
    some = touched.passing(keyed, "__id").join(gone.hint("merge"), ["__id", "__tag"], "left").withColumn("__whole", F.coalesce("__whole", F.lit(False)))
    return none.unionByName(some.select(none.columns)).drop("__id", "__tag")


def _kept(n: int, cut, whole: bool) -> np.ndarray | None:
    """Which of ``n`` words stay; None: all."""
    if whole and n >= WINDOW:
        return np.zeros(n, bool)
    return ~_marked(n, cut) if cut else None


def report(df: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""

    def run(batches):
        for b in batches:
            count, removed, sha = [], [], []
            for text, cut, whole in zip(b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                own = (text or b"").split()  # at the same six bytes as everywhere here
                n = len(own)
                if (keep := _kept(n, cut, whole)) is not None:
                    own = list(compress(own, keep.tolist()))
                count.append(n)
                removed.append(n - len(own))
                sha.append(hashlib.sha256(b" ".join(own)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(count, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _cut_rows(df.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.select("doc_id", "text", "__cut", "__whole").mapInArrow(runtime.lean(run), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the covered words, and the white space after them, taken out of its texts; other texts as they were."""
    rows = _cut_rows(df, key, text)
    place = rows.columns.index(text)

    def run(batches):
        for b in batches:
            own = b.column(place).to_pylist()
            for k, (cut, whole) in enumerate(zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist())):
                if own[k] is None or not (cut or whole):
                    continue
                data = own[k].encode()
                _, s, _, _ = words(*column_bytes(pa.array([data])))
                keep = _kept(len(s), cut, whole)
                if keep is None:
                    continue
                s = np.append(s, len(data))
                edge = np.flatnonzero(np.diff(np.concatenate([[False], keep, [False]]).astype(np.int8)))
                own[k] = b"".join([data[s[x] : s[y]] for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())]).decode()
            arrays = [pa.array(own, pa.string()) if j == place else c for j, c in enumerate(b.columns[:-2])]
            yield pa.RecordBatch.from_arrays(arrays, b.schema.names[:-2])

    return rows.mapInArrow(runtime.lean(run), df.schema)
