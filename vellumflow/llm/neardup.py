"""Operator 8: exact join of documents by the Jaccard similarity of their word shingles, by token-combination prefixes.

Sets of equal shingles become one class first, so exact copies weigh nothing. In one order of all shingles, two sets of
sizes n and m whose overlap must reach need(n, m) = T(n + m) / (100 + T) can differ only in n - need of the first's
tokens, so a prefix of each suffices to find them. Three exact filters follow each other:

1. order by hash: each class sends its first n - ceil(Tn/100) + spare(n) shingles; of those that a linked class of m
   shingles sends too there are at least spare(m), so a class goes on if that many of its own occur in another class
   (all data take part; most classes end here);
2. document frequencies among those left: at least ceil(Tn/100) of a class's shingles must occur in another class;
3. order by frequency, rare first. Shingles up to RARE documents are indexed singly. More frequent ones are divided
   into sub-classes, prefixes are extended by one token for each sub-class, and pairs of tokens of one sub-class are
   indexed: j tokens of a sub-class cover j - 1 errors, so a prefix covers what it must. Each entry carries the largest
   partner size for which it is needed, which bounds what it can pair with.

Linked classes are found without emitting all pairs of a bucket: each class is first verified against the most central
class of its buckets, then against another one, then only pairs that are not yet in one component remain, and all of these
are verified. Nothing is capped. Shingles are compared by 64-bit hashes, sets by 128 bits; the texts themselves are not.

Null or blank texts have the empty set and link with nothing. Rows of equal doc_id are separate documents unless their
sets are equal. A null doc_id counts as larger than all and comes back as null.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from . import runtime
from .textscan import U64, column_bytes, mix, windows, words

WORDS, PERCENT = 5, 80
SPARE = 8
RARE = 64
COMBINED_FROM = 24
#: Rounds in which what is open in a bucket is held against one of its classes, before all that remain are.
LEADS = 1
LAST = 2**63 - 1
#: Entries that the index hands on at a time.
INDEX_ROWS = 50_000


def shingle_sets(column: pa.Array, size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: A-Z lower-cased, ``size`` words each, or all if fewer."""
    raw, at = column_bytes(column)
    hashes, _, _, counts = words(raw, at, lower=True)
    base = np.cumsum(counts) - counts
    out = []
    for b, n in zip(base.tolist(), counts.tolist()):
        own = hashes[b : b + n]
        if n >= size:
            own = np.unique(windows(own, size))
        elif n:
            own = mix(windows(own, n) + U64(n))
        out.append(own)
    return out


def least_overlap(n, percent: int):
    return -(-percent * n // 100)


def spare(n):
    """Shingles sent beyond the least number; more of them make the first filter stricter."""
    return SPARE + n // 7


def largest_partner(overlap, n, percent: int):
    """The largest m with need(n, m) <= overlap."""
    return (100 + percent) * overlap // percent - n


def band(n: int) -> int:
    """Bands of size: any two linked sets are in one or in neighbouring bands (for 80 percent and more)."""
    return int(np.floor(np.log(max(n, 1)) / np.log(1.25) + 1e-9))


def subclasses(g: int) -> int:
    """Sub-classes of frequent tokens in band g; 0: all tokens are indexed singly."""
    low = 1.25**g
    return 0 if low < COMBINED_FROM else max(1, int(low) // 10)


def signatures(n: int, tokens: np.ndarray, frequency: np.ndarray, percent: int):
    """(signature, largest partner size, errors covered before) of a set of ``n`` shingles.

    ``tokens`` are those that other sets have too, in the global order; the n - len(tokens) others come first in it.
    """
    private = n - len(tokens)
    errors = n - least_overlap(n, percent)
    for g in (band(n), band(n) - 1):
        parts = subclasses(g)
        covered = private
        seen: dict[int, list[int]] = {}
        for t, f in zip(tokens.tolist(), frequency.tolist()):
            if covered > errors:
                break
            most = largest_partner(n - covered, n, percent)
            if not parts or f <= RARE:
                yield t ^ (g * 0x9E3779B97F4A7C15 & (2**64 - 1)), most, covered
                covered += 1
                continue
            c = t % parts
            earlier = seen.setdefault(c, [])
            for e in earlier:
                yield (e * 0xC2B2AE3D27D4EB4F + t * 0x165667B19E3779F9 + g) & (2**64 - 1), most, covered
            covered += bool(earlier)
            earlier.append(t)


def _marks(s: np.ndarray) -> tuple[int, int]:
    """(s1, s2), the fingerprint of a set."""
    return int(mix(s).sum(dtype=U64).astype(np.int64)), int(mix(s ^ U64(0xA5A5A5A5A5A5A5A5)).sum(dtype=U64).astype(np.int64))


def _sets(docs: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for b in batches:
            n, one, two, prefix = [], [], [], []
            for s in shingle_sets(b.column(1)):
                n.append(len(s))
                s1, s2 = _marks(s)
                one.append(s1)
                two.append(s2)
                prefix.append(s[: len(s) - least_overlap(len(s), percent) + spare(len(s))].view(np.int64))
            at = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), lists], ["id", "n", "s1", "s2", "prefix"])

    return docs.mapInArrow(runtime.lean(run), "id long, n int, s1 long, s2 long, prefix array<long>")


def _whole_sets(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(2))
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], ["node", "n", "h"])

    return rows.select("node", "n", "text").mapInArrow(runtime.lean(run), "node long, n int, h array<long>")


def _own_sets(docs: DataFrame) -> DataFrame:
    """The set of each text beside its id and its fingerprint."""

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column(1))
            marks = [_marks(s) for s in sets]
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()), lists], ["id", "s1", "s2", "h"])

    return docs.select("id", "text").mapInArrow(runtime.lean(run), "id long, s1 long, s2 long, h array<long>")


def _index(tokens: DataFrame, percent: int) -> DataFrame:
    """Entries (sig, node, n, most, pos) of all sets. A batch of entries goes on as soon as it holds INDEX_ROWS, so that
    a worker never holds more than that and the entries of one set."""
    names = ["sig", "node", "n", "most", "pos"]
    kinds = "Qqiii"

    def run(batches):
        def full():
            arrays = [np.frombuffer(c, c.typecode) for c in held]
            arrays[0] = arrays[0].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in arrays], names)

        held = [array(k) for k in kinds]
        for b in batches:
            for i, n, listed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                listed = listed.values
                f, h = listed.field("f").to_numpy(), listed.field("h").to_numpy().view(U64)
                order = np.lexsort((h, f))
                before = len(held[0])
                for s, m, p in signatures(n, h[order], f[order], percent):
                    held[0].append(s)
                    held[3].append(m)
                    held[4].append(p)
                new = len(held[0]) - before
                held[1].extend([i] * new)
                held[2].extend([n] * new)
                if len(held[0]) >= INDEX_ROWS:
                    yield full()
                    held = [array(k) for k in kinds]
        yield full()

    return tokens.select("node", "n", "tokens").mapInArrow(runtime.lean(run), "sig long, node long, n int, most int, pos int")


def _verified(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose overlap suffices."""
    side = lambda x: tokens.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("tokens.h").alias(f"h{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("ha", "hb"))
    return both.where((100 + percent) * overlap >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def _pair(x: Column, y: Column):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def links(tokens: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes that join all that are linked, if not each single link."""
    empty = tokens.sparkSession.createDataFrame([], "a long, b long")
    entries = runtime.save(_index(tokens, percent), "index")
    # what is summed up for a signature is a table before it is joined, so that Spark can split the join's large keys
    central = runtime.save(entries.groupBy("sig").agg(F.min(F.struct("pos", "node", "n", "most")).alias("c"), F.count("*").alias("k")).where("k > 1"), "central")
    index = runtime.save(runtime.Sieve(central, "sig").passing(entries, "sig").join(central.hint("merge"), "sig"), "buckets")
    runtime.discard(entries, central)
    fits = (F.col("n") <= F.col("c.most")) & (F.col("c.n") <= F.col("most")) & (F.col("node") != F.col("c.node"))
    star = index.where(fits).select(*_pair(F.col("node"), F.col("c.node"))).distinct()
    found = runtime.save(_verified(star, tokens, percent), "star")

    for salt in range(LEADS + 1):
        comps = runtime.components(found)
        labelled = index.join(comps, "node", "left").select("sig", "node", "n", "most", F.coalesce("comp", "node").alias("comp"))
        labelled = runtime.save(labelled, "labelled")
        open_ = runtime.save(labelled.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("sig"), "signatures")
        left = runtime.save(runtime.Sieve(open_, "sig").passing(labelled, "sig").join(open_.hint("merge"), "sig"), "open")
        runtime.discard(labelled, open_)
        if left.isEmpty():
            break
        if salt < LEADS:  # against one class of each bucket, another one for each
            lead = runtime.save(left.groupBy("sig").agg(F.min(F.struct(F.xxhash64("node", "sig", F.lit(salt)).alias("x"), "node", "n", "most", "comp")).alias("c")), "leads")
            pairs = left.join(lead.hint("merge"), "sig").where((F.col("comp") != F.col("c.comp")) & (F.col("n") <= F.col("c.most")) & (F.col("c.n") <= F.col("most"))).select(*_pair(F.col("node"), F.col("c.node")))
        else:  # all that remain
            x, y = left.alias("x"), left.alias("y")
            pairs = x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.comp") < F.col("y.comp")) & (F.col("x.n") <= F.col("y.most")) & (F.col("y.n") <= F.col("x.most"))).select(*_pair(F.col("x.node"), F.col("y.node")))
        more = _verified(pairs.distinct(), tokens, percent)
        found, old = runtime.save(found.unionByName(more).unionByName(empty), "links"), found
        runtime.discard(old, left, comps, *([lead] if salt < LEADS else []))
    runtime.discard(index)
    return found


def _marked(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the size and the fingerprint of each row's set: __n, __s1, __s2."""

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column("__text"))
            marks = [_marks(s) for s in sets]
            more = [pa.array([len(s) for s in sets], pa.int32()), pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *more], [*b.schema.names[:-1], "__n", "__s1", "__s2"])

    schema = StructType([*rows.schema.fields, *(StructField(c, t) for c, t in (("__n", IntegerType()), ("__s1", LongType()), ("__s2", LongType())))])
    return rows.withColumn("__text", runtime.text_of(text)).mapInArrow(runtime.lean(run), schema)


def _labelled(df: DataFrame, percent: int, key: str, text: str) -> tuple[DataFrame, bool]:
    """(id, n, s1, s2, least) of every row, and whether ids are unique. ``least`` is the least (lo, s1, s2) of the row's
    component, one set of it even where ids repeat; null for empty sets."""
    spark = df.sparkSession
    runtime.tune(spark)
    docs = df.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = docs.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids")).first()
    unique = size["n"] == size["ids"]

    sets = runtime.save(_sets(docs, percent), "sets")
    first = runtime.save(sets.drop("prefix"), "marks")
    classes = first.where("n > 0").groupBy("s1", "s2").agg(F.min("id").alias("lo"), F.first("n").alias("n"))
    classes = runtime.save(classes.withColumn("node", F.col("lo") if unique else F.xxhash64("s1", "s2")), "classes")

    # 1: shingles of hash-ordered prefixes that occur in two classes
    others = first.join(classes.hint("merge"), ["s1", "s2"]).where("id > lo").select("id", "s1", "s2")
    others = runtime.save(others, "others")  # rows that another one stands for
    maybe = runtime.Sieve(others, "id")
    full = sets.where("n > 0")
    chosen = maybe.failing(full, "id").unionByName(maybe.passing(full, "id").join(others.hint("merge"), ["id", "s1", "s2"], "left_anti").select(full.columns))
    chosen = chosen.withColumn("node", F.col("id") if unique else F.xxhash64("s1", "s2"))
    if not unique:
        chosen = chosen.dropDuplicates(["node"])
    sent = chosen.select("node", F.explode("prefix").alias("h"))
    twice = runtime.save(sent.groupBy("h").agg(F.count("*").alias("k")).where("k > 1").select("h"), "twice")
    met = runtime.Sieve(twice, "h").passing(sent, "h").join(twice.hint("merge"), "h").groupBy("node").agg(F.count("*").alias("met"))
    overlap = F.expr(f"(n * {percent} + 99) div 100")  # the size of the smallest partner, too
    enough = F.least(F.lit(SPARE) + F.floor(overlap / 7), overlap)
    alive = runtime.save(met.join(classes, "node").where(F.col("met") >= enough).select("node", "n", F.col("lo").alias("id"), "s1", "s2"), "alive")
    runtime.discard(sets, others, twice)

    # 2: frequencies among the classes left
    texts = runtime.Sieve(alive, "id").passing(docs, "id")
    if unique:
        whole = _whole_sets(texts.join(alive.hint("merge"), "id")).where(F.size("h") == F.col("n"))
    else:  # an id does not name a text: each set goes to the class of its fingerprint
        own = _own_sets(texts).dropDuplicates(["id", "s1", "s2"])
        whole = own.join(alive.hint("merge"), ["id", "s1", "s2"]).select("node", "n", "h")
    whole = runtime.save(whole, "whole")
    each = whole.select("node", "n", F.explode("h").alias("h"))
    often = runtime.save(each.groupBy("h").agg(F.count("*").cast("int").alias("f")).where("f > 1"), "often")
    tokens = each.join(often.hint("merge"), "h").groupBy("node", "n").agg(F.collect_list(F.struct("f", "h")).alias("tokens"))
    tokens = runtime.save(tokens.where(F.size("tokens") >= F.expr(f"(n * {percent} + 99) div 100")), "tokens")
    runtime.discard(whole, often, alive)

    # 3: candidates, links, components
    linked = links(tokens, percent)
    comps = runtime.components(linked)
    runtime.discard(tokens, linked)
    least = comps.join(classes.select("node", F.struct("lo", "s1", "s2").alias("own")), "node").groupBy("comp").agg(F.min("own").alias("least"))
    of_class = classes.join(comps.join(least, "comp").select("node", "least"), "node", "left").select("s1", "s2", F.coalesce("least", F.struct("lo", "s1", "s2")).alias("least"))
    return first.select("id", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left").select("id", "n", "s1", "s2", "least"), unique


def near_duplicates(df: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n, comp) of every row: its set size and the least id of its component."""
    return _labelled(df, percent, key, text)[0].select("id", "n", F.coalesce("least.lo", "id").alias("comp"))


def keep_one(df: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component of ``df``, one with the least id; where several sets have that id, the one with the least
    fingerprint, and of its rows the one with the least text. Of empty texts, repeated rows of one id and text become one."""
    found, unique = _labelled(df, percent, key, text)
    kept = (F.col("id") == F.col("least.lo")) & (F.col("s1") == F.col("least.s1")) & (F.col("s2") == F.col("least.s2"))
    drop = runtime.save(found.where("n > 0").where(~kept).select(F.col("id").alias("__id"), F.col("s1").alias("__s1"), F.col("s2").alias("__s2")).distinct(), "drop")
    rows = df.withColumn("__id", F.coalesce(F.col(key).cast("long"), F.lit(LAST)))
    if unique:
        maybe = runtime.Sieve(drop, "__id")
        stay = maybe.passing(rows, "__id").join(drop.select("__id").hint("merge"), "__id", "left_anti")
        return maybe.failing(rows, "__id").unionByName(stay.select(rows.columns)).drop("__id")
    # an id does not name a row: those of repeated ids and of ids in ``drop`` are told apart by their sets
    again = rows.groupBy("__id").agg(F.count("*").alias("k")).where("k > 1").select("__id")
    maybe = runtime.Sieve(runtime.save(drop.select("__id").union(again), "again"), "__id")
    marked = _marked(maybe.passing(rows, "__id"), text)
    blank = F.when(F.col("__n") == 0, F.struct(key, text)).alias("__blank")
    one = marked.groupBy("__id", "__s1", "__s2", blank).agg(F.min_by(F.struct(*df.columns), runtime.text_of(text)).alias("__row"))
    stay = one.join(drop.hint("merge"), ["__id", "__s1", "__s2"], "left_anti").select("__row.*")
    return maybe.failing(rows, "__id").drop("__id").unionByName(stay)


def report(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    real = lambda c: F.when(F.col(c) < LAST, F.col(c))
    return near_duplicates(df).select(real("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), real("comp").alias("component_id"))
