"""Names in texts: found by a dictionary, numbered by first sight within their kind, replaced.

A dictionary is (name, label). Where names overlap in a text, the leftmost counts, of those that begin together the longest, and the next
begins after its end. Found by one automaton over all names (Aho-Corasick), whatever their number.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vellumflow.functions.ranks import running

#: Letters of names in one automaton (an automaton takes some 100 bytes for each); a larger dictionary is taken in shards.
SHARD_LETTERS = 2_000_000


def normal_name(name: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(name, r"\s+", " "))


def normal_label(label: Column) -> Column:
    """Small letters, digits and underscores; 'pii' if nothing is left."""
    plain = F.regexp_replace(F.lower(label), r"[^a-z0-9_]+", "_")
    bare = F.regexp_replace(plain, r"^_+|_+$", "")
    return F.when(F.coalesce(bare, F.lit("")) != "", bare).otherwise("pii")


def normal_label_sql(label: str) -> str:
    bare = f"regexp_replace(regexp_replace(lower({label}), '[^a-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g')"
    return f"CASE WHEN coalesce({bare}, '') <> '' THEN {bare} ELSE 'pii' END"


def leftmost_longest(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of (begin, end) those that count."""
    out, free = [], 0
    for begin, end in sorted(found, key=lambda x: (x[0], -x[1])):
        if begin >= free:
            out.append((begin, end))
            free = end
    return out


def _matcher(names: list[str]):
    """text -> all (begin, end) of names in it, of those that begin together only the longest."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for name in names:
        automaton.add_word(name, len(name))
    automaton.make_automaton()

    def match(text: str) -> list[tuple[int, int]]:
        longest: dict[int, int] = {}
        for last, size in automaton.iter(text) if names else ():
            begin = last + 1 - size
            longest[begin] = max(longest.get(begin, 0), last + 1)
        return list(longest.items())

    return match


def _shards(dictionary: DataFrame) -> tuple[int, DataFrame]:
    """(how many, (name, shard)): the distinct names in shards of about SHARD_LETTERS letters, of which a task holds one at a time."""
    names = dictionary.select("name").where("name <> ''").distinct()
    n = max(1, -(-(names.agg(F.sum(F.length("name"))).first()[0] or 0) // SHARD_LETTERS))
    return n, names.withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(n)))


def spans(texts: DataFrame, dictionary: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, begin, stop, name) of the names in each text, in code points; null texts hold none. Where the dictionary takes several
    shards, every text meets each of them, and what they find is settled for each key (so keys have to differ then)."""
    spark, kind = texts.sparkSession, texts.schema[key].dataType.simpleString()
    n, names = _shards(dictionary)
    rows = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text IS NOT NULL")
    schema = f"key {kind}, begin int, stop int, name string"

    def pass_over(sent, settle: bool) -> DataFrame:
        def run(batches):
            match = _matcher(sent.value)
            for b in batches:
                keys, begins, stops, found = [], [], [], []
                for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    hits = match(t)
                    for begin, stop in leftmost_longest(hits) if settle else hits:
                        keys.append(k)
                        begins.append(begin)
                        stops.append(stop)
                        found.append(t[begin:stop])
                yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(begins, pa.int32()), pa.array(stops, pa.int32()), pa.array(found, pa.string())], ["key", "begin", "stop", "name"])

        return rows.mapInArrow(run, schema)

    parts = [pass_over(spark.sparkContext.broadcast(sorted(r["name"] for r in names.where(F.col("shard") == k).collect())), n == 1) for k in range(n)]
    if n == 1:
        return parts[0].withColumnRenamed("key", key)
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    listed = every.groupBy("key").agg(F.collect_set(F.struct("begin", "stop")).alias("hits"))

    def settle(batches):
        for b in batches:
            out = [leftmost_longest([(h["begin"], h["stop"]) for h in hits]) for hits in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([[{"begin": x, "stop": y} for x, y in o] for o in out], pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32())])))], ["key", "hits"])

    settled = listed.mapInArrow(settle, f"key {kind}, hits array<struct<begin:int,stop:int>>").select("key", F.inline("hits"))
    return settled.join(every.distinct(), ["key", "begin", "stop"]).select(F.col("key").alias(key), "begin", "stop", "name")


def stable_ids(mentions: DataFrame, order: list[str]) -> DataFrame:
    """(name, label, stable_id): every name once, with the label of its first mention in ``order`` (ties: the lesser label) and a number
    that counts the names of that label by their first mentions, as in 'person-3'. A label of any number of names is ranked in ranges."""
    first = mentions.groupBy("name").agg(F.min(F.struct(*order, "label")).alias("f")).select("name", *(F.col(f"f.{c}").alias(f"__{n}") for n, c in enumerate(order)), "f.label")
    ranked = running(first, ["label"], [*(f"__{n}" for n in range(len(order))), "name"], name="rank")
    return ranked.select("name", "label", F.concat_ws("-", "label", (F.col("rank") + 1).cast("string")).alias("stable_id"))


def replaced(texts: DataFrame, found: DataFrame, ids: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``texts`` with every span of ``found`` as its name's stable id. Spans of a key are joined with its texts, so keys have to differ."""
    new = found.join(ids.select("name", "stable_id"), "name").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("begin", "stop", "stable_id"))).alias("__spans"))
    rows = texts.join(new, key, "left")
    add = lambda acc, x: F.named_struct(F.lit("at"), x["stop"], F.lit("out"), F.concat(acc["out"], F.substr(F.col(text), acc["at"] + 1, x["begin"] - acc["at"]), x["stable_id"]))
    whole = F.aggregate("__spans", F.named_struct(F.lit("at"), F.lit(0), F.lit("out"), F.lit("")), add, lambda acc: F.concat(acc["out"], F.substr(F.col(text), acc["at"] + 1)))
    return rows.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(whole)).drop("__spans")


def merged(spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, begin, stop, n): spans of equal keys that overlap or touch as one, with how many it is made of."""
    w = Window.partitionBy(*keys).orderBy("begin", "stop")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.withColumn("__new", F.when(F.col("begin") <= reach, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*keys, "__run").agg(F.min("begin").alias("begin"), F.max("stop").alias("stop"), F.count("*").alias("n")).drop("__run")
