"""Operator 12: how five filters interact: what each removes, alone and in any order of them.

Filters (a document fails): A under 200 words; B distinct words under half of the words; C capitals A-Z over 3 in 100 code points;
D holds any of #$%&*|; E equal to the text of a smaller doc_id, anywhere in the table. Words are stretches without ASCII white space.

A, B, C and D follow from a text alone. For E, texts are routed by their xxhash64: an RDD partitioned by that fingerprint, in which
each fingerprint has a chain of the full texts behind it and the least id of each. A text that meets an equal one of a smaller id is
emitted as failing, so in the end only those of the least id are left in the chains. Tasks do the same with what they read before
anything is routed, so that of a text with any number of copies a task sends one with the least id (again for each ROOM bytes of
texts that it holds); the others are known to fail, and travel as an id and a mask. The RDD has a partition for each ROOM bytes of
texts in the table, which are summed up first. Ids, not texts, are then joined with the labels, and
combineByKey adds up for each part the documents behind each of the 32 masks (number, good, toxic). All orders are read off those.

Null and empty texts are equal empty texts. A null doc_id is larger than all others; rows of equal or null doc_id are documents each
for itself, and of equal texts of one id none is smaller. A null lang counts as the empty string. Of several labels of an id, any that
says good (or toxic) counts; an id without labels is neither. An empty table has no parts and gives no rows. Columns besides doc_id,
text, lang, quality and toxic are not looked at.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import runtime

FILTERS = "ABCDE"
SAME = 1 << FILTERS.index("E")
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
CAPITALS, MARKS = bytes(range(65, 91)), b"#$%&*|"
#: Bytes of texts that a task holds before it sends on what it has, and that a partition of the RDD gets on average at most.
ROOM = 32 << 20
#: Sorts behind all ids.
LAST = 1 << 63


def failed(text: str) -> int:
    """The filters A to D that a text fails, as bits."""
    raw = text.encode()
    words = raw.split()  # of bytes: at x20 and x09 to x0D
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(raw) - len(raw.translate(None, CAPITALS))) > CAPITAL_PERCENT * len(text)) << 2
        | (len(raw.translate(None, MARKS)) < len(raw)) << 3
    )


class Chains:
    """For each fingerprint the texts behind it, each with its mask, the least id so far and how many rows of that id each part has."""

    def __init__(self):
        self.chains: dict[int, list[list]] = {}

    def meet(self, fingerprint: int, text: str, key: int, parts: dict[str, int], mask: int | None) -> tuple[bool, list[tuple[int, str, int, int]]]:
        """Whether the text is new here, and the rows (id, part, mask, number) that this meeting shows not to be least."""
        chain = self.chains.setdefault(fingerprint, [])
        link = next((x for x in chain if x[0] == text), None)
        if link is None:
            chain.append([text, failed(text) if mask is None else mask, key, parts])
            return True, []
        if key == link[2]:
            for part, n in parts.items():
                link[3][part] = link[3].get(part, 0) + n
            return False, []
        if key < link[2]:
            key, parts, link[2], link[3] = link[2], link[3], key, parts
        return False, [(key, part, link[1] | SAME, n) for part, n in parts.items()]

    def links(self) -> Iterator[tuple[int, list]]:
        for fingerprint, chain in self.chains.items():
            for link in chain:
                yield fingerprint, link


def _route(rows):
    """(where to, record): texts to their fingerprint, rows that are not least to anywhere."""
    chains, size, nulls = Chains(), 0, {}
    for key, part, fingerprint, text in rows:
        new, out = chains.meet(fingerprint, text, LAST if key is None else key, {part: 1}, None)
        for row in out:
            if row[0] == LAST:
                nulls[row[1:3]] = nulls.get(row[1:3], 0) + row[3]
            else:
                yield row[0], row
        size += len(text) if new else 0
        if size > ROOM:
            yield from chains.links()
            chains, size = Chains(), 0
    yield from chains.links()
    for k, ((part, mask), n) in enumerate(nulls.items()):
        yield k, (LAST, part, mask, n)


def _settle(records):
    """(id, part, mask, number) of all rows, once all texts of a fingerprint are here."""
    chains = Chains()
    for where, record in records:
        if isinstance(record, tuple):
            yield record
        else:
            text, mask, key, parts = record
            yield from chains.meet(where, text, key, parts, mask)[1]
    for _, (_, mask, key, parts) in chains.links():
        for part, n in parts.items():
            yield key, part, mask, n


def masks(documents: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): the rows of a table by the filters they fail."""
    spark = documents.sparkSession
    text = runtime.text_of()
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("lang", F.lit("")).alias("part"), F.xxhash64(text).alias("fingerprint"), text.alias("text")).rdd
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(runtime.partitions(spark), -(-size // ROOM))
    settled = rows.mapPartitions(_route).partitionBy(parts, lambda where: where % parts).mapPartitions(_settle)
    return spark.createDataFrame(settled.map(lambda r: (None if r[0] == LAST else r[0], *r[1:])), "doc_id long, part string, mask int, n long", verifySchema=False)


def counted(documents: DataFrame, labels: DataFrame):
    """An RDD of (part, counts): for each of the 32 masks the documents, good ones, toxic ones."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).cast("int").alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).cast("int").alias("toxic"))
    rows = masks(documents).join(known, "doc_id", "left").select("part", "mask", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))

    def add(counts, row):
        mask, n, good, toxic = row
        counts[mask] += (n, n * good, n * toxic)
        return counts

    def start(row):
        return add(np.zeros((1 << len(FILTERS), 3), np.int64), row)

    def merge(a, b):
        return a + b

    pairs = rows.rdd.map(lambda r: (r[0], tuple(r[1:])))
    return pairs.combineByKey(start, add, merge, runtime.partitions(documents.sparkSession), lambda part: zlib.crc32(part.encode()))


def orders(part: str, counts: np.ndarray) -> list[tuple]:
    """One row for each order of the filters and each step of it."""
    out, removed = [], {f: 0 for f in FILTERS}
    by_mask = np.arange(len(counts))
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            here = ((by_mask & before) == 0) & ((by_mask & bit) > 0)
            gone = counts[here].sum(0)
            kept, late = counts[(by_mask & (before | bit)) == 0, 0].sum(), counts[((by_mask & before) > 0) & ((by_mask & bit) > 0), 0].sum()
            out.append((part, "".join(order), step, int(kept), int(gone[0]), int(late), int(counts[bit, 0]), int(gone[1]), int(gone[2])))
            removed[name] += int(gone[0])
            before |= bit
    return [(*row, removed[row[1][row[2] - 1]]) for row in out]


SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and what the filter of that step removes, of every part, order and step."""
    found = counted(documents, labels).flatMap(lambda x: orders(*x))
    return documents.sparkSession.createDataFrame(found, SCHEMA, verifySchema=False)


def sql() -> str:
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT doc_id, part, (len(ws) < {LEAST_WORDS})::INTEGER + 2 * (100 * len(list_distinct(ws)) < {DISTINCT_PERCENT} * len(ws))::INTEGER
  + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * len(t))::INTEGER + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
  + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < coalesce(doc_id, 9223372036854775808::HUGEINT), false)::INTEGER AS mask FROM w),
m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM b a, b, b c, b d, b e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INTEGER AS before FROM o, range(1, 6) t(step)),
r AS (SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
  coalesce(sum(n) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
  coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""
