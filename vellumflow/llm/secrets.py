"""Operator 1: secret scans with built-in functions only.

Three pattern kinds (assign, access, hex) are found leftmost and without overlap, each for itself. Besides them come
entropy spans: allow-listed placeholders (in either case) and the pattern spans are blanked out, and every run of 24 or more
token characters that is left is a candidate. Its class (hex, mixed, text) sets a threshold, and the Shannon entropy of
each window of 20 characters is followed along the run by incremental counts: the counts of the 67 token characters are held
packed in six numbers, and when the window moves, only the count of the character that leaves and of the one that enters
change, with their two terms c * log2(c). Terms are integers (millionths), so sums are exact. The span reaches from the
first window at or above the threshold to the last.

Null texts count as empty. Offsets are code points, end exclusive. Equal rows give equal results. Long runs are
followed in blocks, matches and spans in chunks, so the work stays near the length of the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three patterns and the least lengths.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)passw|secret|token|api_?key"
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed", "entropy_text")

WINDOW = 20
RUN = r"[A-Za-z0-9+/_=-]{24,}"
THRESHOLDS = {"hex": 3.0, "mixed": 3.75, "text": 4.15}
SCALE = 1_000_000
TERMS = [0] + [round(c * math.log2(c) * SCALE) for c in range(1, WINDOW + 1)]
MOST = {k: math.floor(WINDOW * (math.log2(WINDOW) - t) * SCALE) for k, t in THRESHOLDS.items()}
ALLOW = ("example", "sample", "placeholder", "changeme", "dummy", "xxxxxx", "000000", "1234567", "abcdefg", "deadbeef")
BLOCK = 512

#: The characters of a run, in the order of their counters; counters of 5 bits, twelve in a number.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
COUNTER_BITS, PER_NUMBER = 5, 12
NUMBERS = -(-len(LETTERS) // PER_NUMBER)
#: Matches or spans that are followed one by one; what is carried goes on from chunk to chunk.
CHUNK = 64

_SPAN = "array<struct<s:int,k:int,e:int>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _carried(rows: Column, start: Column, step, make, kind: str, bind=lambda chunk, carried: F.lit(0)) -> Column:
    """make(carried, x, bound) of every element x of ``rows``: what is carried is ``start`` at first and then step(carried, x).
    ``bound`` is bind(chunk, carried) of the chunk that x is in. Arrays grow only within a chunk."""
    none = F.expr(f"cast(array() as array<{kind}>)")

    def parts(chunks):
        heads = F.aggregate(chunks, F.struct(start.alias("at"), F.slice(F.array(start), 1, 0).alias("out")), lambda acc, c: F.struct(F.aggregate(c, acc["at"], step).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])
        follow = lambda c, at, bound: F.aggregate(c, F.struct(at.alias("at"), none.alias("out")), lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.array_append(acc["out"], make(acc["at"], x, bound)).alias("out")), lambda acc: acc["out"])
        return _let(heads, lambda h: F.flatten(F.zip_with(chunks, h, lambda c, at: _let(bind(c, at), lambda bound: follow(c, at, bound)))))

    cut = lambda r: F.transform(F.sequence(F.lit(0), F.floor((F.size(r) - 1) / CHUNK).cast("int")), lambda k: F.slice(r, k * CHUNK + 1, F.lit(CHUNK)))
    return _let(rows, lambda r: F.when(F.size(r) > 0, _let(cut(r), parts)).otherwise(none))


def _found(text: Column, hint: Column, pattern: str, make) -> Column:
    """make(array of struct<s, e, t>: start, end and match); where ``hint`` is false, there is no search."""
    rows = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda a, b: F.struct(F.length(a).alias("a"), b.alias("b")))
    size = lambda x: F.coalesce(F.length(x["b"]), F.lit(0))
    span = lambda at, x, _: F.struct((at + x["a"]).alias("s"), (at + x["a"] + size(x)).alias("e"), x["b"].alias("t"))
    all_of = _carried(rows, F.lit(0), lambda at, x: at + x["a"] + size(x), span, "struct<s:int,e:int,t:string>")
    return F.when(hint, make(F.filter(all_of, lambda x: x["t"].isNotNull())))


def _replaced(text: Column, spans: Column, mark: Callable[[Column, Column], Column]) -> Column:
    """``text`` with mark(reach, span) in place of each span, in order of their starts; reach is the largest end so far, and what
    lies before it is not written again. The text between is cut from the part that its chunk covers."""
    reach = lambda at, x: F.greatest(at, x["e"])
    part = lambda c, at: F.struct(F.substring(text, at + 1, F.greatest(F.array_max(F.transform(c, lambda x: x["e"])), at) - at).alias("t"), at.alias("at"))
    piece = lambda at, x, p: F.concat(F.substring(p["t"], at - p["at"] + 1, F.greatest(x["s"] - at, F.lit(0))), mark(at, x))
    end = F.array_max(F.transform(spans, lambda x: x["e"]))
    return F.concat(F.array_join(_carried(spans, F.lit(0), reach, piece, "string", part), ""), F.substring(text, end + 1, F.length(text)))


def _kind(rows: Column, kind: int) -> Column:
    return F.transform(rows, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def _term(n: Column) -> Column:
    return F.get(F.array(*map(F.lit, TERMS)), n)


def _best(run: Column, most: Column) -> Column:
    """struct<first, last>: the first and last window start (from 0) whose sum of terms is at most ``most``."""
    shift = lambda name, x, n: F.call_function(name, x, n.cast("int"))
    number, place = lambda c: F.floor(c / PER_NUMBER), lambda c: c % PER_NUMBER * COUNTER_BITS
    count = lambda w, c: shift("shiftright", F.get(w, number(c).cast("int")), place(c)).bitwiseAND(F.lit((1 << COUNTER_BITS) - 1).cast("long")).cast("int")
    changed = lambda w, c, by: F.transform(w, lambda v, k: F.when(k == number(c), v + shift("shiftleft", F.lit(by).cast("long"), place(c))).otherwise(v))
    state = lambda w, total, first, last: F.struct(w.alias("w"), total.alias("sum"), first.alias("first"), last.alias("last"))

    def enter(acc, c):
        n = count(acc["w"], c)
        return state(changed(acc["w"], c, 1), acc["sum"] + _term(n + 1) - _term(n), acc["first"], acc["last"])

    def leave(acc, c):
        n = count(acc["w"], c)
        return state(changed(acc["w"], c, -1), acc["sum"] + _term(n - 1) - _term(n), acc["first"], acc["last"])

    def block(b):
        part = F.substring(run, b * BLOCK + 1, F.lit(BLOCK + WINDOW - 1))
        codes = F.transform(F.split(part, ""), lambda c: F.instr(F.lit(LETTERS), c) - 1)
        begin = state(F.array_repeat(F.lit(0).cast("long"), NUMBERS), F.lit(0), F.lit(None).cast("int"), F.lit(None).cast("int"))

        def follow(code):
            def move(acc, k):
                inside = _let(enter(acc, F.get(code, k)), lambda x: F.when(k >= WINDOW, leave(x, F.get(code, k - WINDOW))).otherwise(x))
                at = (b * BLOCK + k - WINDOW + 1).cast("int")
                hit = lambda x: (k >= WINDOW - 1) & (x["sum"] <= most)
                return _let(inside, lambda x: state(x["w"], x["sum"], F.when(hit(x), F.least(x["first"], at)).otherwise(x["first"]), F.when(hit(x), at).otherwise(x["last"])))

            return F.aggregate(F.sequence(F.lit(0), F.length(part) - 1), begin, move, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

        return _let(codes, follow)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length(run) - 1) / BLOCK).cast("int")), block)
    return _let(blocks, lambda bs: F.struct(F.array_min(F.transform(bs, lambda x: x["first"])).alias("first"), F.array_max(F.transform(bs, lambda x: x["last"])).alias("last")))


def _entropy(runs: Column) -> Column:
    def one(x):
        t = x["t"]
        kind = F.when(t.rlike("^[0-9a-fA-F]+$"), F.lit(3)).when(t.rlike("[0-9]") & t.rlike("[A-Za-z]"), F.lit(4)).otherwise(F.lit(5))
        most = F.when(kind == 3, F.lit(MOST["hex"])).when(kind == 4, F.lit(MOST["mixed"])).otherwise(F.lit(MOST["text"]))
        return F.struct(x["s"].alias("s"), kind.alias("k"), _best(t, most).alias("w"))

    hits = F.filter(F.transform(runs, one), lambda x: x["w"]["first"].isNotNull())
    return F.transform(hits, lambda x: F.struct((x["s"] + x["w"]["first"]).alias("s"), x["k"].alias("k"), (x["s"] + x["w"]["last"] + WINDOW).alias("e")))


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def find(df: DataFrame, text: str = "text", base: str = "secret_base", added: str = "secret_added") -> DataFrame:
    """``df`` with two columns of spans array<struct<s, k, e>> (start, index into KINDS, end) in order; a column of ``df`` that has
    one of these names is replaced."""
    t, empty = F.coalesce(F.col(text), F.lit("")), F.expr(f"cast(array() as {_SPAN})")
    keep = lambda rows: F.filter(rows, lambda x: F.length(F.regexp_extract(x["t"], ASSIGN, 2)) >= ASSIGN_LEAST)
    assign = _found(t, t.rlike(ASSIGN_HINT), ASSIGN, lambda rows: _kind(keep(rows), 0))
    access = _found(t, t.contains("AKIA"), ACCESS, lambda rows: _kind(rows, 1))
    long_hex = _found(t, t.rlike(HEX), HEX, lambda rows: _kind(rows, 2))
    out = df.withColumns({"__assign": assign, "__access": access, "__hex": long_hex})
    out = out.withColumn(base, F.array_sort(F.concat(*(F.coalesce(F.col(c), empty) for c in ("__assign", "__access", "__hex")))))
    open_ = t
    for word in ALLOW:
        open_ = F.regexp_replace(open_, _either_case(word), " " * len(word))
    out = out.withColumn("__open", F.when(t.rlike(RUN), open_).otherwise(""))
    blank = lambda at, x: F.repeat(F.lit(" "), F.greatest(x["e"] - F.greatest(x["s"], at), F.lit(0)))
    out = out.withColumn("__open", F.when((F.size(base) > 0) & (F.col("__open") != ""), _replaced(F.col("__open"), F.col(base), blank)).otherwise(F.col("__open")))
    runs = _found(F.col("__open"), F.col("__open").rlike(RUN), RUN, _entropy)
    return out.withColumn(added, F.array_sort(F.coalesce(runs, empty))).drop("__assign", "__access", "__hex", "__open")


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(df: DataFrame) -> DataFrame:
    """doc_id, counts of the pattern kinds, base_sha256 and all spans of every whole text."""
    found = find(df.select("doc_id", "text"))
    n = lambda k: F.size(F.filter("secret_base", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(joined(F.col("secret_base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("secret_base", "secret_added"))).alias("spans"),
    )


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span replaced by ``mark`` (overlapping spans by one); nulls stay null."""
    found = find(df, text, "__base", "__added").withColumn("__spans", F.array_sort(F.concat("__base", "__added")))
    fresh = lambda at, x: F.when((x["s"] >= at) | (at == 0), F.lit(mark)).otherwise("")
    clean = found.withColumn(text, F.when(F.size("__spans") > 0, _replaced(F.col(text), F.col("__spans"), fresh)).otherwise(F.col(text)))
    return clean.drop("__base", "__added", "__spans")


def _sql_spans(pattern: str, kind: int, condition: str = "true", of: str = "d") -> str:
    p = pattern.replace("'", "''")
    return (
        f"SELECT doc_id, s, {kind} AS k, s + length(m) AS e, m FROM (SELECT doc_id, m, "
        f"(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))::BIGINT AS s FROM ("
        f"SELECT doc_id, string_split_regex(t, '{p}') AS p, ms, unnest(ms) AS m, generate_subscripts(ms, 1) AS i FROM (SELECT *, regexp_extract_all(t, '{p}', 0) AS ms FROM {of}))) WHERE {condition}"
    )


def sql() -> str:
    assign = ASSIGN.replace("'", "''")
    names = ", ".join(f"'{k}'" for k in KINDS)
    open_ = "t"
    for word in ALLOW:
        open_ = f"regexp_replace({open_}, '{_either_case(word)}', '{' ' * len(word)}', 'g')"
    join = "coalesce(string_agg(([{names}])[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER ({where}), '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT doc_id, s, k, e FROM ({_sql_spans(ASSIGN, 0, f"length(regexp_extract(m, '{assign}', 2)) >= {ASSIGN_LEAST}")})
  UNION ALL SELECT doc_id, s, k, e FROM ({_sql_spans(ACCESS, 1)}) UNION ALL SELECT doc_id, s, k, e FROM ({_sql_spans(HEX, 2)})),
opened AS (SELECT doc_id, {open_} AS t FROM d WHERE regexp_matches(t, '{RUN}')),
apart AS (SELECT doc_id, s, e, CASE WHEN s <= max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM base),
covered AS (SELECT doc_id, min(s) AS s, max(e) AS e FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM apart) GROUP BY doc_id, g),
gaps AS (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS p FROM covered),
blanked AS (SELECT o.doc_id, string_agg(substr(t, p + 1, s - p) || repeat(' ', e - s), '' ORDER BY s) || substr(any_value(t), max(e) + 1) AS t FROM opened o JOIN gaps USING (doc_id) GROUP BY o.doc_id
  UNION ALL SELECT doc_id, t FROM opened WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.doc_id = opened.doc_id)),
runs AS (SELECT doc_id, s, m, CASE WHEN regexp_full_match(m, '[0-9a-fA-F]+') THEN 3 WHEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') THEN 4 ELSE 5 END AS k FROM ({_sql_spans(RUN, 9, of='blanked')})),
moved AS (SELECT doc_id, s, k, m, unnest(range(0, length(m) - {WINDOW} + 1)) AS w FROM runs),
letters AS (SELECT doc_id, s, k, w, unnest(string_split(substr(m, w + 1, {WINDOW}), '')) AS c FROM moved),
counted AS (SELECT doc_id, s, k, w, c, count(*) AS n FROM letters GROUP BY ALL),
summed AS (SELECT doc_id, s, k, w, sum(round(n * log2(n) * {SCALE})::BIGINT) AS total FROM counted GROUP BY ALL),
added AS (SELECT doc_id, s + min(w) AS s, k, s + max(w) + {WINDOW} AS e FROM summed
  WHERE total <= CASE k WHEN 3 THEN {MOST["hex"]} WHEN 4 THEN {MOST["mixed"]} ELSE {MOST["text"]} END GROUP BY doc_id, k, summed.s),
both_kinds AS (SELECT doc_id, s, k, e FROM base UNION ALL SELECT doc_id, s, k, e FROM added)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256({join.format(names=names, where="k < 3")}) AS base_sha256, {join.format(names=names, where="k IS NOT NULL")} AS spans
FROM d LEFT JOIN both_kinds USING (doc_id) GROUP BY d.doc_id"""
