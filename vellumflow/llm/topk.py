"""Operator 9: exact top-k by integer inner product, by MaxScore.

Each component x of a vector counts as floor(64 * x). The terms of a query are its components. In a shard of candidates a
term's postings are the candidates in order of their value of that component, in blocks with the bounds of each; read from the
end that the query's sign makes the better one, they come in order of their contribution. A term's floor is its least
contribution, its width the difference to its largest.

While a query's k-th best score so far is theta, a candidate has to gather theta less all floors. Terms are ordered by
width; as many of the narrow ones as cannot gather that together are non-essential. Of the others, the essential terms, a
candidate must reach at least one's share of what is left, in proportion to its width, so of each essential term only the
blocks of postings above its share are traversed (where these hold nearly everybody, all candidates are taken at once). Who is met
there gets the sum of its essential terms and is probed in the others, widest first, while the sum so far and the upper
bounds of the terms left still reach theta.

theta begins as the k-th best score among a bounded sample of candidates (SEED rows), the same for all tasks, and is carried
from shard to shard of a task; shards are merged at the end. The queries go to the shards in blocks of bounded size (BLOCK
rows), one after the other, and a block's broadcast is dropped once its results are saved; candidates are never moved.
Vectors that are null or hold a null or non-finite component take no part. Missing components of a shorter vector (all, of an
empty one) count as 0. Equal scores are ranked by the smaller vec_id. All rows of a query's vec_id are its own; of repeated rows of a
query with different vectors each is a query, and the best of them count. Scores are exact while the sums stay below 2**53.
Columns besides vec_id and embedding are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import runtime

K, EVERY, SCALE = 20, 20, 64
BLOCK, SHARD, PROBE, SEED = 8192, 4096, 8, 4096
#: Postings in a block.
POSTINGS = 64


def integers(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part, with whole components."""
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x):
        y = x.cast("double") * SCALE
        return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # larger ones are whole numbers

    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).where(usable).select(F.col(key).cast("long").alias("vec_id"), F.transform(vector, whole).alias("v"))


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    at = rows.offsets.to_numpy()
    flat = rows.values.to_numpy()
    out = np.zeros((len(rows), width))
    size = np.diff(at)
    row = np.repeat(np.arange(len(rows)), size)
    col = np.arange(at[0], at[-1]) - np.repeat(at[:-1], size)
    out[row, col] = flat[at[0] : at[-1]]
    return out


class Best:
    """The k best (score, id) so far of each query, and what a score has to reach at least."""

    def __init__(self, n: int, k: int, theta: np.ndarray | None = None):
        self.k = k
        self.score = [np.zeros(0)] * n
        self.id = [np.zeros(0, np.int64)] * n
        self.theta = np.full(n, -np.inf) if theta is None else theta.copy()

    def offer(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        s, i = np.concatenate([self.score[q], score]), np.concatenate([self.id[q], ids])
        order = np.lexsort((i, -s))[: self.k]
        self.score[q], self.id[q] = s[order], i[order]
        if len(order) == self.k:
            self.theta[q] = max(self.theta[q], self.score[q][-1])


class Postings:
    """A shard's candidates by each component: rows in order of its value, and the bounds of every block of them."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.n, self.ids = len(ids), ids
        self.columns = np.asfortranarray(vectors)
        self.rows = np.asfortranarray(np.argsort(vectors, axis=0, kind="stable").astype(np.int32))
        values = np.take_along_axis(vectors, self.rows, 0)
        self.low, self.high = values[0], values[-1]
        self.block_low = values[::POSTINGS]
        self.block_high = values[np.minimum(np.arange(POSTINGS - 1, self.n + POSTINGS - 1, POSTINGS), self.n - 1)]

    def reached(self, terms: np.ndarray, own: np.ndarray, least: np.ndarray) -> np.ndarray | None:
        """The candidates in the blocks of the terms' postings that hold a contribution of ``least`` or more; None: (nearly) all."""
        up = own[terms] > 0
        best = np.where(up, self.block_high[:, terms], self.block_low[:, terms]) * own[terms]
        blocks = (best >= least).sum(0)  # at the end of the list if the query's sign is positive, else at its beginning
        if blocks.sum() * POSTINGS >= 2 * self.n:
            return None
        met = np.zeros(self.n, bool)
        for t, k, end in zip(terms.tolist(), blocks.tolist(), up.tolist()):
            if k:
                met[self.rows[(len(best) - k) * POSTINGS :, t] if end else self.rows[: k * POSTINGS, t]] = True
        return np.flatnonzero(met)


def search_shard(queries: np.ndarray, query_ids: np.ndarray, shard: Postings, best: Best) -> None:
    """MaxScore of every query over one shard (vectors as rows)."""
    upper = np.maximum(queries * shard.low, queries * shard.high)
    floor = np.minimum(queries * shard.low, queries * shard.high)
    width = upper - floor
    orders = np.argsort(-width, axis=1, kind="stable")
    for q in np.flatnonzero(upper.sum(1) >= best.theta).tolist():
        theta, order, own = best.theta[q], orders[q], queries[q]
        left = np.concatenate([np.cumsum(upper[q][order][::-1])[::-1], [0.0]])  # upper bounds of the terms from a place on
        spread = np.concatenate([np.cumsum(width[q][order][::-1])[::-1], [0.0]])
        gather = theta - floor[q].sum()
        alive, essential = None, len(order)
        if gather > 0:
            essential = max(1, int(np.count_nonzero(spread[:-1] >= gather)))
            share = (gather - spread[essential]) / max(spread[0] - spread[essential], 1e-300)
            terms = order[:essential]
            alive = shard.reached(terms, own, floor[q][terms] + np.floor(share * width[q][terms] * (1 - 1e-12)))
        total, first, last = 0.0, 0, essential
        while True:
            some = order[first:last]
            part = shard.columns[:, some] if alive is None else shard.columns[np.ix_(alive, some)]
            total = total + part @ own[some]
            keep = np.flatnonzero(total + left[last] >= theta)
            alive, total = keep if alive is None else alive[keep], total[keep]
            if last == len(order) or not len(alive):
                break
            first, last = last, min(last + PROBE, len(order))
        keep = shard.ids[alive] != query_ids[q]
        if keep.any():
            alive, total = alive[keep], total[keep]
            if len(total) > 4 * best.k:
                few = -total <= np.partition(-total, best.k - 1)[best.k - 1]
                alive, total = alive[few], total[few]
            best.offer(q, total, shard.ids[alive])


def _seeds(sample: pa.Table, query_ids: np.ndarray, matrix: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query among the sample: no larger than among all."""
    out = np.full(len(query_ids), -np.inf)
    ids, vectors = sample["vec_id"].to_numpy(), _matrix(sample["v"].combine_chunks(), matrix.shape[1])
    for first in range(0, len(query_ids), 256):
        score = matrix[first : first + 256] @ vectors.T
        score[query_ids[first : first + 256, None] == ids] = -np.inf
        if score.shape[1] >= k:
            out[first : first + 256] = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
    return out


def _search(candidates: DataFrame, sent, k: int) -> DataFrame:
    def run(batches):
        query_ids, matrix, theta = sent.value
        best = Best(len(query_ids), k, theta)
        held, ids = [], []

        def search():
            search_shard(matrix, query_ids, Postings(np.concatenate(held), np.concatenate(ids)), best)

        for b in batches:
            if b.num_rows:
                held.append(_matrix(b.column(1), matrix.shape[1]))
                ids.append(b.column(0).to_numpy())
            if sum(map(len, ids)) >= SHARD:
                search()
                held, ids = [], []
        if ids:
            search()
        size = list(map(len, best.id))
        if sum(size):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, size)), pa.array(np.concatenate(best.id)), pa.array(np.concatenate(best.score).astype(np.int64))], ["query_id", "vec_id", "score"])

    return candidates.mapInArrow(runtime.lean(run), "query_id long, vec_id long, score long")


def top_k(df: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every query among all other rows."""
    spark = df.sparkSession
    runtime.tune(spark)
    rows = integers(df)
    facts = rows.agg(F.max(F.size("v")).alias("width"), F.count_if(F.col("vec_id") % every == 0).alias("n")).first()
    width, blocks = facts["width"] or 1, max(1, -(-(facts["n"] or 0) // BLOCK))
    asked = runtime.save(rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]).withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))), "asked")
    sample = rows.limit(SEED).toArrow()
    found = None
    for b in range(blocks):
        block = asked.where(F.col("block") == b).orderBy("vec_id").toArrow()
        query_ids, matrix = block["vec_id"].to_numpy(), _matrix(block["v"].combine_chunks(), width)
        sent = spark.sparkContext.broadcast((query_ids, matrix, _seeds(sample, query_ids, matrix, k)))
        part = runtime.save(_search(rows, sent, k), "found")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    runtime.discard(asked)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sql(k: int = K, every: int = EVERY) -> str:
    return f"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM e q, e c WHERE q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}"""
