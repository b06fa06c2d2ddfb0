"""Exact top-k search by no-random-access aggregation.

Every component of the candidate vectors is a list sorted by value. A query
reads each list sequentially from its better end (largest values first where
the query's weight is positive, smallest first where it is negative), in
slices of a fixed depth, and never looks a vector up. What has been read of a
vector gives a lower bound on its score (unread lists at their worst value)
and an upper bound (unread lists at the value last read). Reading stops when
no vector outside the k best lower bounds, seen or unseen, has an upper bound
that could reach the k-th lower bound; the few vectors left then have their
scores resolved from the rows of their block, and ties go to the smaller id.

Vectors are dealt into blocks of a bounded number of rows, queries into blocks
of a bounded number as well. A task holds one vector block and one query block
and returns at most k rows a query; a partial top-k and a final one merge the
blocks. A block is exact on its own, so the merge is.

Defined results: a vector that is null, or holds a null or a non-finite
component, or has a null id, takes no part, nor does a query like it; repeated
rows count once, different vectors under one id count each; vectors of
different lengths are compared over the shorter (missing components are
zero); fewer than k candidates give all of them; an empty table gives no rows;
further columns are not read. A result's score that does not fit 64 bits is
refused with a ValueError.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import landed, read_table

K = 10
SCALE = 1024
QUERY_EVERY = 100
BLOCK_ROWS = 2048
QUERY_ROWS = 4096
TOGETHER = 256  # queries whose bounds a task holds at once
DEPTHS = 8  # slices in which a list of a block is read


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): distinct usable vectors with integer components."""
    parts = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable)
            .select(F.col("vec_id").cast("long"), parts.alias("v")).distinct())


def _padded(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _wide(ids: np.ndarray, rows: np.ndarray, qids: np.ndarray, queries: np.ndarray,
          k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``search_block`` for components whose bounds do not fit 64 bits: every list
    read to its end, in Python integers. Only a score that is a result must fit."""
    found = []
    for qid, query in zip(qids, queries.astype(object)):
        scores = rows.astype(object) @ query
        best = sorted(np.flatnonzero(ids != qid), key=lambda i: (-scores[i], ids[i]))[:k]
        if any(abs(scores[i]) >= 1 << 63 for i in best):
            raise ValueError("a score does not fit 64 bits")
        found.append((np.full(len(best), qid), ids[best], np.array([scores[i] for i in best], np.int64)))
    return found


def search_block(ids: np.ndarray, rows: np.ndarray, qids: np.ndarray, queries: np.ndarray,
                 k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, ids, scores) of the k best rows of one block for each query.

    All queries read list j together, slice by slice: those with a positive
    weight from its upper end, the others from its lower end.
    """
    n, dims = rows.shape
    # sums in 32 bits where none can reach a quarter of their range
    largest = (np.abs(queries.astype(float)) @ np.abs(rows.astype(float)).max(0, initial=0)).max(initial=0)
    if largest >= 1 << 61:
        return _wide(ids, rows, qids, queries, k)
    kind = np.int32 if largest < 1 << 28 else np.int64
    rows, queries = rows.astype(kind), queries.astype(kind)
    order = np.argsort(rows, axis=0, kind="stable")
    values = np.take_along_axis(rows, order, 0)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    low = np.tile(up @ values[0] + down @ values[-1], (n, 1))  # every list at its worst
    low[ids[:, None] == qids] = np.iinfo(kind).min  # never its own neighbour
    step, found = -(-n // DEPTHS), []

    def settle(q: int, left: np.ndarray) -> None:
        left = left[ids[left] != qids[q]]
        scores = rows[left] @ queries[q]
        best = np.lexsort((ids[left], -scores))[:k]
        found.append((np.full(len(best), qids[q]), ids[left[best]], scores[best]))

    for at in range(0, n, step):
        end = min(n, at + step)
        for j in range(dims):
            top, bottom = slice(n - end, n - at), slice(at, end)
            low[order[top, j]] += np.outer(values[top, j] - values[0, j], up[:, j])
            low[order[bottom, j]] += np.outer(values[bottom, j] - values[-1, j], down[:, j])
        if end == n or not len(qids):
            break
        kth = np.partition(low, n - k, axis=0)[n - k] if n > k else np.full(len(qids), low.min())
        frontier = values[n - end] * up + values[end - 1] * down  # per query and list
        done = frontier.sum(1) < kth  # no vector still unmet can qualify
        for q in np.flatnonzero(done):
            high = low[:, q].copy()
            for j in np.flatnonzero(queries[q]):
                if queries[q, j] > 0:
                    high[order[:n - end, j]] += frontier[q, j] - values[0, j] * up[q, j]
                else:
                    high[order[end:, j]] += frontier[q, j] - values[-1, j] * down[q, j]
            left = np.flatnonzero(high >= kth[q])
            done[q] = len(left) <= 8 * k  # else the lists are read on
            if done[q]:
                settle(q, left)
        low, up, down = low[:, ~done], up[~done], down[~done]
        qids, queries = qids[~done], queries[~done]
    for q in range(len(qids)):  # read to the end: the lower bound is the score
        kth = np.partition(low[:, q], n - k)[n - k] if n > k else low[:, q].min()
        settle(q, np.flatnonzero(low[:, q] >= kth))
    return found


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best inner products of every
    row of ``vectors`` for which ``is_query`` holds, among all other rows."""
    rows = landed(quantised(vectors, scale), "topk-vectors")
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"),
                    F.coalesce(F.max(F.size("v")), F.lit(0)).alias("w")).first()
    n_blocks, n_queries = -(-max(1, size.n) // block_rows), -(-max(1, size.q) // query_rows)
    width = size.w
    dealt = rows.withColumn("h", F.xxhash64("vec_id", "v"))
    side = F.sequence(F.lit(0), F.lit(n_queries - 1))
    held = dealt.select("vec_id", "v", F.pmod("h", F.lit(n_blocks)).cast("int").alias("block"),
                        F.explode(side).alias("queries"))
    side = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    asked = dealt.where(is_query).select(
        "vec_id", "v", F.explode(side).alias("block"),
        F.pmod("h", F.lit(n_queries)).cast("int").alias("queries"))

    def work(block: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(block) and len(queries):
            ids, data = block["vec_id"].to_numpy(), _padded(block["v"], width)
            qids, asked = queries["vec_id"].to_numpy(), _padded(queries["v"], width)
            for i in range(0, len(qids), TOGETHER):
                found += search_block(ids, data, qids[i:i + TOGETHER], asked[i:i + TOGETHER], k)
        cols = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), cols))).astype("int64")

    each = held.groupBy("block", "queries").cogroup(asked.groupBy("block", "queries")).applyInPandas(
        work, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % QUERY_EVERY == 0)


OP4_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM r WHERE rank <= 10
"""
