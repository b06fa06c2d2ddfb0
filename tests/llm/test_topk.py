import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from clickscope.llm import topk as K

from .conftest import SF_SMALL


def brute(rows, k, queries):
    usable = {(i, tuple(int(np.floor(1024 * x)) for x in v)) for i, v in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for qid, q in usable:
        if queries(qid):
            best = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in usable if i != qid)[:k]
            out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def test_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    got = sorted(tuple(r) for r in K.op4_exact_top_k(spark, SF_SMALL).collect())
    assert got == sorted(con.execute(K.OP4_SQL).fetchall())


def test_odd_rows_ties_and_blocks(spark):
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randrange(-3, 4)) / 8 for _ in range(6)]) for i in range(90)]
    rows += [(200 + i, [0.5, -0.25, 0.0, 0.0, 0.125, 0.0]) for i in range(40)]  # one common vector
    rows += [(5, None), (300, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (301, [float("nan")] * 6),
             (302, [float("inf")] * 6), (None, [1.0] * 6), rows[0], (303, [0.0] * 6), (304, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    want = brute([(i, None if v is None else list(v) + [0.0] * (6 - len(v))) for i, v in rows], 4,
                 lambda i: i % 10 == 0 or i > 300)
    for block_rows, query_rows in ((16, 5), (4096, 4096)):
        got = K.top_k(df, (F.col("vec_id") % 10 == 0) | (F.col("vec_id") > 300), k=4,
                      block_rows=block_rows, query_rows=query_rows)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_fewer_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in K.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 1024)]
    assert K.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_reading_stops_early_on_a_clear_winner():
    rnd = np.random.default_rng(0)
    rows = rnd.integers(-100, 100, (400, 8))
    rows[7] = 10_000
    got = K.search_block(np.arange(400), rows, np.array([1000]), np.full((1, 8), 3), 1)
    assert [tuple(int(y[0]) for y in x) for x in got] == [(1000, 7, 240_000)]


def test_components_of_a_few_billion(spark):
    rows = [(0, [3.0e6, 0.0]), (1, [0.0, 5.0]), (2, [0.0, 7.0]), (100, [0.0, 4.0e6]), (3, [-1.0e5, 1.0e5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in K.top_k(df, F.col("vec_id") % 100 == 0, 3, block_rows=2).collect())
    assert got == brute(rows, 3, lambda i: i % 100 == 0)


def test_scores_beyond_64_bits_are_refused():
    import pytest
    wide = np.array([[1 << 40, 0], [0, 1 << 40]])
    with pytest.raises(ValueError):
        K.search_block(np.array([1, 2]), wide, np.array([3]), wide[:1], 1)
    (found,) = K.search_block(np.array([1, 2]), wide, np.array([1]), wide[:1], 1)  # its own score is none
    assert [x.tolist() for x in found] == [[1], [2], [0]]
