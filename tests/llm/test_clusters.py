"""Centroid clusters equal DuckDB SQL and a plain loop over Python integers."""
import hashlib
import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from clickscope.llm import clusters as K

from .conftest import SF_SMALL

KIND = "vec_id long, embedding array<double>, label int, cluster string, h string"


def brute(rows, clusters, rounds, width, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * x) if abs(x) < 2**53 else scale * int(x) for x in v]) for i, v in rows
            if i is not None and v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept)[:clusters]
    centres = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        by = {}
        for _, v in kept:
            by.setdefault(near(v)[1], []).append(v)
        for j, vs in by.items():
            centres[j] = [sum(x) // len(vs) for x in zip(*vs)]
    return sorted((i, near(v)[1], near(v)[0]) for i, v in kept), centres


def run(spark, rows, clusters, rounds, width):
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], KIND)
    found, centres = K.cluster(df, clusters, rounds, width)
    return sorted(tuple(r) for r in found.collect()), centres


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    res = con.execute(E.oracle_sql()["op11_centroid_clusters"])
    cols = [d[0] for d in res.description]
    want = sorted(res.fetchall())
    df = E.queries()["op11_centroid_clusters"](spark, SF_SMALL)
    assert want and sorted(map(tuple, df.select(*cols).collect())) == want


@pytest.mark.parametrize("size", [1.0, 5e3, 1e30, 1e200])
def test_equals_a_plain_loop_at_every_size_of_component(spark, size):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(5, 8))
    rows = [(i, [float(x) for x in size * (centre[i % 5] + rng.normal(size=8) / 3)]) for i in range(120)]
    rows += [(0, rows[0][1]), (7, rows[9][1]), (200, [0.0] * 8), (201, [-0.0] * 8)]  # repeated rows and ids
    rows += [(None, [1.0] * 8), (300, None), (301, [1.0] * 7), (302, [1.0] * 7 + [None]),
             (303, [math.nan] + [1.0] * 7), (304, [math.inf] + [1.0] * 7), (305, [])]
    found, centres = run(spark, rows, 5, 4, 8)
    want, want_centres = brute(rows, 5, 4, 8)
    assert centres == want_centres
    assert [(i, j) for i, j, _ in found] == [(i, j) for i, j, _ in want]
    assert [d for *_, d in found] == [d if d < 2**63 else None for *_, d in want]


def test_ties_few_rows_and_empty(spark):
    same = [(i, [1.0, 2.0]) for i in range(6)]
    found, centres = run(spark, same, 3, 2, 2)
    assert {r[1:] for r in found} == {(0, 0)} and centres == [[1024, 2048]] * 3  # empty centroids stay
    assert run(spark, same[:2], 8, 3, 2) == brute(same[:2], 8, 3, 2)
    assert run(spark, [], 8, 3, 2) == ([], [])
    assert run(spark, [(1, None)], 8, 3, 2) == ([], [])


def test_search_drops_only_what_is_strictly_worse():
    rng = np.random.default_rng(9)
    rows, centres = rng.integers(-2000, 2000, (300, 64)), rng.integers(-2000, 2000, (8, 64)).tolist()
    centres[5] = centres[2]  # a tie for whoever is near it
    best, far = K.nearest(rows, centres)
    full = ((rows[:, None, :] - np.array(centres)[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (far == full.min(1)).all() and 5 not in best
    h = K.hadamard(64)
    assert (h @ h.T == 64 * np.eye(64)).all() and (np.diff(h, axis=1) != 0).sum(1).tolist() == list(range(64))


def test_a_width_that_is_no_power_of_two_is_refused(spark):
    with pytest.raises(ValueError):
        K.cluster(spark.createDataFrame([], KIND), width=6)
