import hashlib
import random

import numpy as np

from clickscope.llm import substrings as S

from .conftest import SF_SMALL


def brute(rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - 49):
                w = b[p:p + 50]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if i is not None and first[b[p:p + 50]] < i:
                gone[p:p + 50] = b"\x01" * 50
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_matches_brute_force_on_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = S.op7_substring_dedup(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = brute(rows)
    assert sum(r[2] for r in want) > 0
    assert result(got) == want


def test_odd_rows(make_docs):
    rnd = random.Random(5)
    word = lambda n: "".join(rnd.choice("ab\u00e9 ") for _ in range(n))
    shared, other = word(60), word(49)
    rows = [(1, "x" * 200), (2, "x" * 49), (3, "x" * 50), (4, "y" + "x" * 51 + "z"), (5, None), (6, ""),
            (7, shared + word(30)), (8, word(10) + shared), (8, shared), (8, shared), (None, shared),
            (9, other + "1"), (10, other + "2"), (11, shared[:55] + word(3) + shared[4:] + "x" * 60),
            (0, word(40)), (12, "ab" * 5000), (13, "ba" * 40)]
    rows += [(20 + i, shared[i % 7:] + word(i)) for i in range(40)]
    assert result(S.repeated_bytes_removed(make_docs(rows))) == brute(rows)
    kept = {r.doc_id: r.kept for r in S.repeated_bytes_removed(make_docs(rows[:3])).collect()}
    assert kept == {1: b"x" * 200, 2: b"x" * 49, 3: b""}


def test_empty_table_and_extra_columns(make_docs):
    assert S.repeated_bytes_removed(make_docs([])).count() == 0
    more = make_docs([(1, "a" * 60), (2, "a" * 60)]).selectExpr("*", "1 as home", "'b' as bucket", "2 as owner")
    assert [r.n_removed for r in S.repeated_bytes_removed(more).orderBy("doc_id").collect()] == [0, 60]


def test_columnwise_index_sorts_every_column(tmp_path):
    rnd = np.random.default_rng(2)
    rows = rnd.integers(97, 99, (300, 12)).astype(np.uint8)
    index = S.ColumnwiseIndex(rows, str(tmp_path), 6)
    for column in range(11, -1, -1):
        common, string = index.insert(column)
        got = [bytes(rows[s, column:]) for s in string]
        assert got == sorted(got)
        lcp = [min(6, next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))) for a, b in zip(got, got[1:])]
        assert common[1:].tolist() == lcp
        front = index.read(column)[0]
        assert not column or front.tolist() == [rows[s, column - 1] for s in string]


def test_anchors_do_not_depend_on_what_is_around():
    rnd = np.random.default_rng(1)
    data = rnd.integers(97, 105, 300_000).astype(np.uint8)
    places, _ = S.anchor_places(data)
    for at in (0, 65_500, 131_071, 200_000):
        inner, _ = S.anchor_places(data[at:at + 50])
        assert set(inner + at) <= set(places)
