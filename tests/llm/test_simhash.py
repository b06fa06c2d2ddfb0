import random
import re

import xxhash

from clickscope.llm import simhash as S

from .conftest import SF_SMALL


def brute_fp(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(items):
    """{index: smallest id reachable} over all pairs within two bits."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= 2:
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(items)):
        groups.setdefault(find(i), []).append(items[i][0])
    return [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(items))]


def check(rows, docs, **kw):
    fps = [(i, brute_fp(t)) for i, t in rows]
    want = sorted(((i, f, c) for (i, f), c in zip(fps, brute_roots(fps))), key=str)
    got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id)
                  for r in S.near_duplicate_groups(docs, **kw).collect()), key=str)
    assert got == want


def test_matches_brute_force_on_table(spark):
    got = S.op10_simhash_near_dedup(spark, SF_SMALL).collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    fps = [(i, brute_fp(t)) for i, t in rows]
    want = sorted((i, format(f, "016x"), c) for (i, f), c in zip(fps, brute_roots(fps)))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_odd_rows(make_docs):
    rows = [(5, None), (3, ""), (4, " \t\n"), (7, "One"), (8, "one"), (9, "one\u00a0two three"), (None, "one"),
            (None, "only here, no id"), (2, "a b c d"), (2, "a b c d"), (2, "other words here now"),
            (11, "Été É été " * 3000)]
    check(rows, make_docs(rows))
    kept = S.keep_one_of_each(make_docs(rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [2, 2, 3, 7, 9, 11]
    assert sum(r.doc_id is None for r in kept) == 2


def test_empty_table_and_extra_columns(spark, make_docs):
    docs = make_docs([])
    assert S.near_duplicate_groups(docs).count() == 0
    assert S.keep_one_of_each(docs).columns == docs.columns
    more = make_docs([(1, "x y z"), (2, "x y z")]).selectExpr("*", "1 as fp", "2 as component_id", "3 as way")
    assert {r.component_id for r in S.near_duplicate_groups(more).collect()} == {1}
    assert S.keep_one_of_each(more).columns == more.columns


def test_hot_blocks_take_the_exact_way(spark):
    rnd = random.Random(7)
    near = {0}
    while len(near) < 300:  # a chain of near fingerprints: one crowded block for many
        x = rnd.choice(sorted(near))
        near.add(x ^ (1 << rnd.randrange(12)) ^ (1 << rnd.randrange(12)))
    far = {rnd.getrandbits(64) for _ in range(50)}
    fps = sorted(near | far)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    for hot in (4, 10 ** 6):
        roots = {r.node: r.root for r in S.components(S.links(df, hot=hot)).collect()}
        label = [roots.get(s, s) for (s,) in signed]
        want = brute_roots([(s, f) for (s,), f in zip(signed, fps)])
        assert label == want
