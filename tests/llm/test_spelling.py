"""Spelling variants equal DuckDB SQL and a comparison of all words."""
import random
import re
import zlib
from collections import Counter

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickscope.llm import spelling as S

from .conftest import SF_SMALL


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, least=6, count=5, ratio=5):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least and c >= count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, n[w], len(near[w]), form[w] or "", n[form[w]] if form[w] else 0, root(w)) for w in n)


def run(docs, **options):
    got = S.variants(docs, **options).select("word", "n", "n_near", F.coalesce("form", F.lit("")),
                                             F.coalesce("form_n", F.lit(0)), "root")
    return sorted(map(tuple, got.collect()))


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    res = con.execute(E.oracle_sql()["op12_spelling_variants"])
    cols = [d[0] for d in res.description]
    want = sorted(res.fetchall(), key=str)
    df = E.queries()["op12_spelling_variants"](spark, SF_SMALL)
    assert want and sorted(map(tuple, df.select(*cols).collect()), key=str) == want


def test_equals_all_pairs_with_chains_ties_and_accents(spark, make_docs):
    rnd = random.Random(3)
    stems = ["letter", "lettér", "Ärgern", "summer", "sommer", "gardens", "straße", "aaaaaa", "çàéïøü"]
    words = []
    for s in stems:
        words += [s] * rnd.choice((400, 80))
        for _ in range(12):
            i, c = rnd.randrange(len(s)), rnd.choice("aeéxÿ")
            v = rnd.choice((s[:i] + s[i + 1:], s[:i] + c + s[i + 1:], s[:i] + c + s[i:]))
            words += [v] * rnd.randint(1, 20)
    words += ["chainaa"] * 1000 + ["chainab"] * 150 + ["chainbb"] * 25 + ["chainbc"] * 5  # three steps to the root
    words += ["tieone"] * 5 + ["tieona"] * 30 + ["tieonb"] * 30  # equal counts: the smaller word
    words += ["short", "×multiply÷", "naïve’s", "Ωmega", "UPPERS", "uppers"] * 9
    rnd.shuffle(words)
    rows = [(i, " ".join(words[i::40])) for i in range(40)]
    rows += [(None, "lonely " * 9), (None, "lonely,letter\tsummer"), (5, None), (6, ""), (7, rows[7][1]), (7, rows[7][1])]
    docs = make_docs(rows).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    got = run(docs)
    assert got == brute(rows)
    assert any(r[3] and r[5] != r[3] for r in got)
    assert run(docs, symbols=2) == run(docs, symbols=11) == got


def test_slices_never_cut_a_word_and_damage_follows_the_document(spark, make_docs, monkeypatch):
    text = "Überlegung? " * 400 + "x" * 3000 + " Ünderneath—underneath" * 300
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(S, "SLICE", size)
        found = Counter(w for part in S.runs(text, 6) for w in part)
        assert found == Counter(w.encode("latin-1") for w in re.findall("[a-zÀ-ÿ]{6,}", text.replace("U", "u")))
    hit = next(d for d in range(10_000) if zlib.crc32(f"{d}:underneath".encode()) % 199 == 0)
    assert len(S.damaged(b"underneath", str(hit).encode())) == 9
    rows = [(hit, "underneath " * 6), (hit + 1, "underneath " * 6)]
    assert run(make_docs(rows)) == brute(rows)


def test_empty_table(spark, make_docs):
    assert run(make_docs([])) == []
    assert run(make_docs([(1, None), (None, None), (2, "")])) == []
