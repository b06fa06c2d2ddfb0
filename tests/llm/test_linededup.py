import random

from clickscope.llm import linededup as L

from .conftest import SF_SMALL


def brute(rows):
    """(id, text, removed) of every row, by all pairs of lines."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] or ""))
    first = {}
    for i in order:
        for line in (rows[i][1] or "").split("\n"):
            n = L.normal(line)
            if n:
                first.setdefault(n, len(first))
    names = list(first)
    sets = [L.shingle_set(n) for n in names]
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for j in range(len(names)):
        for i in range(j):
            a, b = len(sets[i]), len(sets[j])
            if min(a, b) >= 0.8 * max(a, b) and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= L.SIMILARITY:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    out, taken = {}, set()
    for i in order:
        text = rows[i][1]
        left, some, removed = [], False, 0
        for line in text.split("\n") if text else []:
            n = L.normal(line)
            if n:
                if find(first[n]) in taken:
                    removed += 1
                    continue
                taken.add(find(first[n]))
                some = True
            left.append(line)
        out[i] = (rows[i][0], text if not removed else "\n".join(left) if some else "", removed)
    return sorted(out.values(), key=str)


def result(df):
    return sorted(((r.doc_id, r.text, r.n_removed) for r in df.collect()), key=str)


def test_matches_brute_force_on_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = brute(rows)
    got = result(L.op6_line_dedup(spark, SF_SMALL))
    assert sum(r[2] for r in want) > 50
    # banding may miss a pair with a chance of 0.0008; here it misses none
    assert got == want


def test_large_groups_lose_no_link(make_docs):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    line = [word() for _ in range(40)]
    rows = []
    for i in range(60):  # a drifting line: ends are far apart, neighbours close
        line = list(line)
        line[rnd.randrange(40)] = word()
        rows.append((i, " ".join(line)))
    for group in (4, 64):
        assert result(L.deduplicated_lines(make_docs(rows), group=group)) == brute(rows)


def test_odd_rows(make_docs):
    rows = [(1, "A line.\nAnother one here\n\n  \nA  LINE."), (2, "a line."), (3, None), (4, ""), (5, "\n\n"),
            (6, "x\ny\nx"), (None, "x\nnew here and only here"), (6, "x\ny\nx"), (7, "tail\r\nA line."),
            (8, "Été à la mer"), (9, "été À LA MER\nz"), (10, "q" * 30000), (11, "q" * 30000 + "\nkeep")]
    df = make_docs(rows).selectExpr("*", "'c' as home", "1 as rest", "2 as line", "3 as n_lines")
    out = L.without_repeated_lines(df)
    assert out.columns == df.columns
    assert result(L.deduplicated_lines(make_docs(rows))) == brute(rows)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == [x[:2] for x in brute(rows)]
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)
    assert L.without_repeated_lines(make_docs([])).count() == 0
