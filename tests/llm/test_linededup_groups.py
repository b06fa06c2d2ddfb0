import hashlib
import random

import numpy as np

from clickscope.llm import linededup as L

from .test_linededup import brute, result


def test_equal_lines_of_many_buckets_form_no_group(make_docs, monkeypatch):
    written, landed = {}, L.landed

    def keep(df, name, *rest):
        written[name] = landed(df, name, *rest)
        return written[name]
    monkeypatch.setattr(L, "landed", keep)
    rows = [(i, f"a line that all documents share\n{hashlib.md5(str(i).encode()).hexdigest()}") for i in range(300)]
    assert result(L.deduplicated_lines(make_docs(rows))) == brute(rows)
    assert written["lines-groups"].where("unit is not null").count() == 0


def test_large_groups_in_several_blocks_lose_no_link(make_docs, monkeypatch):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    line, rows = [word() for _ in range(40)], []
    for i in range(60):  # ends are far apart, neighbours close
        line = list(line)
        line[rnd.randrange(40)] = word()
        rows.append((i, " ".join(line)))
    monkeypatch.setattr(L, "BLOCK", 3)
    assert result(L.deduplicated_lines(make_docs(rows), group=4)) == brute(rows)


def test_pairs_by_ranges_of_hashes(monkeypatch):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.choice((3, 8, 60)))) for _ in range(30)]
    texts += [t[:-1] + "c" for t in texts]
    sets = [L.shingle_set(t) for t in texts]
    want = [[len(a & b) / len(a | b) >= L.SIMILARITY for b in sets] for a in sets]
    for held in (50, L.HELD):
        monkeypatch.setattr(L, "HELD", held)
        hashes = L.shingle_hashes(texts)
        assert L.similar_pairs(hashes, hashes).tolist() == want
    assert np.array(want).sum() > len(texts)


def test_links_span_and_joined_places_need_none():
    rnd = np.random.default_rng(3)
    for n in (1, 5, 40):
        linked = rnd.random((n, n)) < 1.2 / n
        linked |= linked.T
        for joined in (None, rnd.random(n) < 0.4):
            links = L.spanning(linked, joined)
            assert all(linked[i, j] for i, j in links) and len({j for _, j in links}) == len(links)
            one = [] if joined is None else [(i, j) for i in np.flatnonzero(joined) for j in np.flatnonzero(joined)]

            def parts(pairs):
                root = list(range(n))
                for i, j in pairs:
                    a, b = root[i], root[j]
                    root = [b if x == a else x for x in root]
                return [[x == y for y in root] for x in root]
            assert parts([*links, *one]) == parts([*np.argwhere(linked), *one])
