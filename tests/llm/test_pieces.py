import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from clickscope.llm import pieces as P

from .conftest import SF_SMALL

with open(P.MODEL, "rb") as f:
    MODEL = f.read()
TABLE = P.Pieces(MODEL)


def all_paths(text):
    """Every (score, ids) of a short text's whole lattice."""
    full = " " + text if text else ""
    out = []

    def walk(i, ids, score):
        if i == len(full):
            out.append((score, ids))
        for j, step, s in TABLE.edges(full, i) if i < len(full) else ():
            walk(j, ids + step, score + s)
    walk(0, (), 0.0)
    return sorted(out, reverse=True)


@pytest.mark.parametrize("text", ["", "a", "the", "to be", "a  b", " x", "\n", "h\u00e9\n", "\u2581a", "\U0001d518 z"])
def test_n_best_equals_all_paths(text):
    want = all_paths(text)[:P.NBEST]
    ids, scores, changes = TABLE.encode(text)
    assert scores == pytest.approx([s for s, _ in want])
    paths = TABLE.paths(text)
    lookup = {p: s for s, p in all_paths(text)}
    assert [lookup[tuple(p.tolist())] for p in paths] == pytest.approx(scores)
    assert len({tuple(p.tolist()) for p in paths}) == len(paths)
    assert tuple(ids.tolist()) == tuple(paths[0].tolist())


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_every_segmentation_decodes(text):
    for p in TABLE.paths(text):
        assert TABLE.decode(p.tolist()) == text


def test_pieces_are_the_models():
    sp = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    ids, _, _ = TABLE.encode("Hello world")
    assert sp.decode(ids.tolist()) == "Hello world"


def test_table_round_trip(spark):
    df = P.op3_sentencepiece(spark, SF_SMALL)
    rows = df.collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(r.round_trip for r in rows)
    for r in rows[:20]:
        assert TABLE.decode(r.piece_ids) == docs[r.doc_id]
        assert r.n_best_scores == sorted(r.n_best_scores, reverse=True)
    decoded = P.decode(P.encode(spark.read.parquet(f"{SF_SMALL}/documents.parquet")))
    assert decoded.where("decoded is distinct from text").count() == 0


def test_odd_rows(make_docs):
    rnd = random.Random(1)
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, " "), (4, "\u2581 \t\n"),
            (5, "".join(rnd.choice("abc") for _ in range(20_000)))]
    df = P.encode(make_docs(rows).selectExpr("*", "1 as piece_ids", "2 as ids"))
    got = sorted(((r.doc_id, r.text, r.round_trip, r.piece_ids) for r in df.collect()), key=str)
    assert len(got) == len(rows)
    assert {r[2] for r in got if r[1] is not None} == {True}
    assert [r[3] for r in got if r[1] is None] == [None]
    assert [r[3] for r in got if r[1] == ""] == [[], []]
    assert P.encode(make_docs([])).count() == 0


def test_batched_forward_pass_equals_the_single_one():
    rnd = random.Random(3)
    words = sorted({" " * rnd.randrange(3) + "".join(rnd.choice("abdehinorst\u00e9") for _ in range(rnd.randrange(1, 20)))
                    for _ in range(800)})
    one, all_ = P.Pieces(MODEL), P.Pieces(MODEL)
    all_.best_of_all(words)
    for w in words:
        assert all_.cache[w] == one.best(w)
