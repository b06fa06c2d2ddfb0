import corpus_pipeline as C
from clickscope.llm import decontaminate, linededup, perplexity, simhash
from clickscope.llm.pieces import Pieces

from .conftest import SF_MID
from .test_decontaminate import brute as brute_pairs
from .test_decontaminate import terms
from .test_linededup import result
from .test_simhash import brute_fp, brute_roots


def test_stages_match_brute_force_and_the_whole(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in C.STAGES:
        docs = C.landed(stage(spark, docs, SF_MID), "test-pipeline")
        steps.append((name, docs))
    good, lines, near, clean, encoded = (x for _, x in steps)
    for df in (good, lines, near, clean):
        assert df.columns == columns
    raw = spark.read.parquet(f"{SF_MID}/documents.parquet")
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    kept = {r.doc_id for r in perplexity.judged(raw, labels).where("_kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    assert result(lines.selectExpr("*", "0 as n_removed")) == result(
        linededup.deduplicated_lines(good).selectExpr("doc_id", "text", "0 as n_removed"))
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    fps = [(i, brute_fp(t)) for i, t in rows]
    assert {r.doc_id for r in near.collect()} == set(brute_roots(fps))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in near.collect()]
    leaks = {d for d, _ in brute_pairs([(i, terms(t)) for i, t in rows], items)}
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - leaks
    with open("/opt/tokenizers/piece_bpe_32k.model", "rb") as f:
        pieces = Pieces(f.read())
    for r in encoded.collect():
        assert r.round_trip and pieces.decode(r.piece_ids) == r.text
    whole = {(r.doc_id, r.text) for r in C.run(spark, SF_MID).select("doc_id", "text").collect()}
    assert whole == {(r.doc_id, r.text) for r in encoded.collect()}
    assert C.ORACLE_SQL is None


def test_odd_documents_pass_every_stage(spark, make_docs):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "same text here\nand more"), (3, "same text here\nand more"),
            (4, "x" * 20000)]
    docs = make_docs(rows).selectExpr("*", "1 as home", "'r' as rest", "0 as _text_id")
    for _, stage in C.STAGES:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert set(docs.columns) <= set(out.columns)
        assert out.count() <= len(rows)
        assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0
    assert simhash.keep_one_of_each(docs).columns == docs.columns
    assert decontaminate.THRESHOLD == 0.5
