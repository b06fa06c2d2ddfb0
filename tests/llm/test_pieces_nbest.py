from pyspark.sql import functions as F

from clickscope.llm import pieces as P

from .conftest import SF_SMALL
from .test_pieces import TABLE, all_paths


def test_every_segmentation_is_returned_and_decoded(spark, make_docs):
    texts = ["", "a", "to be", "a  b", " x", "\n", "hé\n", "\U0001d518 z"]
    rows = P.decode(P.encode(make_docs([*enumerate(texts), (99, None)]))).collect()
    for r in rows:
        if r.text is None:
            assert r.n_best_ids is None and r.n_best_decoded is None
            continue
        score = {p: s for s, p in all_paths(r.text)}
        paths = [tuple(p) for p in r.n_best_ids]
        assert len(set(paths)) == len(paths) == min(P.NBEST, len(score))
        assert paths[0] == tuple(r.piece_ids)
        assert [round(score[p], 4) for p in paths] == [round(s, 4) for s in r.n_best_scores]
        assert r.n_best_decoded == [r.text] * len(paths)


def test_query_returns_segmentations(spark):
    df = P.op3_sentencepiece(spark, SF_SMALL)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert df.where(F.size("n_best_ids") != F.size("n_best_scores")).count() == 0
    for r in df.collect():
        assert [len(p) - len(r.piece_ids) for p in r.n_best_ids] == r.n_best_longer
        assert {TABLE.decode(p) for p in r.n_best_ids} == {docs[r.doc_id]}
