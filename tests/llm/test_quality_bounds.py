from clickscope.llm import perplexity as Q

from .conftest import SF_MID


def test_held_out_quantiles_reject_junk_and_repeated_words(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang", "text")
    more = spark.createDataFrame([(-1, "en", "the " * 900), (-2, "fr", "de " * 900)], docs.schema)
    rows = Q.judged(docs.union(more), labels).join(labels, "doc_id", "left").collect()
    assert {r.doc_id: r._kept for r in rows if r.doc_id < 0} == {-1: False, -2: False}
    good = [r._kept for r in rows if r.quality == 1]
    junk = [r._kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(junk) <= 0.2 * len(junk)
