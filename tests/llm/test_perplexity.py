from clickscope.llm import perplexity as Q

from .conftest import SF_MID


def test_rejects_junk_and_keeps_clean_text(spark):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = Q.op9_quality_classifier(spark, SF_MID).join(labels, "doc_id").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.3 * len(junk)


def test_odd_rows(spark, make_docs):
    good = [(i, f"plain words about thing number {i} and what it does all day " * 8) for i in range(60)]
    odd = [(100, None), (101, ""), (102, " \n\t"), (103, "#$%^" * 400), (None, "plain words about thing"), (0, good[0][1])]
    docs = make_docs(good + odd).selectExpr("doc_id", "text", "case when doc_id = 1 then null else lang end as lang",
                                            "1 as perplexity", "2 as quality")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(3, 0), (None, 1), (4, None)],
                                   "doc_id long, quality int")
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        [i for i, _ in good] + [100, 101, 102, None, 0], key=str)
    none = Q.keep_good(docs, labels.limit(0))
    assert none.count() == len(good + odd)
    assert Q.keep_good(docs.limit(0), labels).count() == 0
