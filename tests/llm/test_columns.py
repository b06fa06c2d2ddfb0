"""The filtering stages hand the caller's own columns through, whatever their names."""
from clickscope.llm.linededup import without_repeated_lines
from clickscope.llm.perplexity import keep_good
from clickscope.llm.simhash import keep_one_of_each

NAMES = ("_quality", "_n", "_model", "_fold", "_logs", "_kept", "_text_id", "n_lines", "n_removed", "line", "a.b")


def test_values_of_clashing_columns_stay(spark, make_docs):
    rows = [(i, f"plain words about thing number {i} and what it does all day\nshared line of text here") for i in range(9)]
    rows += [(20, None), (21, ""), (0, rows[0][1])]
    docs = make_docs(rows).selectExpr("*", *(f"concat(coalesce(doc_id, -1), '{i}') as `{n}`" for i, n in enumerate(NAMES)))
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int")
    for work in (lambda d: keep_good(d, labels), keep_one_of_each, without_repeated_lines):
        out = work(docs)
        assert out.columns == docs.columns
        kept = out.collect()
        assert len(kept) >= 9
        for r in kept:
            assert [r[n] for n in NAMES] == [f"{r.doc_id}{i}" for i in range(len(NAMES))]
