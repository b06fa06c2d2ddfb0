import random

import pytest

from clickscope.llm import toxicity as X

from .conftest import SF_MID

SF = "/root/testdata/sf0.1"


def brute_segments(weights):
    """Maximal scoring segments by the recursive definition: the best segment
    (the shortest of equals), then the same to its left and right."""
    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            s = 0.0
            for b in range(a, hi):
                s += weights[b]
                if s > 0 and (top is None or s > top[0] + 1e-12 or abs(s - top[0]) <= 1e-12 and b - a < top[2] - top[1]):
                    top = (s, a, b)
        return [] if top is None else best(lo, top[1]) + [top] + best(top[2] + 1, hi)
    return best(0, len(weights))


def test_segments_equal_the_definition():
    rnd = random.Random(1)
    for _ in range(300):
        n, drift = rnd.randrange(1, 25), 0.5
        hits = [(i, rnd.choice([-2.25, 1.125, 3.0625, 0.75])) for i in range(n) if rnd.random() < 0.4]
        weights = [-drift] * n
        for i, w in hits:
            weights[i] = w
        got = X.segments(hits, drift)
        want = brute_segments(weights)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]
        assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in want])


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = X.op2_toxic_passages(spark, SF).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    hits = sum(r.predicted for r in toxic)
    assert hits >= 0.85 * len(toxic)
    assert sum(r.predicted for r in rows) - hits <= 0.05 * hits + 1


def test_ranking_of_the_small_table(spark):
    """33 toxic training rows suffice; clean documents stay."""
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = X.op2_toxic_passages(spark, SF_MID).join(labels, "doc_id").where("held_out").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == x] for x in (1, 0))
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / len(toxic) / len(clean)
    caught = sum(x >= X.CUT for x in toxic)
    assert auc > 0.85  # four of the 18 hold words that no training text bears out
    assert caught >= 0.7 * len(toxic) and sum(x >= X.CUT for x in clean) <= 0.01 * len(clean) + 1


def test_weights_follow_the_number_of_words(spark):
    """A word of toxic texts only is found among many words of chance; those are not."""
    rnd = random.Random(5)
    rows = [(" ".join(f"w{rnd.randrange(4000)}" for _ in range(60)) + (" vile" if i < 30 else ""), int(i < 30))
            for i in range(300)]
    found = X.word_weights(spark.createDataFrame(rows, "text string, toxic int"))
    assert "vile " in found and found["vile "][0] > 2
    assert len([w for w in found if w.startswith("w")]) <= 1


def test_labels_of_the_held_out_fold_are_not_used(spark, make_docs):
    docs = make_docs([(i, f"text{i} thing{i} again{i} with a vile word" if i % 4 == 0 else f"text{i} thing{i} again{i} of calm talk") for i in range(400)])
    true = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    held = X.fold(X.F.col("doc_id")) == 1
    spoilt = true.withColumn("toxic", X.F.when(held, 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    a = sorted((r.doc_id, r.score) for r in X.toxicity(docs, true).collect())
    b = sorted((r.doc_id, r.score) for r in X.toxicity(docs, spoilt).collect())
    assert a == b


def test_odd_rows(spark, make_docs):
    rows = [(i, f"some filler{i} other{i} " * 5 + ("horrid beast" if i % 3 == 0 else "good beast")) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "horrid"), (0, "horrid"), (902, "horrid " * 30000)]
    docs = make_docs(rows).selectExpr("*", "1 as toxic", "'x' as score", "2 as held_out")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(5, None), (None, 1), (3, 0)],
                                   "doc_id long, toxic int")
    got = X.toxicity(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(0.0 <= r.score <= 1.0 and r.predicted == int(r.score >= X.CUT) for r in got)
    assert by[900].score == by[901].score == min(r.score for r in got)
    assert by[902].score > by[901].score and not by[900].held_out
    for few in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        assert {r.predicted for r in X.toxicity(docs, few).collect()} == {0}
    assert X.toxicity(docs.limit(0), labels).count() == 0
