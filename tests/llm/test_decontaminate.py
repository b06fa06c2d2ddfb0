import math
import random
import re
from collections import Counter

from clickscope.llm import decontaminate as D

from .conftest import SF_MID


def terms(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(w):
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def split(text):
    parts = re.split(r"(?<=[.!?])\s+", text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


def brute(docs, items):
    """Pairs by BM25 of every item against every passage, without an index."""
    made = [(i, *map(terms, split(t))) for i, t in items if terms(t)]
    full = [q + a for _, q, a in made]
    df = Counter(t for w in full for t in set(w))
    mean = sum(map(len, full)) / max(1, len(full))
    out = set()
    for (item_id, q, a), w in zip(made, full):
        weight = {t: math.log(1 + (len(full) - df[t] + .5) / (df[t] + .5)) * c * 2.2 / (c + 1.2 * (.25 + .75 * len(w) / mean))
                  for t, c in Counter(w).items()}
        size = 16
        while size < len(w):
            size *= 2
        want = grams(q)
        for doc_id, words in docs:
            for p in range(0, max(1, len(words)), size):
                passage = words[p:p + 2 * size]
                have = set(passage)
                if sum(x for t, x in weight.items() if t in have) < 0.5 * sum(weight.values()):
                    continue
                for s in range(0, len(passage), len(w)):
                    part = passage[s:s + 2 * len(w)]
                    seen = {tuple(part[i:i + 5]) for i in range(len(part))}
                    asked = len(want & seen) / len(want) if want else 1.0
                    if 0 < len(q) < 5:
                        asked = float(any(part[i:i + len(q)] == q for i in range(len(part))))
                    told = len(set(a) & set(part)) / len(set(a)) if a else 1.0
                    if asked >= 0.8 and told >= 0.8:
                        out.add((doc_id, item_id))
    return out


def test_matches_brute_force_on_table(spark):
    docs = [(r.doc_id, terms(r.text)) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in D.op8_decontaminate(spark, SF_MID).collect()}
    assert got and got == brute(docs, items)


ITEMS = [(1, "What is the tallest mountain on the planet Mars today? It is Olympus Mons of course."),
         (2, "one two three"), (3, None), (4, "..."), (1, "a b c d e f g. h i j k.")]


def test_odd_rows_and_small_edits(spark, make_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(10, "Intro words. what is the TALLEST mountain on the planet mars today -- it is olympus mons, of course! Bye."),
            (11, "What is the tallest mountain on the planet Mars today? Nobody knows."),
            (12, "mountain olympus mons planet mars tallest today course what is the of it on"),
            (13, None), (14, ""), (15, "zero one two three four"), (None, "one two three"), (16, "one three two"),
            (17, "a b c d e f g. h i j k."), (17, "a b c d e f g. h i j k."), (18, "word " * 20000 + "one two three")]
    docs = make_docs(rows).selectExpr("*", "1 as item_id", "2 as score")
    got = sorted(((r.doc_id, r.item_id) for r in D.contaminated_pairs(docs, items).collect()), key=str)
    assert got == sorted([(10, 1), (15, 2), (None, 2), (17, 1), (17, 1), (18, 2)], key=str)
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [11, 12, 13, 14, 16]
    assert D.contaminated_pairs(make_docs([]), items).count() == 0
    assert D.contaminated_pairs(docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == len(rows)


def test_shards_find_the_same(spark, make_docs, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = make_docs([(15, "zero one two three four"), (17, "a b c d e f g. h i j k.")])
    monkeypatch.setattr(D, "SHARD_ITEMS", 1)
    got = sorted((r.doc_id, r.item_id) for r in D.contaminated_pairs(docs, items).collect())
    assert got == [(15, 2), (17, 1)]
    assert D.drop_contaminated(docs, items).count() == 0


def test_question_and_answer_columns(spark, make_docs):
    items = spark.createDataFrame([(1, "name the first five letters in order please", "a b c d e")],
                                  "item_id long, question string, answer string")
    docs = make_docs([(1, "name the first five letters in order please a b c d e"),
                      (2, "name the first five letters in order please")])
    assert [r.doc_id for r in D.contaminated_pairs(docs, items).collect()] == [1]


def test_unrelated_items_change_no_pair(spark, make_docs):
    """A long unrelated item widens no other item's passage, nor do many shift its pairs."""
    scattered = ("What is the tallest mountain on the planet Mars today? " + "Nobody knows. " * 300
                 + "it is olympus mons of course")
    docs = make_docs([(1, scattered), (2, f"Intro. {ITEMS[0][1]} Bye.")])
    few = [(1, ITEMS[0][1])]
    many = few + [(100, " ".join(f"long{i}" for i in range(4000)))] + [(200 + i, f"other{i} thing{i} here{i}") for i in range(50)]
    for items in (few, many):
        frame = spark.createDataFrame(items, "item_id long, text string")
        assert [(r.doc_id, r.item_id) for r in D.contaminated_pairs(docs, frame).collect()] == [(2, 1)]


def test_index_equals_brute_force_on_random_texts():
    rnd = random.Random(3)
    vocabulary = [f"v{i}" for i in range(60)]
    for _ in range(25):
        items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 45))) + ". " + " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 6))))
                 for i in range(40)]
        docs = []
        for d in range(12):
            parts = [rnd.choices(vocabulary, k=rnd.randrange(0, 80)), terms(rnd.choice(items)[1]), rnd.choices(vocabulary, k=9)]
            docs.append((d, [t for part in parts for t in part]))
        index = D.Index([(i, *D.question_and_answer(t)) for i, t in items])
        got = {(d, index.items[i][0]) for d, w in docs for i in index.matches(" ".join(w))}
        assert got == brute(docs, items)


def test_shards_share_the_statistics(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"common word{i} more{i % 3}. end{i % 2}") for i in range(9)] + [(9, None)], "item_id long, text string")
    (whole,) = D.indexes(items)
    want = {x[0]: w for x, w in zip(whole.items, whole.impact)}
    monkeypatch.setattr(D, "SHARD_ITEMS", 3)
    parts = list(D.indexes(items))
    assert len(parts) > 1
    assert {x[0]: w for p in parts for x, w in zip(p.items, p.impact)} == want
