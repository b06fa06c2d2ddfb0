import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickscope.llm import perplexity as Q
from clickscope.llm import symbolmodel as M


def fold(text):
    return [" ", " ", *("0" if x.isdigit() else x for x in " ".join(text.split()))]


def brute(texts, low):
    """log p(c | a b) from the definition, by code point; ``low`` is the
    share of the lowest order."""
    c3 = Counter()
    for t in texts:
        s = fold(t)
        c3.update(zip(s, s[1:], s[2:]))
    c2 = Counter((b, c) for _, b, c in c3)
    c1 = Counter((c,) for _, c in c2)

    def level(counts):
        t = Counter(counts.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0.5
        d = [0.0] + [min(k - 0.05, max(0.05, k - (k + 1) * y * t[k + 1] / t[k] if t[k] else 0.5 * k)) for k in (1, 2, 3)]
        total, gap = defaultdict(int), defaultdict(float)
        for key, x in counts.items():
            total[key[:-1]] += x
            gap[key[:-1]] += d[min(x, 3)]
        return lambda key, below: (max(counts[key] - d[min(counts[key], 3)], 0) + gap[key[:-1]] * below) / total[
            key[:-1]] if total[key[:-1]] else below

    orders = [level(x) for x in (c1, c2, c3)]
    symbols = len(c1)

    def p(a, b, c):
        x = low(a, b, c) if low else 1 / (symbols + 1)
        for order, key in zip(orders, ((c,), (b, c), (a, b, c))):
            x = order(key, x)
        return x
    return p


TEXTS = {"xx": ["the cat sat on the mat", "a cat and a hat", "12 cats  sat\n\nthere"], "yy": ["été cat zebra"],
         "el": ["η γάτα κάθισε στο χαλί", "μια γάτα"], "zh": ["猫坐在垫子上 猫和帽子"], None: ["plain text"]}


def test_every_language_has_the_model_of_the_definition(spark):
    rows = [(lang, t) for lang, texts in TEXTS.items() for t in texts]
    trusted = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    model = M.Model(trusted.withColumn("fold", F.lit(None).cast("int")))
    every = brute([t for _, t in rows], None)
    asked = [(lang, t) for lang in [*TEXTS, "none"] for t in ("a cat 345 γάτα 猫和", "unseen ж")]
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(asked)],
                                 "doc_id long, lang string, text string")
    got = {(r.lang, r.text): r for r in M.with_perplexity(docs, model).collect()}
    for lang, text in asked:
        own = brute(TEXTS[lang], every) if lang in TEXTS and lang else every
        s = fold(text)
        logs = [math.log(own(*x)) for x in zip(s, s[1:], s[2:])]
        assert got[lang, text]._n == len(logs)
        assert got[lang, text]._logs == pytest.approx(-sum(logs) / len(logs), abs=1e-4), (lang, text)


def test_a_question_names_its_model_alone(spark):
    """The pool follows from the model's name, also where a language holds the mark."""
    rows = [(1, "xx", "the cat sat"), (2, "a:b", "a cat and a hat"), (3, None, "plain text")]
    trusted = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = M.Model(trusted.withColumn("fold", F.lit(None).cast("int")))
    names = [(f"-1:{lang}" if lang else "-1", int(M.trigrams("a cat")[2])) for _, lang, _ in rows]
    got = model.log_probabilities(spark.createDataFrame(names, "model string, code long"))
    assert got.columns == ["model", "code", "logp"] and got.count() == 3
    every = brute([t for *_, t in rows], None)
    want = {"-1": every, "-1:xx": brute(["the cat sat"], every), "-1:a:b": brute(["a cat and a hat"], every)}
    for r in got.collect():
        assert r.logp == pytest.approx(math.log(want[r.model](*fold("a cat")[2:5])), abs=1e-4), r.model


def test_a_minority_script_is_told_from_junk(spark, make_docs):
    rnd = random.Random(5)

    def text(alphabet, kind):
        syllables = ["".join(random.Random(f"{alphabet}{i}").choices(alphabet, k=3)) for i in range(40)]
        if kind == "good":
            return " ".join(rnd.choice(syllables) + rnd.choice(syllables) for _ in range(120))
        return "".join(rnd.choices(alphabet, k=800))

    latin, greek = "abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω"
    many = "".join(chr(x) for x in range(0x100, 0x170))  # 112 symbols that push Greek out of a short alphabet
    good = [("en", text(latin + many, "good")) for _ in range(120)] + [("el", text(greek, "good")) for _ in range(6)]
    junk = [("el", text(greek, "junk")) for _ in range(4)]
    docs = make_docs(list(enumerate(t for _, t in good + junk))).drop("lang").join(
        spark.createDataFrame([(i, x) for i, (x, _) in enumerate(good + junk)], "doc_id long, lang string"), "doc_id")
    labels = spark.createDataFrame([(i, 1) for i in range(len(good))], "doc_id long, quality int")
    kept = {r.doc_id for r in Q.keep_good(docs, labels).select("doc_id").collect()}
    assert kept == set(range(len(good)))
