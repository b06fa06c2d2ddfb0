"""Toxicity by maximum-scoring segment search.

A word's weight is its log-odds between toxic and clean training texts, each
smoothed by an informative Dirichlet prior: the word's share of all training
texts, worth ``PRIOR`` times the smaller class. Which words carry a weight is a
matter of false discoveries, not of a fixed cut: a word's counts are tested
against the classes' sizes (signed root of the likelihood ratio), and the cut
is where the words expected beyond it by chance are ``FALSE_SHARE`` of those
found, so it follows the number of words and of texts; their log-odds must be
at least ``LEAST_ODDS``. Words without a weight of their own are pooled by
their beginnings of ``STEMS`` characters, each counted once a text, which get
weights the same way; such a word takes the weight of its beginning with the
largest test value, and one without any weighs ``-DRIFT``. Words
are counted once a text, and texts with the same three longest words (copies and
near copies) count as one, so that a text that was copied often does not teach its
own vocabulary. A linear-time scan finds all
maximal scoring segments of a text: the passages whose weight no extension and
no part exceeds.

How large a best segment is in clean text is an extreme-value question: with
``lam`` the root of E[exp(lam * weight)] = 1 over the clean tokens, the best of
a clean text of n tokens exceeds s about with probability
1 - exp(-K n exp(-lam s)). ``K`` is fitted to the clean training texts. A
passage is significant when it is expected less than once by chance; r
significant passages count together by the sum statistic of their normalised
scores. The evidence -ln p of a text becomes its score by a logistic curve
fitted to the training texts.

The model is fitted on a bounded sample of labelled training rows (at most
``TRAIN_ROWS``, the first by a hash of the doc_id), and only words and
beginnings that this sample bears out are broadcast, so their number is bounded
by the sample's; every text is scored whole, in one pass without a shuffle.

Defined results: a null or empty text has no passage and the lowest score;
rows repeat as they are; a null doc_id is in no fold and not held out; labels
that repeat for a document count once (toxic if any says so); with no toxic or
no clean training row nothing is known and every text gets that lowest score;
an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import broadcast, landed, read_table

TRAIN_ROWS = 20_000
STEMS = range(3, 10)
STEM_WORDS = 3  # different toxic words a beginning needs
PRIOR = 1.0  # weight of the prior, in sizes of the smaller class
FALSE_SHARE = 0.01  # false discoveries among the words that carry a weight
LEAST_ODDS = 1.0
DRIFT = 0.05
CUT = 0.7
WORD = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


class Weights(dict):
    """Weight of a word, None where it has none; words are remembered."""

    def __init__(self, known: dict[str, tuple[float, float]]):
        self.known = known  # word and a space, or beginning -> (weight, test value)

    def __missing__(self, word: str) -> float | None:
        found = self.known.get(word + " ") or max(
            (self.known[word[:n]] for n in STEMS if word[:n] in self.known), key=lambda x: x[1], default=None)
        if len(self) >= 500_000:
            self.clear()
        self[word] = out = found[0] if found else None
        return out


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3; 1 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, toxic): a bounded sample of the labelled texts outside the held-out fold."""
    ids = (labels.where(F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 1))
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    picked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most ``rows`` ids

    def longest(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([" ".join(sorted(set(tokens(t or "")), key=lambda w: (-len(w), w))[:3]) for t in batch],
                            dtype=object)

    key = F.pandas_udf(longest, "string")(F.col("text"))
    first = picked.withColumn("key", key).groupBy("key", "toxic").agg(F.min_by("text", "doc_id").alias("text"))
    return landed(first.select("text", "toxic"), "toxicity-training")


def word_counts(train: DataFrame) -> DataFrame:
    """(name, n1, n0): toxic and clean training texts that hold a word."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _counted(batch, lambda words: words)

    return _summed(train, count)


def stem_counts(train: DataFrame, own: dict[str, tuple[float, float]]) -> DataFrame:
    """(name, n1, n0): texts that hold a word of a beginning, of words not in ``own``."""
    sent = broadcast(train.sparkSession, {w[:-1] for w in own})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent()
        for batch in batches:
            yield _counted(batch, lambda words: {w[:n] for w in words - known for n in STEMS if n <= len(w)})

    return _summed(train, count)


def _counted(batch: pd.DataFrame, names: Callable[[set[str]], set[str]]) -> pd.DataFrame:
    seen = (Counter(), Counter())
    for text, toxic in zip(batch["text"], batch["toxic"]):
        seen[int(toxic == 1)].update(names(set(tokens(text or ""))))
    return pd.DataFrame([(t, seen[1][t], seen[0][t]) for t in seen[0].keys() | seen[1].keys()],
                        columns=["name", "n1", "n0"])


def _summed(train: DataFrame, count: Callable) -> DataFrame:
    rows = train.mapInPandas(count, "name string, n1 long, n0 long")
    return rows.groupBy("name").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def discovered(counts: DataFrame, prior: float, false_share: float) -> DataFrame:
    """(name, odds, z): names whose counts differ between the classes by more
    than chance, z the root of their likelihood ratio; none without both classes."""
    total = counts.agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.count("*").alias("n")).first()
    n1, n0 = total.n1 or 0, total.n0 or 0
    if not n1 or not n0:
        return counts.select("name", F.lit(0.0).alias("odds"), F.lit(0.0).alias("z")).limit(0)
    share, worth = n1 / (n1 + n0), prior * min(n1, n0)
    alpha = F.lit(worth / (n1 + n0)) * (F.col("n1") + F.col("n0"))
    y1, y0 = F.col("n1") + alpha, F.col("n0") + alpha
    odds = F.log(y1 / (n1 + worth - y1)) - F.log(y0 / (n0 + worth - y0))

    def part(n: str, share: float) -> Column:
        held = F.col(n) / ((F.col("n1") + F.col("n0")) * share)
        return F.when(F.col(n) > 0, F.col(n) * F.log(held)).otherwise(0.0)

    ratio = part("n1", share) + part("n0", 1 - share)
    tested = counts.select("name", odds.alias("odds"), F.sqrt(2 * F.greatest(ratio, F.lit(0.0))).alias("z"))
    bins = (tested.groupBy(F.least(F.floor(F.col("z") * 20), F.lit(800)).alias("bin"))
            .count().collect())  # at most 801 rows
    beyond, cut = 0, math.inf
    for bin_, n in sorted(((r.bin, r["count"]) for r in bins), reverse=True):
        beyond += n
        if total.n * math.erfc(bin_ / 20 / math.sqrt(2)) <= false_share * beyond:
            cut = bin_ / 20
    return tested.where((F.col("z") >= cut) & (F.abs("odds") >= LEAST_ODDS))


def word_weights(train: DataFrame, prior: float = PRIOR,
                 false_share: float = FALSE_SHARE) -> dict[str, tuple[float, float]]:
    """(weight, test value) of words (with a closing space) and of beginnings;
    none without both kinds of text."""
    counts = landed(word_counts(train), "toxicity-words")
    own = {f"{r.name} ": (r.odds, r.z) for r in discovered(counts, prior, false_share).collect()}
    stems = landed(stem_counts(train, own), "toxicity-stems")
    found = discovered(stems, prior, false_share)
    # a beginning speaks for words of its kind only if several of them are toxic
    sizes = F.array(*(F.lit(n) for n in STEMS))
    several = (counts.where("n1 > 0").select("name", F.explode(sizes).alias("size"))
               .where(F.length("name") >= F.col("size"))
               .groupBy(F.substring("name", F.lit(1), F.col("size")).alias("name")).count()
               .where(F.col("count") >= STEM_WORDS))
    return own | {r.name: (r.odds, r.z) for r in found.join(several, "name", "left_semi").collect()}


def weight_shares(clean: DataFrame, known: dict[str, tuple[float, float]]) -> tuple[list[tuple[float, float]], float]:
    """([(weight, share of the words of clean texts)], share without one)."""
    sent = broadcast(clean.sparkSession, known)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, seen = Weights(sent()), Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(table[w] for w in tokens(text or ""))
        yield pd.DataFrame([(w, n) for w, n in seen.items()], columns=["weight", "n"])

    rows = (clean.select("text").mapInPandas(count, "weight double, n long")
            .groupBy("weight").agg(F.sum("n").alias("n"))).collect()  # one for each weight
    total = sum(r.n for r in rows) or 1
    return [(r.weight, r.n / total) for r in rows if r.weight is not None], sum(
        r.n for r in rows if r.weight is None) / total


def decay(shares: list[tuple[float, float]], rest: float) -> float:
    """The positive root of E[exp(lam * weight)] = 1 over the words of clean text."""
    parts = shares + [(-DRIFT, rest)]

    def excess(lam: float) -> float:
        return sum(p * math.exp(min(lam * w, 700.0)) for w, p in parts) - 1.0

    low, high = 1e-6, 1.0
    if excess(high) < 0:
        return 1.0  # flatter than the odds themselves say: stay at their own scale
    if excess(low) > 0:
        return 0.05  # no drift left at all
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return max(0.05, low)


def segments(hits: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first, last token) of a text whose
    tokens weigh ``-drift`` but for ``hits`` (place, weight), in linear time.

    Segments are kept on a stack with the running sum before and after each. A
    new one is merged with the last whose sum before it is smaller, as long as
    the sum after that one is below its own."""
    stack: list[tuple[float, float, int, int, int]] = []  # before, after, first, last, next to look at
    total, reached = 0.0, 0
    for at, weight in hits:
        total -= drift * (at - reached)
        reached = at + 1
        before, total = total, total + weight
        if weight <= 0:
            continue
        first, after = at, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= after:
                stack.append((before, after, first, at, j))
                break
            before, first = stack[j][0], stack[j][2]
            del stack[j:]
    return [(after - before, first, last) for before, after, first, last, _ in stack]


def evidence(docs: DataFrame, weights: dict[str, tuple[float, float]], lam: float, keep: list[str],
             log_k: float | None = None) -> DataFrame:
    """``keep`` columns with (n_tokens, best, r, total, passages): the best
    normalised score lam * s - ln n; with ``log_k`` the number of significant
    passages, the sum of their normalised scores, and their token spans."""
    known = broadcast(docs.sparkSession, weights)  # what the bounded sample bears out

    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = Weights(known())
        for batch in texts:
            rows = []
            for text in batch:
                words = tokens(text or "")
                hits = [(i, x) for i, w in enumerate(words) if (x := table[w]) is not None]
                found = segments(hits)
                size = math.log(max(len(words), 1))
                scores = [lam * s - size for s, _, _ in found]
                best = max(scores, default=None)
                if log_k is None:
                    rows.append((len(words), best, 0, 0.0, []))
                    continue
                strong = [(x - log_k, a, b) for x, (_, a, b) in zip(scores, found) if x - log_k > 0]
                rows.append((len(words), best, len(strong), sum(x for x, _, _ in strong),
                             [{"first": a, "last": b, "score": x} for x, a, b in strong]))
            yield pd.DataFrame(rows, columns=["n_tokens", "best", "r", "total", "passages"])

    run = F.pandas_udf(scan, "n_tokens int, best double, r int, total double, "
                             "passages array<struct<first:int,last:int,score:double>>")
    out = docs.withColumn("_found", run(F.col("text")))
    return out.select(*keep, "_found.*")


def surprise(log_k: float) -> Column:
    """-ln p of a row of ``evidence``: how unlikely its passages are in clean text."""
    chance = F.exp(-(F.col("best") - log_k))  # passages as good as the best one expected
    one = F.when(chance < 1e-8, -F.log(F.greatest(chance, F.lit(1e-300)))).otherwise(-F.log(1 - F.exp(-chance)))
    r = F.col("r").cast("double")
    lgamma = F.aggregate(F.sequence(F.lit(1), F.greatest("r", F.lit(1))), F.lit(0.0),
                         lambda acc, i: acc + F.log(i.cast("double")))  # ln r!
    together = (F.col("total") - (r - 1) * F.log(F.greatest("total", F.lit(1e-9)))
                + 2 * lgamma - F.log(F.greatest(r, F.lit(1.0))) - math.log(2))  # r! (r-1)!, two tries
    return F.coalesce(F.when(F.col("r") > 1, F.greatest(one, together)).otherwise(one), F.lit(0.0))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of P(y = 1 | x), the slope at least 0; a light ridge
    keeps them finite where the classes are apart."""
    w, ridge = np.zeros(2), 1e-2
    design = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + ridge * w
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.0), float(w[1])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_tokens, passages), a row per row
    of ``docs``."""
    train = training_rows(docs, labels)
    weights = word_weights(train)
    clean = train.where("toxic = 0")
    lam = decay(*weight_shares(clean, weights))
    stats = evidence(clean, weights, lam, []).agg(F.avg("best").alias("mean")).first()
    # lam s - ln n - ln K is standard Gumbel in clean text: its mean is Euler's constant
    log_k = stats.mean - 0.5772156649015329 if stats.mean is not None else 0.0
    known = (evidence(train, weights, lam, ["toxic"], log_k)
             .select("toxic", surprise(log_k).alias("x")).toPandas())  # at most TRAIN_ROWS rows
    slope, offset = logistic(known["x"].to_numpy(float), (known["toxic"] == 1).to_numpy(float)) if weights else (0, -30)
    keep = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"))
    found = evidence(keep, weights, lam, ["doc_id", "held_out"], log_k)
    score = 1 / (1 + F.exp(-(F.lit(slope) * surprise(log_k) + F.lit(offset))))
    return found.select("doc_id", "held_out", score.alias("score"), "n_tokens", "passages").select(
        "doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"),
        "n_tokens", "passages")


def op2_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
