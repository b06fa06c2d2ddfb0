"""Benchmark decontamination: BM25 retrieval by block-max WAND, then overlap.

The test items are the collection, the training text is the query. Items are
put into an inverted index by word, with BM25 impacts divided by the item's
score for its own text, so that a score is the share of the item's weight that
a passage covers and one threshold fits all items. Items stand in blocks, and
a word's list carries the largest impact in each block.

The collection's statistics (number of items, mean length, texts a word occurs
in) are counted over all items, whatever shard they go to. Items stand in
classes by length, each class up to twice as long as the one before; a training
text is cut for each class into overlapping passages that hold any of its items
whole, and every passage is a query. The most frequent words, as long as no
item has half the threshold in them, are optional: they open no block, their
share is added to every bound. The other words of a passage have their lists
read by WAND: with the lists in order of the block they stand at, the pivot is
the first block where the largest impacts of the lists up to it reach the
threshold; lists before it skip to it, and where they meet the block's own
maxima decide whether its items are scored at all. All items above the
threshold are retrieved (none is cut off). A window of the passage, twice as
long as the item itself, must then hold at least ``OVERLAP`` of the five-word
shingles of the item's question and at least ``ANSWER_OVERLAP`` of the words of
its answer. An item with its text in one column is split before its last
sentence.

The index goes to every task in shards of at most ``SHARD_ITEMS`` items and
``SHARD_CHARS`` characters, so what is broadcast, and what a worker holds, is
bounded; more items mean more shards, each against all documents. Documents are
not shuffled.

Defined results: words are runs of letters and digits, lower-cased; a null or
empty text matches nothing; an item without words, or a null one, is no item;
items that repeat are found each; rows repeat as they are (pairs once for each
row); an empty table on either side gives no pairs; further columns are not
read (the filtering form returns them as they are).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import broadcast, landed, read_table

K1, B = 1.2, 0.75
BLOCK = 16  # items a block
THRESHOLD = 0.5
SHINGLE = 5
OVERLAP = 0.8
ANSWER_OVERLAP = 0.8
SHARD_ITEMS = 20_000
SHARD_CHARS = 32_000_000
PAIRS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def shingles(w: list[str], k: int = SHINGLE) -> set[tuple[str, ...]]:
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def question_and_answer(text: str) -> tuple[str, str]:
    """A text's last sentence is the answer, what stands before the question."""
    parts = SENTENCE.split(text.strip())
    if len(parts) < 2:
        return text, ""
    return " ".join(parts[:-1]), parts[-1]


class Statistics:
    """Counts over a whole collection of items, of the words that are asked for."""

    def __init__(self, n: int, mean: float, df: dict[str, int]):
        self.n, self.mean, self.df = n, mean, df

    @classmethod
    def of(cls, texts: list[list[str]]) -> Statistics:
        return cls(len(texts), sum(map(len, texts)) / max(1, len(texts)), Counter(t for w in texts for t in set(w)))

    def impacts(self, w: list[str]) -> dict[str, float]:
        """BM25 impact of each word of an item, as a share of the item's own score."""
        raw = {t: math.log(1 + (self.n - self.df[t] + 0.5) / (self.df[t] + 0.5))
               * c * (K1 + 1) / (c + K1 * (1 - B + B * len(w) / self.mean)) for t, c in Counter(w).items()}
        own = sum(raw.values())
        return {t: x / own for t, x in raw.items()}


class Index:
    """Inverted index of one shard of items, with block maxima."""

    def __init__(self, items: list[tuple], threshold: float = THRESHOLD, known: Statistics | None = None):
        """``items``: (item_id, question, answer); ``known``: the statistics of
        the collection, those of ``items`` where there is none."""
        self.threshold = threshold
        split = [(i, words(q), words(a)) for i, q, a in items]
        split = sorted(((i, q, a) for i, q, a in split if q or a), key=lambda x: length_class(len(x[1]) + len(x[2])))
        known = known or Statistics.of([q + a for _, q, a in split])
        self.items = [(i, len(q) + len(a), shingles(q), set(a)) for i, q, a in split]
        self.impact = [known.impacts(q + a) for _, q, a in split]
        # blocks of neighbours; a block's items are all of one class
        self.blocks: list[range] = []
        self.class_of: list[int] = []
        for at, (_, n, _, _) in enumerate(self.items):
            size = length_class(n)
            if self.class_of and self.class_of[-1] == size and len(self.blocks[-1]) < BLOCK:
                self.blocks[-1] = range(self.blocks[-1].start, at + 1)
            else:
                self.blocks.append(range(at, at + 1))
                self.class_of.append(size)
        self.optional, spare = self._optional(known)
        self.spare = [max(spare[i] for i in block) for block in self.blocks]
        # word -> class -> (blocks, largest impact in each, largest of all)
        peaks: dict[str, dict[int, dict[int, float]]] = defaultdict(lambda: defaultdict(dict))
        for number, block in enumerate(self.blocks):
            for i in block:
                for t, x in self.impact[i].items():
                    if t not in self.optional:
                        top = peaks[t][self.class_of[number]]
                        top[number] = max(top.get(number, 0.0), x)
        self.lists = {t: {size: (list(top), list(top.values()), max(top.values())) for size, top in classes.items()}
                      for t, classes in peaks.items()}
        self.most_spare = {size: max(x for x, c in zip(self.spare, self.class_of) if c == size)
                           for size in set(self.class_of)}

    def _optional(self, known: Statistics) -> tuple[set[str], list[float]]:
        """The most frequent words, and what each item has in them."""
        where = defaultdict(list)
        for i, weights in enumerate(self.impact):
            for t in weights:
                where[t].append(i)
        spare, out = [0.0] * len(self.impact), set()
        for t in sorted(where, key=lambda t: (-known.df[t], t)):  # the most frequent ones save the most
            if all(spare[i] + self.impact[i][t] <= self.threshold / 2 for i in where[t]):
                out.add(t)
                for i in where[t]:
                    spare[i] += self.impact[i][t]
        return out, spare

    def matches(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """item -> (score, question overlap, answer overlap) of its best passage."""
        found: dict[int, tuple[float, float, float]] = {}
        if not text or not self.items:
            return found
        w, lists = words(text), self.lists
        # by class and stride: the words that open blocks; passage p covers strides p and p + 1
        at: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for i, t in enumerate(w):
            if t in lists:
                for size in lists[t]:
                    at[size][i // size].add(t)
        for size, strides in at.items():
            need = self.threshold - 1e-9
            for p in sorted({max(0, x) for s in strides for x in (s - 1, s)}):
                opened = [lists[t][size] for t in strides.get(p, set()) | strides.get(p + 1, set())]
                if sum(top for _, _, top in opened) + self.most_spare[size] < need:
                    continue
                for block in self._wand(opened, need, self.most_spare[size]):
                    self._score(block, w[p * size:(p + 2) * size], found)
        return found

    def _wand(self, opened: list[tuple], need: float, most_spare: float) -> Iterator[int]:
        """Blocks whose own maxima in the opened lists reach ``need``."""
        cursors = [[blocks[0], 0, blocks, peaks, top] for blocks, peaks, top in opened]
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = most_spare, None
            for c in cursors:
                total += c[4]
                if total >= need:
                    pivot = c[0]
                    break
            if pivot is None:
                return
            if cursors[0][0] == pivot:
                here = [c for c in cursors if c[0] == pivot]
                if sum(c[3][c[1]] for c in here) + self.spare[pivot] >= need:
                    yield pivot
                target = pivot + 1
            else:
                here = [c for c in cursors if c[0] < pivot]
                target = pivot
            for c in here:
                c[1] = bisect_left(c[2], target, c[1])
                c[0] = c[2][c[1]] if c[1] < len(c[2]) else None
            cursors = [c for c in cursors if c[0] is not None]

    def _score(self, block: int, passage: list[str], found: dict) -> None:
        have = set(passage)
        for i in self.blocks[block]:
            score = sum(x for t, x in self.impact[i].items() if t in have)
            if score < self.threshold:
                continue
            _, n, question, answer = self.items[i]
            for start in range(0, max(1, len(passage) - n), n):  # windows that hold the item wherever it stands
                asked, told = overlap(question, answer, passage[start:start + 2 * n])
                if asked >= OVERLAP and told >= ANSWER_OVERLAP:
                    found[i] = max(found.get(i, (0.0, 0.0, 0.0)), (score, asked, told))


def length_class(n: int) -> int:
    """The power of two that ``n`` words fit in, 16 at least."""
    return 1 << max(4, (n - 1).bit_length())


def overlap(question: set[tuple[str, ...]], answer: set[str], window: list[str]) -> tuple[float, float]:
    """Shares of the question's shingles and of the answer's words in a window."""
    have = set(window)
    told = len(answer & have) / len(answer) if answer else 1.0
    if told < ANSWER_OVERLAP or not question:
        return float(not question), told
    if len(next(iter(question))) < SHINGLE:  # short: its words, in a row
        (short,) = question
        return float(any(tuple(window[j:j + len(short)]) == short for j in range(len(window)))), told
    return len(question & shingles(window)) / len(question), told


def item_columns(items: DataFrame) -> DataFrame:
    """(item_id, question, answer, text): either form of a benchmark table."""
    both = {"question", "answer"} <= set(items.columns)
    none = F.lit(None).cast("string")
    return items.select("item_id", *(F.col(c) if both else none.alias(c) for c in ("question", "answer")),
                        none.alias("text") if both else F.col("text"))


def indexes(items: DataFrame, threshold: float = THRESHOLD) -> Iterator[Index]:
    """The index, shard by shard, all with the statistics of the whole collection."""
    rows = item_columns(items)

    def split(row) -> tuple[str, str]:
        return question_and_answer(row.text) if row.text else (row.question or "", row.answer or "")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            found = [words(q) + words(a) for q, a in map(split, batch.itertuples())]
            found = [w for w in found if w]
            df = Counter(t for w in found for t in set(w))
            total = [(None, len(found), sum(map(len, found)))]
            yield pd.DataFrame(total + [(t, c, 0) for t, c in df.items()], columns=["word", "n", "length"])

    counts = landed(rows.mapInPandas(count, "word string, n long, length long")
                    .groupBy("word").agg(F.sum("n").alias("n"), F.sum("length").alias("length")), "benchmark-words")
    total = counts.where("word is null").first()
    if total is None or not total.n:
        return
    size = rows.agg(F.count("*").alias("n"), F.sum(F.length(F.concat_ws("", "question", "answer", "text"))).alias("c")
                    ).first()
    shards = max(1, -(-size.n // SHARD_ITEMS), -(-(size.c or 0) // SHARD_CHARS))
    for shard in range(shards):
        part = rows.where(F.pmod(F.xxhash64("item_id", "question", "answer", "text"), F.lit(shards)) == shard)
        texts = [(r.item_id, *split(r)) for r in part.orderBy("item_id").collect()]  # a bounded shard
        used = {t for _, q, a in texts for t in words(q) + words(a)}
        asked = items.sparkSession.createDataFrame([(t,) for t in used], "word string")
        df = dict(counts.join(F.broadcast(asked), "word", "left_semi").select("word", "n").collect())
        yield Index(texts, threshold, Statistics(total.n, total.length / total.n, df))


def contaminated_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap)."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], PAIRS)
    for index in indexes(items):
        sent = broadcast(spark, index)

        def look(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = sent()
            for batch in batches:
                rows = [(doc_id, index.items[i][0], *x) for doc_id, text in zip(batch["doc_id"], batch["text"])
                        for i, x in index.matches(text).items()]
                yield pd.DataFrame(rows, columns=["doc_id", "item_id", "score", "question_overlap",
                                                  "answer_overlap"]).astype({"doc_id": "Int64"})

        pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
            look, PAIRS)
        out = out.union(pairs)
    return out


def _holds_no_item(sent: Callable[[], Index]) -> Callable:
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = sent()
        for batch in texts:
            yield pd.Series([not index.matches(t) for t in batch], dtype=bool)

    return F.pandas_udf(clean, "boolean")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, as they are. What one shard
    leaves is written before the next, so that a worker holds one index."""
    for number, index in enumerate(indexes(items)):
        if number:
            docs = landed(docs, "decontaminated")
        docs = docs.where(_holds_no_item(broadcast(docs.sparkSession, index))(F.col("text")))
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
