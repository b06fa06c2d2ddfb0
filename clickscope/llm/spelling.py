"""Spelling variant grouping by reduced-alphabet generation.

Words are counted over whole texts. To find the words one edit apart (one code
point inserted, deleted or replaced), every letter is hashed to one of a few
symbols. One edit of a word is at most one edit of its reduced word, so the
reduced forms of two near words are equal or one edit apart. The full one-edit
neighbourhood of each distinct reduced word over the few symbols (about
2 x symbols x length strings, whatever the size of the real alphabet) is
generated and joined with the distinct reduced words there are; the pairs found
are spelled out to the original words, which are verified by edit distance.

A neighbourhood is a set and a word has one reduced form, so each ordered pair
of near words is met exactly once. Only hashes of reduced words are shuffled in
the join (a collision adds candidates, which the verification drops). A
frequent word arrives as one count a task; a reduced word that many words share
is rows of a shuffled join, which the skew join splits, never a list.

A word's form is its most frequent near word, if that is frequent enough; a
form is at least ``ratio`` times as frequent as its word, so following forms
ends after a logarithmic number of steps, found by pointer doubling.

Defined results: a null or empty text has no words; a null doc_id counts as an
empty one; repeated rows count as often as they come; equal counts go to the
smaller word in code-point order; an empty table gives no rows; further columns
are not read. Very long texts are read in slices that end between words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import landed, read_table

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
SYMBOLS = 6
DAMAGE = 199
SLICE = 1 << 20  # code points of a text looked at together
HELD = 200_000  # distinct words a task counts before it sends them on
#: Letters of words, as Latin-1 bytes: A-Z, a-z and U+00C0 to U+00FF.
LETTER = rb"[A-Za-z\xc0-\xff]"
GAP = re.compile("[^A-Za-z\u00c0-\u00ff]")
LOWER = [chr(c) for c in (*range(0x61, 0x7b), *range(0xc0, 0x100))]


def runs(text: str, at_least: int) -> Iterator[list[bytes]]:
    """Maximal letter runs of ``text`` with ``at_least`` code points or more, A-Z
    lower-cased, as Latin-1 bytes, slice by slice."""
    run = re.compile(LETTER + b"{%d,}" % at_least)
    start = 0
    while start < len(text):
        gap = GAP.search(text, min(len(text), start + SLICE))  # no slice ends inside a run
        end = gap.start() if gap else len(text)
        yield run.findall(text[start:end].encode("latin-1", "replace").lower())  # bytes: A-Z only
        start = end


def damaged(run: bytes, doc: bytes) -> bytes:
    """``run``, less one code point where the hash of document and run says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(doc + b":"))
    if h % DAMAGE:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def sent() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in held], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                name = str(doc.as_py()).encode() if doc.is_valid else b""
                for found in runs(text.as_py(), min_length):
                    for run, n in Counter(found).items():
                        held[damaged(run, name)] += n
                if len(held) > HELD:
                    yield sent()
                    held.clear()
        yield sent()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(count, "word string, n long")
    return (rows.where(F.char_length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def reduced(word: Column, symbols: int = SYMBOLS) -> Column:
    """``word`` with every letter replaced by the symbol it hashes to."""
    to = "".join(chr(0x61 + zlib.crc32(x.encode()) % symbols) for x in LOWER)
    return F.translate(word, "".join(LOWER), to)


def neighbourhood(word: Column, symbols: int = SYMBOLS) -> Column:
    """All strings over the symbols at most one edit from ``word``, as a set."""
    size = F.char_length(word)
    letters = F.array(*(F.lit(chr(0x61 + i)) for i in range(symbols)))

    def head(i):
        return F.substring(word, F.lit(1), i)  # the first i symbols

    def tail(i):
        return F.substring(word, i + 1, size)  # all after the first i

    deleted = F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(head(i - 1), tail(i)))
    replaced = F.transform(F.sequence(F.lit(1), size), lambda i: F.transform(
        letters, lambda x: F.concat(head(i - 1), x, tail(i))))
    inserted = F.transform(F.sequence(F.lit(0), size), lambda i: F.transform(
        letters, lambda x: F.concat(head(i), x, tail(i))))
    return F.array_distinct(F.concat(F.array(word), deleted, F.flatten(replaced), F.flatten(inserted)))


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of ``words``
    (word, n; words distinct) that are one edit apart."""
    keyed = words.withColumn("reduced", reduced(F.col("word"), symbols))
    keyed = keyed.withColumn("key", F.xxhash64("reduced"))
    forms = keyed.select("reduced", "key").distinct()
    around = forms.select(F.col("key").alias("from"),
                          F.explode(neighbourhood(F.col("reduced"), symbols)).alias("s"))
    around = around.select("from", F.xxhash64("s").alias("to"))
    met = around.join(forms.select(F.col("key").alias("to")).distinct(), "to", "left_semi").distinct()
    a = keyed.select(F.col("key").alias("from"), "word", "n")
    b = keyed.select(F.col("key").alias("to"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    one_edit = F.levenshtein("word", "near", 1) == 1
    return met.join(a, "from").join(b, "to").where(one_edit).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``forms`` (word, form) ends, for its words."""
    at = landed(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = landed(at.join(step, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
             symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of ``docs``."""
    words = landed(word_counts(docs, min_length, min_count), "spelling-words")
    near = near_words(words, symbols).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best")).alias("best"))
    known = landed(known.select("word", "n", "n_near", F.col("best.near").alias("form"),
                                (-F.col("best.less")).alias("form_n")), "spelling-forms")
    ends = roots(known.where("form is not null"))
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read_table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


# crc32 by its table; near words by equal strings once a letter is left out.
OP12_SQL = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::UBIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
found AS MATERIALIZED (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{6,}')) AS w FROM documents)
  GROUP BY ALL),
hashed AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(list_concat([4294967295::UBIGINT], list_transform(
      string_split(rtrim(regexp_replace(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '(..)', '\\1 ', 'g')), ' '),
      lambda b: ('0x' || b)::UBIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)::BIGINT])), 4294967295::UBIGINT) AS h
  FROM found, crc),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (
  SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, range(1, 64) t(i) WHERE i <= length(word)),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i
  WHERE a.word <> b.word
  UNION SELECT DISTINCT a.word, a.n, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, b.n, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS form, max(m) AS form_n FROM near GROUP BY word),
known AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * w.n THEN b.form END AS form,
         CASE WHEN b.form_n >= 5 * w.n THEN b.form_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
walk(word, place) AS (
  SELECT word, word FROM known
  UNION ALL
  SELECT walk.word, known.form FROM walk JOIN known ON known.word = walk.place WHERE known.form IS NOT NULL),
ends AS (SELECT walk.word, walk.place AS root FROM walk JOIN known ON known.word = walk.place WHERE known.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM known JOIN ends USING (word)
"""
