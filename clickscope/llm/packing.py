"""Best-fit packing of tokenised documents by minimum bin slack.

Documents are tokenised, closed by an end token, and cut into pieces only where
they are longer than a sequence. For one bin after the other, subset-sum
dynamic programming on bitsets over the lengths still available finds the
fullest feasible combination, which is then removed. As every piece must go
somewhere, a bin starts with one piece, and the combination is the fullest one
that holds it. The first piece is the longest left, or one of the length with
most tokens left, and so for the choice among equally full combinations; of
these four plans the one with the fewest sequences is taken.

All pieces of one length are alike, so the search needs the count of each
length alone: at most as many numbers as a sequence has tokens, whatever the
size of the corpus. A combination is removed as often as its lengths last,
which uses one of them up, so there are few more combinations than lengths.
That plan says, for the k-th piece of a length, in which sequence it lies and
where.

Numbering the pieces of a length needs no sort and moves no text: the task that
cuts the pieces counts them by length, the counts of (task, length) are added
up to the place where a task's pieces of a length begin, and a piece's number
is that place plus its count in the task. Pieces are landed between the two
steps. A length that a third of all pieces has is dealt like any other.

Defined results: a null text is empty, an empty text one end token; a null
doc_id stays null; repeated rows are packed once each; rows of one doc_id and
equal texts are alike, and any of them takes any of their places; an empty
table gives no rows; further columns are not read. Very long texts are read in
slices that end between words, and pieces leave as soon as they are full.
"""

from __future__ import annotations

import json
import re
import sys
import types
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from ..plans.joins import broadcast_if_small
from .shared import landed, read_table

LENGTH = 2048
END = 0
TOKENIZER = "word_bpe_49k.json"
SLICE = 1 << 22  # code points split into words together
KNOWN = 1_000_000  # words whose ids a worker remembers
OUT_TOKENS = 1 << 21  # tokens of pieces sent on together
#: Latin letters between marks, each part one pre-token under ``BY_WORD``: no
#: apostrophe (it starts contractions), nothing that special tokens begin with.
PLAIN = re.compile("([!\"#$%&()*,./:;=?@-]*)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!\"#$%&()*,./:;=?@-]*)")
#: The settings of a tokenizer whose ids can be taken word by word.
BY_WORD = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}
PIECES = "doc_id long, piece int, start long, length int, ids binary, task int, nth long"


class Words(dict):
    """Token ids of texts, as little-endian 32-bit numbers, by remembered words.

    Where a tokenizer drops white space and never joins over it, a text's ids
    are those of its words one after the other, and words come again. Texts are
    cut at blanks and line feeds only; other white space is the tokenizer's.
    A word of Latin letters between punctuation marks falls into the same parts
    for every such tokenizer: its parts go to the tokenizer's own model many at
    a time, told apart by the end mark of a part's last token. All other words
    go through the whole tokenizer, and so do whole texts where the tokenizer's
    settings are not the ones this rests on."""

    def __init__(self, path: str):
        super().__init__({"": b""})
        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.by_word = all(settings[k] == v for k, v in BY_WORD.items())
        suffix = settings["model"].get("end_of_word_suffix")
        self.by_word &= bool(suffix) and not any(re.search(r"\s", t["content"]) for t in settings["added_tokens"])
        if self.by_word:
            vocab = self.tokenizer.get_vocab()
            self.closes = np.zeros(max(vocab.values()) + 1, bool)
            self.closes[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
            self.parts = Tokenizer(self.tokenizer.model)
            self.parts.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

    def _learn(self, words: list[str]) -> None:
        whole, composed, other = [], {}, []
        for w in words:
            if w.isascii() and w.isalpha():
                whole.append(w)
            elif m := PLAIN.fullmatch(w):
                composed[w] = [p for p in m.groups() if p]
            else:
                other.append(w)
        whole += {p for parts in composed.values() for p in parts if p not in self}
        if whole:
            together = " ".join(whole).lower()  # Latin letters and marks
            ids = np.array(self.parts.encode_batch_fast([together], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            data = ids.tobytes()
            self.update(zip(whole, (data[a:b] for a, b in zip([0, *ends], ends))))
        for w, parts in composed.items():
            self[w] = b"".join([self[p] for p in parts])
        for w, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            self[w] = np.array(e.ids, "<u4").tobytes()

    def _split(self, texts: list[str]) -> pa.ListArray:
        """The words of texts, in fewer spellings with the same ids: Latin-1 text
        in lower case, marks apart from the letter or digit before them at the
        end of a word (they start a pre-token there)."""
        text = pc.replace_substring(pa.array(texts, pa.string()), "\n", " ")
        other = pc.match_substring_regex(text, r"[^\x00-\x{FF}]|<\|")
        text = pc.if_else(other, text, pc.utf8_lower(text))
        text = pc.replace_substring_regex(text, r"([A-Za-z0-9\x{DF}-\x{F6}\x{F8}-\x{FF}])([,.;:!?]+)( |$)", r"\1 \2\3")
        return pc.split_pattern(text, " ")

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each of ``texts``. Each distinct word is looked up once."""
        if not self.by_word:
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, "<u4") for e in found]
        words = self._split(texts)
        ends = words.offsets.to_numpy()[1:]
        coded = words.flatten().dictionary_encode()
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self) > KNOWN:
            self.clear()
            self[""] = b""
        held = list(map(self.get, distinct))
        new = [i for i, ids in enumerate(held) if ids is None]
        self._learn([distinct[i] for i in new])
        for i in new:
            held[i] = self[distinct[i]]
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        data = np.frombuffer(b"".join(held), "<u4")
        starts, each = np.cumsum(sizes) - sizes, sizes[at]
        upto = np.cumsum(each)
        if not len(upto) or not upto[-1]:
            return [data[:0]] * len(texts)
        ids = data[np.repeat(starts[at] - (upto - each), each) + np.arange(upto[-1])]
        return np.split(ids, np.where(ends > 0, upto[ends - 1], 0)[:-1])


def worker_words(path: str) -> Words:
    """The ``Words`` of this worker process: they outlive a task. (Functions
    travel by value, so a module of their own holds them.)"""
    memory = sys.modules.setdefault("clickscope_worker_words", types.ModuleType("clickscope_worker_words"))
    if path not in vars(memory):
        vars(memory)[path] = Words(path)
    return vars(memory)[path]


def sliced(texts: Iterator[str]) -> Iterator[list[tuple[int, str]]]:
    """(number of the text, slice) of all texts in order, cut between words
    where a text is longer than ``SLICE``, about ``SLICE`` code points at a time."""
    out, size = [], 0
    for number, text in enumerate(texts):
        start = 0
        while True:
            end = text.find(" ", start + SLICE)
            end = len(text) if end < 0 else end
            out.append((number, text[start:end]))
            size += end - start
            if size >= SLICE:
                yield out
                out, size = [], 0
            start = end
            if end == len(text):
                break
    if out:
        yield out


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """``PIECES``: the pieces of ``docs`` (doc_id, text), landed. ``ids`` are
    little-endian 32-bit numbers; ``nth`` counts a task's pieces of a length."""
    full, last = 4 * length, np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, task = worker_words(path), Counter(), TaskContext.get().partitionId()
        rows: list[tuple] = []
        held = 0

        def sent() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids", "task", "nth"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch in batches:
            names, rest, number, current = batch.column(0).to_pylist(), b"", 0, 0

            def add(ids: bytes) -> None:
                nonlocal held
                size = len(ids) // 4
                rows.append((names[current], number, number * length, size, ids, task, seen[size]))
                seen[size] += 1
                held += size

            texts = (t.as_py() or "" for t in batch.column(1))
            for group in sliced(texts):
                for (doc, _), found in zip(group, words.ids([t for _, t in group])):
                    if doc != current:
                        add(rest + last)  # fits: less than a full piece was left
                        rest, number, current = b"", 0, doc
                    data, at = rest + found.tobytes(), 0
                    while len(data) - at >= full:
                        add(data[at:at + full])
                        number, at = number + 1, at + full
                    rest = data[at:]
                    if held > OUT_TOKENS:
                        yield sent()
                        rows, held = [], 0
            if names:
                add(rest + last)
            yield sent()
            rows, held = [], 0

    slim = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return landed(slim.mapInArrow(cut, PIECES), "packing-pieces")


def fullest(counts: dict[int, int], length: int, first: int, order: Callable[[int, int], int]) -> list[tuple[int, int]]:
    """[(piece length, number)]: the fullest combination of available pieces
    that holds one of length ``first`` and fits ``length``; of equally full ones,
    that with the lengths for which ``order`` (length, count) is largest."""
    room, mask = length - first, (1 << (length - first + 1)) - 1
    reach, steps = 1, []  # bit s: some pieces looked at so far fill s tokens
    for size in sorted((s for s in counts if s <= room), key=lambda s: (order(s, counts[s]), s), reverse=True):
        left = min(counts[size] - (size == first), room // size)
        many = 1
        while left > 0:  # 1, 2, 4, ... pieces at once
            many = min(many, left)
            steps.append((size, many, reach))
            reach |= (reach << (size * many)) & mask
            left, many = left - many, 2 * many
        if reach >> room & 1:
            break
    fill, chosen = reach.bit_length() - 1, Counter({first: 1})
    for size, many, before in reversed(steps):
        if not before >> fill & 1:  # not to be had without these pieces
            chosen[size] += many
            fill -= size * many
    return sorted(chosen.items(), reverse=True)


def longest_first(size: int, count: int) -> int:
    return size


def most_tokens_first(size: int, count: int) -> int:
    return size * count


def filled(counts: dict[int, int], length: int, start: Callable[[int, int], int],
           order: Callable[[int, int], int]) -> list[tuple[list[tuple[int, int]], int]]:
    """[(combination, how often)] that places all pieces. A sequence starts with
    the length for which ``start`` (length, count) is largest."""
    left, plan = {s: n for s, n in counts.items() if n}, []
    while left:
        first = max(left, key=lambda s: (start(s, left[s]), s))
        best = fullest(left, length, first, order)
        times = min(left[size] // many for size, many in best)
        plan.append((best, times))
        for size, many in best:
            left[size] -= times * many
            if not left[size]:
                del left[size]
    return plan


def packing_plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[list[tuple[int, int]], int]]:
    """The plan with the fewest sequences, over what sequences start with and
    which of equally full combinations is taken; the search ends at the bound."""
    bound = -(-sum(s * n for s, n in counts.items()) // length)
    ways, best, fewest = (longest_first, most_tokens_first), [], None
    for start, order in product(ways, ways):
        plan = filled(counts, length, start, order)
        sequences = sum(times for _, times in plan)
        if fewest is None or sequences < fewest:
            best, fewest = plan, sequences
        if fewest <= bound:
            break
    return best


def places(plan: list[tuple[list[tuple[int, int]], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, last, per sequence, sequence, offset): where the pieces
    of a length numbered from ``first`` up to ``last`` (not included) go."""
    used: Counter = Counter()
    out, sequence = [], 0
    for combination, times in plan:
        offset = 0
        for size, many in combination:
            out.append((size, used[size], used[size] + times * many, many, sequence, offset))
            used[size] += times * many
            offset += size * many
        sequence += times
    return out


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END,
         plan: Callable[[dict[int, int], int], list] = packing_plan) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): every piece of
    ``docs`` with its token ids and its place."""
    spark = docs.sparkSession
    rows = pieces(docs, path, length, end)
    held = rows.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    held = landed(held.withColumn("begins", before), "packing-counts")
    counts = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.createDataFrame(places(plan(counts, length)),
                                  "length int, first long, last long, many int, sequence long, at int")
    # the stretch of a task's pieces of a length that falls to one combination
    runs = held.join(F.broadcast(slots), "length").where("begins < last and begins + n > first").drop("n")
    runs = broadcast_if_small(landed(runs, "packing-runs"))
    number = F.col("begins") + F.col("nth")
    placed = rows.join(runs, ["task", "length"]).where((number >= F.col("first")) & (number < F.col("last")))
    nth = number - F.col("first")
    within = F.pmod(nth, F.col("many"))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids",
                         (F.col("sequence") + ((nth - within) / F.col("many")).cast("long")).alias("sequence_id"),
                         (F.col("at") + within * F.col("length")).cast("long").alias("offset"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset")
