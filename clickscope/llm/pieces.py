"""SentencePiece encoding and decoding with exact N-best segmentations.

A text becomes a lattice: its nodes are the positions between characters, its
edges the vocabulary pieces that spell the characters between two nodes. A
segmentation is a path, its score the sum of its pieces' scores. A forward
Viterbi pass gives every node the score of the best path from the start; that
is the exact remaining score of a path built backward from the end, so a
backward A-star search pops complete segmentations in order of score.

No piece spans from a character to a following space, nor a character that no
piece spells (it is written as its UTF-8 byte pieces). The lattice of a text
therefore splits at those points into chunks, and the N best segmentations of
the text are the N least sums of the chunks' losses. Only chunks with the N-1
smallest losses to their own runner-up can differ from their best in them:
the Viterbi pass carries the runner-up's score along, and the A-star search
runs for those chunks alone. Chunks are short and repeat: the new ones of a
batch of texts go through the Viterbi pass together, a column of the batch at
a time, and a cache holds the best segmentations of those met lately. The
texts of a batch are put together, and decoded, from those in one step.

The model file is the vocabulary (path a parameter, sent along as bytes of a
fixed size); nothing is trained. Its scores are used as they stand.

Defined results: a null text gives nulls, an empty one no pieces and the one
segmentation of score 0. A literal U+2581 is written in byte
pieces, so decoding is exact for every text. Of equal scores the same one wins
every time. Rows repeat as they are; an empty table gives no rows; added
columns replace columns of the same name, others stay.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import read_table

MODEL = os.environ.get("TOKENIZER_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
NBEST = 4
CACHE = 150_000  # chunks a task remembers
CACHED_CHARS = 24
TOGETHER = 256  # texts of a batch
WORDS = 8192  # chunks of a Viterbi pass
CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")


class Store:
    """Best segmentations of chunks: all ids, how many each has, its score and
    the loss of its runner-up."""

    def __init__(self, ids: np.ndarray, count: np.ndarray, score: np.ndarray, loss: np.ndarray):
        self.ids, self.count, self.score, self.loss = ids, count, score, loss

    def rows(self, which: np.ndarray) -> Store:
        count = self.count[which]
        place = np.repeat(np.cumsum(self.count)[which] - np.cumsum(count), count)
        place += np.arange(len(place))
        return Store(self.ids[place], count, self.score[which], self.loss[which])


class Met:
    """Best segmentations of a batch's texts, each text's chunks in order."""

    def __init__(self, rows: Store, ends: np.ndarray):
        self.chunk_ends = ends  # of each text, after a 0
        self.id_ends = np.r_[0, np.cumsum(rows.count)]  # of each chunk, after a 0
        self.ids, self.scores, self.losses = rows.ids, rows.score.tolist(), rows.loss


class Pieces:
    """Segmentation with one model's pieces and scores."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
                                                or sp.is_unused(i))]
        # U+2581 stands for the space; with spaces in the table, a literal one spells no piece
        self.ids = {sp.id_to_piece(i).replace("▁", " "): i for i in plain}
        self.score = {i: sp.get_score(i) for i in plain}
        self.heads = {p[:n] for p in self.ids for n in range(1, len(p) + 1)}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.spelled = {i: p.encode() for p, i in self.ids.items()} | {
            i: bytes([b]) for b, i in enumerate(self.byte)}
        # a character in byte pieces is worse than any ranked piece
        size = np.array([len(self.spelled.get(i, b"")) for i in range(size)])
        self.spelled_ends = np.cumsum(size)
        self.spelled_size = size
        self.spelled_bytes = np.frombuffer(b"".join([self.spelled.get(i, b"") for i in range(len(size))]), np.uint8)
        self.unknown = min(s for s in self.score.values() if s > -1e8) - 10.0
        self.plain_chars = {p for p in self.ids if len(p) == 1}
        self._fill_table()
        self.cache: dict[str, tuple] = {}
        self.seen: dict[str, int] = {}
        self.store = Store(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0), np.empty(0))
        self.few: dict[tuple[str, int], list] = {}

    def _fill_table(self) -> None:
        """Beginnings of pieces by hash: the piece's id, or -1 for no piece."""
        heads = sorted(self.heads)
        width = max(map(len, heads))
        chars = np.zeros((len(heads), width), np.uint64)
        for i, h in enumerate(heads):
            chars[i, :len(h)] = list(map(ord, h))
        size = np.array(list(map(len, heads)))
        code = np.zeros(len(heads), np.uint64)
        for n in range(width):
            code = np.where(n < size, _step(code, chars[:, n]), code)
        assert len(np.unique(code)) == len(code)
        bits = int(len(heads) * 4).bit_length()
        self.shift = np.uint64(64 - bits)
        self.slots, self.piece = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -2, np.int32)
        ids = np.array([self.ids.get(h, -1) for h in heads], np.int32)
        left, at = np.arange(len(heads)), (code >> self.shift).astype(np.int64)
        self.probes = 0
        while len(left):  # linear probing, all of a round at once
            free = np.flatnonzero(self.piece[at[left]] == -2)
            _, one = np.unique(at[left[free]], return_index=True)
            put = left[free[one]]
            self.slots[at[put]], self.piece[at[put]] = code[put], ids[put]
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            self.probes += 1
        self.scores = np.zeros(max(self.score) + 1)
        for i, x in self.score.items():
            self.scores[i] = x

    def _lookup(self, code: np.ndarray) -> np.ndarray:
        """Ids of beginnings by hash: -1 no piece, -2 no beginning."""
        at = (code >> self.shift).astype(np.int64)
        piece, found = self.piece[at], self.slots[at] == code
        out = np.where(found, piece, np.int32(-2))
        open_ = np.flatnonzero(~found & (piece != -2))
        at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
        for _ in range(self.probes - 1):
            found = self.slots[at[open_]] == code[open_]
            out[open_[found]] = self.piece[at[open_[found]]]
            open_ = open_[~found & (self.piece[at[open_]] != -2)]
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
        return out

    def best_of_all(self, words: list[str]) -> None:
        """Put the best segmentations of short chunks, every character of them
        a piece, into the cache."""
        if len(self.cache) + len(words) > CACHE:
            self.cache.clear()
        ids, count, top, loss = self.viterbi(words)
        ends = np.cumsum(count).tolist()
        for w, a, b, s, x in zip(words, [0, *ends], ends, top.tolist(), loss.tolist()):
            self.cache[w] = (ids[a:b].tobytes(), s, x)

    def viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``forward`` for all of such chunks at once: (ids of the best
        segmentations, their numbers, scores, losses of the runners-up)."""
        size = np.array(list(map(len, words)))
        width = int(size.max())
        chars = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
        none = float("-inf")
        best, second = np.full((width + 1, len(words)), none), np.full((width + 1, len(words)), none)
        back = np.zeros((width + 1, len(words)), np.int8)
        last = np.zeros((width + 1, len(words)), np.int32)
        best[0] = 0.0
        for i in range(width):
            word = np.flatnonzero((size > i) & (best[i] > none))
            code = np.zeros(len(word), np.uint64)
            for j in range(i + 1, width + 1):
                code = _step(code, chars[word, j - 1])
                ids = self._lookup(code)
                alive = ids != -2
                word, code, ids = word[alive], code[alive], ids[alive]
                if not len(word):
                    break
                at = np.flatnonzero(ids >= 0)
                w, score = word[at], self.scores[ids[at]]
                x, y, old = best[i, w] + score, second[i, w] + score, best[j, w]
                second[j, w] = np.maximum(np.maximum(second[j, w], np.minimum(x, old)), y)
                new = np.flatnonzero(x > old)
                best[j, w[new]], back[j, w[new]], last[j, w[new]] = x[new], i, ids[at[new]]
                more = size[word] > j
                word, code = word[more], code[more]
        every = np.arange(len(words))
        top, runner_up = best[size, every], second[size, every]
        steps, at = [], size.copy()
        while at.any():
            steps.append(np.where(at > 0, last[at, every], -1))
            at = np.where(at > 0, back[at, every], 0)
        path = np.ascontiguousarray(np.stack(steps[::-1], axis=1), np.int32)
        count = (path >= 0).sum(1)
        return path[path >= 0], count, top, top - runner_up

    def meet(self, chunks: list[list[str]]) -> Met:
        """The best segmentations of the chunks of some texts."""
        seen, store = self.seen, self.store
        every = list(chain.from_iterable(chunks))
        rows = list(map(seen.get, every))
        if len(store.count) > CACHE or len(store.ids) > CACHE * CACHED_CHARS:  # only those of these texts stay
            known = {c: row for c, row in zip(every, rows) if row is not None}
            store = self.store = store.rows(np.fromiter(known.values(), np.int64, len(known)))
            seen = self.seen = dict(zip(known, range(len(known))))
            rows = list(map(seen.get, every))
        new = list(dict.fromkeys([c for c, row in zip(every, rows) if row is None]))
        odd = [c for c in new if len(c) > CACHED_CHARS or not self.plain_chars.issuperset(c)]
        if odd:
            new = list(set(new).difference(odd))
        new.sort(key=len)
        more = [self.viterbi(new[at:at + WORDS]) for at in range(0, len(new), WORDS)]
        if odd:
            found = [self.best(c) for c in odd]
            more.append((np.frombuffer(b"".join([f[0] for f in found]), np.int32), np.array([len(f[0]) // 4 for f in found]),
                         np.array([f[1] for f in found]), np.array([f[2] for f in found])))
        if more:
            seen.update(zip(chain(new, odd), range(len(store.count), len(store.count) + len(new) + len(odd))))
            store = self.store = Store(*map(np.concatenate, zip((store.ids, store.count, store.score, store.loss), *more)))
        which = np.array([seen[c] if row is None else row for c, row in zip(every, rows)], np.int64)
        for c in odd:
            if len(c) > CACHED_CHARS:
                del seen[c]
        return Met(store.rows(which), np.cumsum([0, *map(len, chunks)]))

    def edges(self, text: str, i: int) -> list[tuple[int, tuple[int, ...], float]]:
        """(end, ids, score) of the pieces that start at ``i``."""
        out, ids, heads = [], self.ids, self.heads
        for j in range(i + 1, len(text) + 1):
            part = text[i:j]
            if part not in heads:
                break
            if part in ids:
                out.append((j, (ids[part],), self.score[ids[part]]))
        if text[i] not in ids:
            out.append((i + 1, tuple(self.byte[b] for b in text[i].encode()), self.unknown))
        return out

    def forward(self, text: str) -> tuple[list[float], float, list]:
        """Best score of every node, the runner-up's at the end, and for every
        node the edge its best path ends with."""
        n, none = len(text), float("-inf")
        best, second, back = [none] * (n + 1), [none] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            a, b = best[i], second[i]
            if a == none:
                continue
            for j, ids, s in self.edges(text, i):
                x = a + s
                second[j] = max(second[j], min(x, best[j]), b + s)
                if x > best[j]:
                    best[j], back[j] = x, (i, ids)
        return best, second[n], back

    def best(self, text: str) -> tuple[bytes, float, float]:
        """(ids as packed int32, score, loss of the runner-up) of a chunk."""
        hit = self.cache.get(text)
        if hit is None:
            score, runner_up, back = self.forward(text)
            path, at = [], len(text)
            while at:
                at, ids = back[at]
                path.append(ids)
            flat = np.array([x for ids in reversed(path) for x in ids], np.int32)
            hit = (flat.tobytes(), score[-1], score[-1] - runner_up)
            if len(text) <= CACHED_CHARS:
                if len(self.cache) >= CACHE:
                    self.cache.clear()
                self.cache[text] = hit
        return hit

    def n_best(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best (score, ids) of a chunk by backward A-star search."""
        known = self.few.get((text, n))
        if known is not None:
            return known
        ahead, _, _ = self.forward(text)
        into: list[list] = [[] for _ in range(len(text) + 1)]
        for i in range(len(text)):
            if ahead[i] > float("-inf"):
                for j, ids, s in self.edges(text, i):
                    into[j].append((i, ids, s))
        # (minus the exact total, newest first, node, score so far, pieces from the node on)
        heap, out, count = [(-ahead[-1], 0, len(text), 0.0, None)], [], 0
        while heap and len(out) < n:
            _, _, at, done, tail = heapq.heappop(heap)
            if not at:
                path = []
                while tail:
                    path += tail[0]
                    tail = tail[1]
                out.append((done, tuple(path)))
                continue
            for i, ids, s in into[at]:
                count -= 1
                heapq.heappush(heap, (-(done + s + ahead[i]), count, i, done + s, (ids, tail)))
        if len(text) <= CACHED_CHARS:
            if len(self.few) >= CACHE // 8:
                self.few.clear()
            self.few[text, n] = out
        return out

    def encode(self, text: str, n: int = NBEST) -> tuple[np.ndarray, list[float], list]:
        """(best ids, scores of the n best, changes): ``changes[r]`` maps the
        chunks in which segmentation r differs from the best to their ids."""
        return self.assemble(CHUNK.findall(" " + text) if text else [], n)

    def assemble(self, chunks: list[str], n: int) -> tuple[np.ndarray, list[float], list]:
        found = [self.best(c) for c in chunks]
        ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
        return ids, *self.least(chunks, sum([f[1] for f in found]), np.array([f[2] for f in found]), n)

    def least(self, chunks: list[str], total: float, loss: np.ndarray, n: int) -> tuple[list[float], list]:
        """(scores, changes) of the n best from the best score and the chunks' losses."""
        # the n least sums of losses; each chosen chunk offers its own n best
        k = min(n - 1, len(loss))
        least = np.argpartition(loss, k - 1)[:k].tolist() if k else []
        sums: list[tuple[float, dict]] = [(0.0, {})]
        for at in sorted(least, key=lambda i: (loss[i], i)):
            options = self.n_best(chunks[at], n)
            more = [(x + options[0][0] - s, (change | {at: path}) if r else change)
                    for x, change in sums for r, (s, path) in enumerate(options)]
            sums = heapq.nsmallest(n, more, key=lambda x: x[0])
        return [total - x for x, _ in sums], [change for _, change in sums]

    def paths(self, text: str, n: int = NBEST) -> list[np.ndarray]:
        """The piece ids of the n best segmentations."""
        ids, _, changes = self.encode(text, n)
        chunks = CHUNK.findall(" " + text) if text else []
        return self.spell_out(ids, changes, np.cumsum([0] + [len(self.best(c)[0]) // 4 for c in chunks]))

    def spell_out(self, ids: np.ndarray, changes: list, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of all segmentations from the best ``ids``, the chunks in
        which each differs and where the best ids of each chunk end, after a 0:
        whole stretches between them are copied."""
        out = []
        for change in changes:
            parts, at = [], 0
            for i in sorted(change):
                parts += [ids[at:ends[i]], np.array(change[i], np.int32)]
                at = ends[i + 1]
            out.append(np.concatenate([*parts, ids[at:]]) if parts else ids)
        return out

    def decode(self, ids) -> str:
        """The text that ``ids`` spell; the space before the first word goes."""
        spelled = self.spelled
        return b"".join([spelled[i] for i in ids]).decode()[1:]

    def spell(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The bytes that ``ids`` spell, cut where each of ``ends`` is."""
        size = self.spelled_size[ids]
        after = np.cumsum(size)
        place = np.repeat(self.spelled_ends[ids] - after, size)
        place += np.arange(len(place))
        spelled = self.spelled_bytes[place].tobytes()
        cuts = [0, *np.r_[0, after][ends].tolist()]
        return [spelled[a:b] for a, b in zip(cuts, cuts[1:])]

    def respells(self, best: np.ndarray, ids) -> bool:
        """Whether ``ids`` spell what the ``best`` ones of a chunk do."""
        spelled = self.spelled
        best = best.tolist()
        return b"".join([spelled[i] for i in ids]) == b"".join([spelled[i] for i in best])


@lru_cache(maxsize=1)
def pieces_of(model: bytes) -> Pieces:
    """``Pieces(model)``, made once a worker, not once a task."""
    return Pieces(model)


def _step(code: np.ndarray, char: np.ndarray) -> np.ndarray:
    """The hash of a text with one more character."""
    code = (code ^ char + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return code ^ code >> np.uint64(29)


ADDED = T.StructType([T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
                      T.StructField("n_best_scores", T.ArrayType(T.DoubleType())),
                      T.StructField("n_best_longer", T.ArrayType(T.IntegerType())),
                      T.StructField("n_best_ids", T.ArrayType(T.ArrayType(T.IntegerType()))),
                      T.StructField("round_trip", T.BooleanType())])


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    """A list array from arrays (None: null) without a Python object a value."""
    ends = np.cumsum([0] + [0 if r is None else len(r) for r in rows]).astype(np.int32)
    values = pa.array(np.concatenate([r for r in rows if r is not None] or [np.empty(0)]), kind)
    null = pa.array([r is None for r in rows] + [False])
    return pa.ListArray.from_arrays(pc.if_else(null, pa.scalar(None, pa.int32()), pa.array(ends)), values)


def _nested(rows: list) -> pa.Array:
    """A list of list arrays (None: null) of int32."""
    ends = np.cumsum([0] + [0 if r is None else len(r) for r in rows]).astype(np.int32)
    null = pa.array([r is None for r in rows] + [False])
    values = _lists([path for r in rows if r is not None for path in r], pa.int32())
    return pa.ListArray.from_arrays(pc.if_else(null, pa.scalar(None, pa.int32()), pa.array(ends)), values)


def encode(docs: DataFrame, model_path: str = MODEL, n: int = NBEST, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``piece_ids`` (array<int>, the best segmentation),
    ``n_best_scores`` (array<double>, best first), ``n_best_longer``
    (array<int>: pieces by which each segmentation is longer than the best),
    ``n_best_ids`` (array<array<int>>: the segmentations, best first) and
    ``round_trip`` (decoding any of them gives the text back); without the text
    itself unless ``keep_text``."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    rest = docs.drop(*ADDED.names)
    place = rest.columns.index("text")
    kept = [i for i in range(len(rest.columns)) if keep_text or i != place]

    def row(pieces: Pieces, text: str | None, chunks: list[str], met: Met, number: int, spelled: bytes) -> tuple:
        if text is None:
            return None, None, None, None, None
        a, b = met.chunk_ends[number:number + 2]
        first, last = met.id_ends[a], met.id_ends[b]
        ids, ends = met.ids[first:last], met.id_ends[a:b + 1] - first
        scores, changes = pieces.least(chunks, sum(met.scores[a:b]), met.losses[a:b], n)
        longer = [sum(len(p) - int(ends[i + 1] - ends[i]) for i, p in c.items()) for c in changes]
        paths = pieces.spell_out(ids, changes, ends)
        # segmentations share all but their changed chunks: those are decoded again
        same = spelled[1:] == text.encode() and all(
            pieces.respells(ids[ends[i]:ends[i + 1]], p) for c in changes for i, p in c.items())
        return ids, np.array(scores), np.array(longer), paths, same

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                texts = part.column(place).to_pylist()
                chunks = [CHUNK.findall(" " + t) if t else [] for t in texts]
                met = pieces.meet(chunks)
                spelled = pieces.spell(met.ids, met.id_ends[met.chunk_ends[1:]])
                ids, scores, longer, paths, same = zip(*(
                    row(pieces, t, c, met, i, x) for i, (t, c, x) in enumerate(zip(texts, chunks, spelled))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in kept), _lists(ids, pa.int32()), _lists(scores, pa.float64()),
                     _lists(longer, pa.int32()), _nested(paths), pa.array(same, pa.bool_())],
                    names=[*(part.schema.names[i] for i in kept), *ADDED.names])

    return rest.mapInArrow(work, T.StructType([*(rest.schema.fields[i] for i in kept), *ADDED.fields]))


def decode(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``encoded`` with ``decoded`` (the text spelled by ``piece_ids``) and
    ``n_best_decoded`` (the texts spelled by each of ``n_best_ids``)."""
    with open(model_path, "rb") as f:
        model = encoded.sparkSession.sparkContext.broadcast(f.read())

    def best(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces(model.value)
        for batch in batches:
            yield pd.Series([None if ids is None else pieces.decode(ids.tolist()) for ids in batch])

    def every(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = Pieces(model.value)
        for batch in batches:
            yield pd.Series([None if paths is None else [pieces.decode(p.tolist()) for p in paths] for paths in batch])

    return encoded.withColumns({"decoded": F.pandas_udf(best, "string")(F.col("piece_ids")),
                                "n_best_decoded": F.pandas_udf(every, "array<string>")(F.col("n_best_ids"))})


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, keep_text=False).select(
        "doc_id", F.size("piece_ids").alias("n_pieces"), "piece_ids", "n_best_scores",
        "n_best_longer", "n_best_ids", "round_trip")
