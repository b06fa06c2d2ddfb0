"""Exact removal of repeated byte strings across documents.

A byte goes when a 50-byte string that covers it also starts in a document
with a smaller doc_id. The common strings are read off the Burrows-Wheeler
transform and the common-prefix array of a collection of strings, built column
by column: each round puts one symbol in front of every string of the
collection, sorts the new suffixes from the order of the round before, and
derives their common prefixes from that round's (``ColumnwiseIndex``). What a
round has made is written front to back to the task's files and read once by
the next. The strings of a collection are aligned so that equal 50-byte
strings start in the same column; columns of the transform therefore stay
apart, and merging them, which costs a pass over all columns in every round,
is not needed.

One index over a whole corpus would need a round for every byte of its longest
document. Strings of 50 bytes need far less, so Spark first deals the text out:

1. Anchors. Among the ``GRAM``-byte strings inside any 50 bytes, the one with
   the least hash is an anchor. Equal 50-byte strings have equal anchors. Each
   document bucket sends the hashes of its anchors, packed, to hash buckets;
   those that occur at one place only are dropped.
2. Contexts. Around every remaining anchor a document has a context: all its
   50-byte strings that contain the anchor, at most ``2 * 50 - GRAM`` bytes. The
   distinct contexts of a document bucket, each with the smallest doc_id that
   has it, go to the bucket of their anchor.
3. Index. A bucket folds equal contexts and builds the column-wise index over
   those that share their anchor with a different one; strings within a run of
   common prefixes of 50 or more are the same, and take the smallest doc_id of
   the run. That is exact: strings are compared symbol by symbol, hashes only
   decide what meets where.
4. Removal. The smallest doc_ids go back to the document buckets, which mark
   the strings that start in a smaller document and cut their bytes.

All four use one shuffle of the text (the document buckets). A passage that a
third of all documents share costs one context a document bucket, not one a
document; buckets are hashed and their number follows the session's shuffle
partitions.

Defined results: a null text is an empty one (zero bytes, the hash of nothing);
a null doc_id is neither smaller nor larger than any, so such a row keeps all
its bytes and makes no other lose any; rows that repeat a doc_id do not count
against each other and each lose what smaller doc_ids have; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import buckets, read_table

WINDOW = 50
GRAM = 20
WIDTH = 2 * WINDOW - GRAM  # of a context
SLICE = 1 << 16  # bytes hashed at a time
STEP = 1 << 14  # contexts spread out at a time
M1, M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * M2
    x ^= x >> np.uint64(29)
    return x


def _over(a: np.ndarray, width: int, join) -> np.ndarray:
    """``join`` of ``width`` neighbours from each place on, by doubling."""
    out, size, have = None, 0, 1
    while True:
        if width & 1:
            out = a if out is None else join(out[:len(a) - size], a[size:][:len(out)])
            size += have
        width >>= 1
        if not width:
            return out
        a = join(a[:-have], a[have:])
        have *= 2


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes from each place on."""
    return _over(data.astype(np.uint64) + np.uint64(1), gram,
                 lambda x, y: _mix(x[:len(y)] * M1 + y[:len(x)]))


def anchor_places(data: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the least gram of any ``window`` bytes of ``data``."""
    w = window - gram + 1
    picked, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at in range(0, max(0, len(data) - window + 1), SLICE):  # by the windows' starts
        h = gram_hashes(data[at:at + SLICE + window - 1], gram)
        least = _over(h, w, np.minimum)  # of the window from each place on
        edge = np.zeros(w - 1, np.uint64)
        chosen = np.flatnonzero(_over(np.concatenate([edge, least, edge]), w, np.maximum) == h)
        picked.append(chosen + at)
        hashes.append(h[chosen])
    places, first = np.unique(np.concatenate(picked), return_index=True)
    return places, np.concatenate(hashes)[first]


class Bucket:
    """The documents of one document bucket as one run of bytes."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        ids, texts = table.column("doc_id"), table.column("text").combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.binary())
        self.named = np.asarray(ids.is_valid())
        self.ids = np.asarray(ids.fill_null(np.iinfo(np.int64).min))
        starts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        body = texts.buffers()[2]
        self.data = (np.frombuffer(body, np.uint8) if body else np.empty(0, np.uint8))[starts[0]:starts[-1]]
        self.starts = starts[:-1].astype(np.int64) - starts[0]
        self.ends = starts[1:].astype(np.int64) - starts[0]

    def holder(self, places: np.ndarray) -> np.ndarray:
        """The document that holds each place."""
        return np.searchsorted(self.ends, places, side="right")

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        places, hashes = anchor_places(self.data)
        doc = self.holder(places)
        inside = (places + GRAM <= self.ends[doc]) & (self.ends[doc] - self.starts[doc] >= WINDOW) & self.named[doc]
        return places[inside], hashes[inside]

    def contexts(self, places: np.ndarray) -> dict:
        """Distinct contexts of the anchors at ``places`` and who has them."""
        places = np.sort(places).astype(np.int64)
        doc = self.holder(places)
        lo = np.maximum(self.starts[doc], places + GRAM - WINDOW)
        size = np.minimum(self.ends[doc], places + WINDOW) - lo
        fits = size >= WINDOW
        places, doc, lo, size = places[fits], doc[fits], lo[fits], size[fits]
        # aligned at the anchor, zeros where the document does not reach
        left = lo - (places + GRAM - WINDOW)
        col = np.arange(WIDTH)
        rows = np.empty((len(places), WIDTH), np.uint8)
        for a in range(0, len(places), STEP):
            part = slice(a, a + STEP)
            at = (places[part] + GRAM - WINDOW)[:, None] + col
            rows[part] = self.data[np.clip(at, 0, len(self.data) - 1, out=at)]
            rows[part][(col < left[part, None]) | (col >= (left + size)[part, None])] = 0
        bounds = np.stack([left, left + size], axis=1).astype(np.uint8)
        which, first = _distinct(rows, bounds)
        owner = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(owner, which, self.ids[doc])
        most = np.full(len(first), np.iinfo(np.int64).min)
        np.maximum.at(most, which, self.ids[doc])
        return {"rows": rows[first], "bounds": bounds[first], "owner": owner, "many": most > owner,
                "which": which, "begin": places + GRAM - WINDOW, "doc": doc}


def _row_hash(rows: np.ndarray) -> np.ndarray:
    words = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    words[:, :rows.shape[1]] = rows
    h = np.zeros(len(rows), np.uint64)
    for col in words.view(np.uint64).T:
        h = _mix((h ^ col) * M1)
    return h


def _same(rows: np.ndarray, first: np.ndarray, which: np.ndarray) -> bool:
    """Whether every row equals the first one of its class."""
    return all((rows[a:a + STEP] == rows[first[which[a:a + STEP]]]).all() for a in range(0, len(rows), STEP))


def _distinct(rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each row, first row of each class); equal content, equal class."""
    h = np.empty(len(rows), np.uint64)
    for a in range(0, len(rows), STEP):
        h[a:a + STEP] = _row_hash(np.concatenate([rows[a:a + STEP], bounds[a:a + STEP]], axis=1))
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    which = which.reshape(-1)
    if not (_same(rows, first, which) and _same(bounds, first, which)):  # two contents with one hash
        both = np.concatenate([rows, bounds], axis=1)
        _, first, which = np.unique(both, axis=0, return_index=True, return_inverse=True)
    return which.reshape(-1), first


class ColumnwiseIndex:
    """Suffixes of a collection of aligned strings, sorted column by column.

    Round t puts the symbol of column ``width - t`` in front of the suffixes
    of the round before. Among the strings of one column, sorting stably by
    that symbol sorts the longer suffixes; two neighbours of one symbol share
    one symbol more than the least of the common prefixes that lay between
    them, others share none. A column is written as its part of the
    Burrows-Wheeler transform (the symbols before its suffixes, in order), its
    common prefixes (capped) and the strings in order; only the column before
    is read again.
    """

    FILES = ("front", "common", "string")
    KINDS = (np.uint8, np.uint8, np.int32)

    def __init__(self, rows: np.ndarray, folder: str, cap: int):
        self.rows, self.folder, self.cap = rows, folder, cap
        self.columns = np.ascontiguousarray(rows.T)
        m, self.width = rows.shape
        # the empty suffixes: all alike, in the order of their strings
        self._write(self.width, np.zeros(m), np.arange(m))

    def _path(self, column: int, name: str) -> str:
        return os.path.join(self.folder, f"{name}-{column}")

    def _write(self, column: int, common: np.ndarray, string: np.ndarray) -> None:
        front = self.columns[column - 1][string] if column else np.zeros(len(string))
        for name, kind, col in zip(self.FILES, self.KINDS, (front, common, string)):
            np.asarray(col, kind).tofile(self._path(column, name))

    def read(self, column: int) -> list[np.ndarray]:
        return [np.fromfile(self._path(column, n), k) for n, k in zip(self.FILES, self.KINDS)]

    def insert(self, column: int) -> tuple[np.ndarray, np.ndarray]:
        """The round of ``column``: (common prefixes, strings) in order."""
        symbol, common, string = self.read(column + 1)
        place = np.argsort(symbol, kind="stable")  # where each suffix stood before
        symbol = symbol[place]
        same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
        shared = np.zeros(len(place), np.uint8)
        least = _RangeMin(common)(place[same - 1] + 1, place[same])
        shared[same] = np.minimum(self.cap, 1 + least)
        string = string[place]
        self._write(column, shared, string)
        for name in self.FILES:
            os.remove(self._path(column + 1, name))
        return shared, string


class _RangeMin:
    """Minimum over [a, b] of an array, by doubling spans."""

    def __init__(self, values: np.ndarray):
        self.spans = [values]

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.empty(len(a), np.int64)
        level = np.frexp(b - a + 1)[1] - 1
        for k in range(int(level.max(initial=-1)) + 1):
            if k:
                have = 1 << (k - 1)
                self.spans.append(np.minimum(self.spans[-1][:-have], self.spans[-1][have:]))
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.spans[k][a[at]], self.spans[k][b[at] - (1 << k) + 1])
        return out


def smallest_owner(rows: np.ndarray, bounds: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For distinct contexts, the smallest doc_id that has the 50-byte string
    at each of a context's starts (outside its bounds the context's own)."""
    starts = WIDTH - WINDOW + 1
    out = np.repeat(owner[:, None], starts, axis=1)
    key = _row_hash(rows[:, WINDOW - GRAM:WINDOW])  # the anchor
    _, which, several = np.unique(key, return_inverse=True, return_counts=True)
    some = np.flatnonzero(several[which.reshape(-1)] > 1)
    if not len(some):
        return out
    with tempfile.TemporaryDirectory() as folder:
        index = ColumnwiseIndex(rows[some], folder, WINDOW)
        for column in range(WIDTH - 1, -1, -1):
            common, string = index.insert(column)
            if column >= starts:
                continue
            # strings that share 50 symbols or more from here on stand together
            who = some[string]
            valid = (bounds[who, 0] <= column) & (column + WINDOW <= bounds[who, 1])
            first = np.flatnonzero(np.r_[True, common[1:] < WINDOW])
            low = np.minimum.reduceat(np.where(valid, owner[who], np.iinfo(np.int64).max), first)
            low = np.repeat(low, np.diff(np.r_[first, len(who)]))
            out[who[valid], column] = low[valid]
    return out


def _rows_by(kind: np.ndarray, **columns) -> list[tuple]:
    """(kind, packed columns...) for each value of ``kind``."""
    order = np.argsort(kind, kind="stable")
    kind = kind[order]
    cuts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(kind) else np.empty(0, np.int64)
    cols = [c[order] for c in columns.values()]
    return [(int(kind[a]), *(c[a:b].tobytes() for c in cols))
            for a, b in zip(cuts, np.r_[cuts[1:], len(kind)])]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _packed(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    """(all values of a packed column, number of values in each row)."""
    parts = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    return (np.concatenate(parts) if parts else np.empty(0, kind)), np.array([len(p) for p in parts], np.int64)


BUCKET_ROWS = pa.schema([("home", pa.int32()), ("doc_id", pa.int64()), ("text", pa.binary())])
ANCHORS = pa.schema([("bucket", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
                     ("place", pa.binary()), ("home", pa.int32())])
SHARED = pa.schema([("home", pa.int32()), ("place", pa.binary())])
CONTEXTS = pa.schema([("bucket", pa.int32()), ("rows", pa.binary()), ("bounds", pa.binary()), ("owner", pa.binary()),
                      ("many", pa.binary()), ("number", pa.binary()), ("home", pa.int32())])
OWNERS = pa.schema([("home", pa.int32()), ("number", pa.binary()), ("start", pa.binary()), ("owner", pa.binary())])
RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                    ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _number(table: pa.Table, name: str) -> int:
    return table.column(name)[0].as_py()


def repeated_bytes_removed(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): a row per row
    of ``docs``; ``kept`` is what is left, null unless ``keep_bytes``."""
    n = buckets(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    homes = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("home"),
                        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

    def send_anchors(table: pa.Table) -> pa.Table:
        places, hashes = Bucket(table).anchors()
        kind, rest = hashes % np.uint64(n), hashes // np.uint64(n)
        home = _number(table, "home")
        rows = _rows_by(kind.astype(np.int32), low=rest.astype(np.uint32),
                        high=(rest >> np.uint64(32)).astype(np.uint8), place=places.astype(np.uint32))
        return _table([(*r, home) for r in rows], ANCHORS)

    def meet(table: pa.Table) -> pa.Table:
        low, count = _packed(table, "low", np.uint32)
        high, _ = _packed(table, "high", np.uint8)
        place, _ = _packed(table, "place", np.uint32)
        home = np.repeat(np.asarray(table.column("home")), count)
        key = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[1:] == key[:-1]
        several = order[same[:-1] | same[1:]]
        return _table(_rows_by(home[several], place=place[several]), SHARED)

    def send_contexts(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows or not shared.num_rows:
            return _table([], CONTEXTS)
        got = Bucket(docs).contexts(_packed(shared, "place", np.uint32)[0])
        key = _row_hash(got["rows"][:, WINDOW - GRAM:WINDOW])
        kind = ((key >> np.uint64(17)) % np.uint64(n)).astype(np.int32)
        rows = _rows_by(kind, rows=got["rows"], bounds=got["bounds"], owner=got["owner"], many=got["many"],
                        number=np.arange(len(kind), dtype=np.uint32))
        home, squeeze = _number(docs, "home"), zstandard.ZstdCompressor(level=1)
        return _table([(r[0], *map(squeeze.compress, r[1:]), home) for r in rows], CONTEXTS)

    def find_owners(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor()
        table = pa.table({c: pa.array(map(expand.decompress, table.column(c).to_pylist()), pa.binary())
                          if c not in ("bucket", "home") else table.column(c) for c in table.column_names})
        rows = _packed(table, "rows", np.uint8)[0]
        rows, bounds = rows.reshape(-1, WIDTH), _packed(table, "bounds", np.uint8)[0].reshape(-1, 2)
        (owner, count), many = _packed(table, "owner", np.int64), _packed(table, "many", np.bool_)[0]
        number, home = _packed(table, "number", np.uint32)[0], np.repeat(np.asarray(table.column("home")), count)
        which, first = _distinct(rows, bounds)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, which, owner)
        bounds = bounds[first]
        best = smallest_owner(rows[first], bounds, least)
        # where the smallest owner changes along a context
        column = np.arange(best.shape[1])
        change = np.ones(best.shape, bool)
        change[:, 1:] = best[:, 1:] != best[:, :-1]
        change &= (column >= bounds[:, :1]) & (column + WINDOW <= bounds[:, 1:])
        change[np.arange(len(first)), bounds[:, 0]] = True
        ctx, start = np.nonzero(change)
        value = best[ctx, start]
        head, length = np.searchsorted(ctx, np.arange(len(first))), np.bincount(ctx, minlength=len(first))
        use = np.flatnonzero((best.min(1)[which] < owner) | many)  # someone there loses something
        turns = length[which[use]]
        pick = np.repeat(head[which[use]] - (np.cumsum(turns) - turns), turns) + np.arange(turns.sum())
        sent = np.repeat(use, turns)
        return _table(_rows_by(home[sent], number=number[sent], start=start[pick].astype(np.uint8),
                               owner=value[pick]), OWNERS)

    def cut(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], RESULT)
        bucket = Bucket(docs)
        starts = np.zeros(len(bucket.data), bool)  # of strings that go
        if notes.num_rows:
            places = notes.filter(notes.column("place").is_valid())
            found = notes.filter(notes.column("owner").is_valid())
            got = bucket.contexts(_packed(places, "place", np.uint32)[0])
            number, start, owner = (_packed(found, c, k)[0] for c, k in (
                ("number", np.uint32), ("start", np.uint8), ("owner", np.int64)))
            order = np.argsort(number, kind="stable")
            number, start, owner = number[order].astype(np.int64), start[order], owner[order]
            best = np.repeat(got["owner"][:, None], WIDTH - WINDOW + 1, axis=1)
            column = np.arange(best.shape[1])
            for a in range(0, len(best), STEP):
                part = best[a:a + STEP]
                told = np.zeros(part.shape, bool)
                x, y = np.searchsorted(number, (a, a + STEP))
                told[number[x:y] - a, start[x:y]] = True
                part[number[x:y] - a, start[x:y]] = owner[x:y]
                # a value holds from its start to the next one
                last = np.maximum.accumulate(np.where(told, column, 0), axis=1)
                part[:] = np.take_along_axis(part, last, axis=1)
            for a in range(0, len(got["which"]), STEP):
                which = got["which"][a:a + STEP]
                loses = best[which] < bucket.ids[got["doc"][a:a + STEP]][:, None]
                bounds = got["bounds"][which]
                loses &= (column >= bounds[:, :1]) & (column + WINDOW <= bounds[:, 1:])
                occ, off = np.nonzero(loses)
                starts[got["begin"][a:a + STEP][occ] + off] = True
        # the starts among the last ``WINDOW`` places, at most as many
        turns = np.zeros(len(starts) + 1, np.int8)
        turns[:-1] = starts
        turns[WINDOW:] -= starts[:len(turns) - WINDOW].astype(np.int8) if len(turns) > WINDOW else 0
        gone = np.cumsum(turns[:-1], dtype=np.int8) > 0
        out = []
        for i, (a, b) in enumerate(zip(bucket.starts, bucket.ends)):
            g, body = gone[a:b], bucket.data[a:b]
            spans = int(np.count_nonzero(g[1:] & ~g[:-1]) + (len(g) > 0 and g[0]))
            left = (body[~g] if spans else body).tobytes()
            out.append((int(bucket.ids[i]) if bucket.named[i] else None, len(body), len(body) - len(left), spans,
                        hashlib.sha256(left).hexdigest(), left if keep_bytes else None))
        return _table(out, RESULT)

    at_home = homes.groupBy("home")
    shared = (at_home.applyInArrow(send_anchors, _ddl(ANCHORS))
              .groupBy("bucket").applyInArrow(meet, _ddl(SHARED)))
    contexts = at_home.cogroup(shared.groupBy("home")).applyInArrow(send_contexts, _ddl(CONTEXTS))
    owners = contexts.groupBy("bucket").applyInArrow(find_owners, _ddl(OWNERS))
    notes = shared.unionByName(owners, allowMissingColumns=True)
    return at_home.cogroup(notes.groupBy("home")).applyInArrow(cut, _ddl(RESULT))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return repeated_bytes_removed(docs, keep_bytes=False).drop("kept")
