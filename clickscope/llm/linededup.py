"""Fuzzy line deduplication by MinHash, with exact verification.

A line is compared in normal form (lower case, no white space around it
and one space for each run of it inside).
Its set of ``SHINGLE``-character shingles has a MinHash signature of ``BANDS``
bands of ``ROWS`` minima; at a similarity of ``SIMILARITY`` two lines share a
band with probability 1 - (1 - 0.8 ** 3) ** 10 = 0.9992. Lines that share a band
meet, their exact Jaccard similarity is computed from their texts, links of at
least ``SIMILARITY`` are joined by distributed union-find (``components``), and
of every component one line stays: the first by doc_id and line number.

Documents are dealt into hashed buckets (one shuffle of the text, used by all
steps); a bucket folds equal lines into one node. Band keys travel packed, each
with a 64-bit name of its line, so that equal lines of different buckets, which
share all their keys, are one node wherever they meet: the first. Nodes that
meet in a band form a group; a group of up to ``GROUP`` nodes is verified pair
by pair, and only a spanning forest of its links is sent on; groups with the
same smallest node meet in one task, so that a text is sent and cut into
shingles there once for all of them. A larger group is
cut into parts of that size, each of which also holds the group's smallest
node: nodes that link to it are joined through it, in linear work. Those that
do not are then held, ``BLOCK`` at a time, against every block of their group,
so no link is lost.

Defined results: blank lines are no lines for this purpose and stay, unless
nothing else is left of the text, which is then empty; a line shorter than a
shingle is its own shingle; a null text stays null; rows without a doc_id come
after all others in the order that picks the line to stay; repeated rows are
documents of their own, in that order; an empty table gives no rows; all
columns are returned, ``text`` and ``n_chars`` (where there is one) as they are
after the removal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import buckets, components, landed, read_table, under_other_names

SHINGLE = 8
ROWS, BANDS = 3, 10
SIMILARITY = 0.8
GROUP = 64
BLOCK = 512
FEW = 8  # nodes compared pair by pair, more by a matrix product
HELD = 1 << 18  # hashes in a matrix product
SLICE = 1 << 16  # bytes hashed at a time
M1, M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(11).integers(0, 1 << 32, (ROWS * BANDS, 2), dtype=np.uint64)
FACTORS, OFFSETS = (_ODD[:, 0] | np.uint64(1)).astype(np.uint32), _ODD[:, 1].astype(np.uint32)


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingle_set(line: str, k: int = SHINGLE) -> set[str]:
    return {line[i:i + k] for i in range(len(line) - k + 1)} or {line}


def signatures(lines: list[str]) -> np.ndarray:
    """MinHash minima (line, hash) of lines in normal form, none empty."""
    out = np.empty((len(lines), ROWS * BANDS), np.uint32)
    # characters as 32-bit words, each line followed by zeros
    at = 0
    while at < len(lines):
        end, size = at, 0
        while end < len(lines) and (end == at or size < SLICE):
            size += len(lines[end]) + SHINGLE
            end += 1
        part = lines[at:end]
        gap = "\0" * (SHINGLE - 1)
        x = np.frombuffer((gap.join(part) + gap).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        width = 1
        while width < SHINGLE:  # hashes of 2, 4, 8 characters from each place on
            x = x[:-width] * M1 + x[width:]
            x *= M2
            x ^= x >> np.uint64(31)
            width *= 2
        length = np.array([len(line) for line in part])
        start = np.concatenate([[0], np.cumsum(length + SHINGLE - 1)[:-1]])
        count = np.maximum(1, length - SHINGLE + 1)
        keep = np.repeat(start - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        h = (x[keep] >> np.uint64(32)).astype(np.uint32)
        cuts = np.concatenate([[0], np.cumsum(count)[:-1]])
        mixed = np.empty_like(h)
        for i, (a, b) in enumerate(zip(FACTORS, OFFSETS)):
            np.multiply(h, a, out=mixed)
            mixed += b
            out[at:end, i] = np.minimum.reduceat(mixed, cuts)
        at = end
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit keys (line, band)."""
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(sig), axis=0) * M2
    for r in range(ROWS):
        key = (key ^ sig[:, r::ROWS].astype(np.uint64)) * M1
        key ^= key >> np.uint64(29)
    return key


class Bucket:
    """Documents of one bucket in order; lines are numbered through them."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])  # nulls last
        self.texts = self.table.column("text")
        count = pc.if_else(pc.greater(pc.binary_length(self.texts), 0),
                           pc.add(pc.count_substring(self.texts, "\n"), 1), 0)
        self.ends = np.cumsum(np.asarray(pc.fill_null(count, 0)), dtype=np.int64)

    def rows(self, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document's place, number inside it) of lines."""
        row = np.searchsorted(self.ends, lines, side="right")
        return row, lines - np.r_[0, self.ends][row]

    def ids(self, row: np.ndarray) -> pa.Array:
        return pc.take(self.table.column("doc_id"), pa.array(row)).combine_chunks()

    def normal_lines(self) -> tuple[dict[str, int], list[int], list[int]]:
        """Lines in normal form and where they are first; later ones; lines
        that are not blank of each document."""
        first: dict[str, int] = {}
        later, counts, at = [], [], 0
        for text in self.texts:
            some = 0
            text = text.as_py()
            for line in text.split("\n") if text else ():
                line = " ".join(line.lower().split())
                if line:
                    some += 1
                    if first.setdefault(line, at) != at:
                        later.append(at)
                at += 1
            counts.append(some)
        return first, later, counts


def shingle_hashes(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    out, end = [], 0
    while end < len(texts):
        part, size = [], 0
        while end < len(texts) and (not part or size < SLICE):
            part.append(texts[end])
            size += len(texts[end]) + SHINGLE
            end += 1
        gap = "\0" * (SHINGLE - 1)
        x = np.frombuffer((gap.join(part) + gap).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        width = 1
        while width < SHINGLE:
            x = x[:-width] * M1 + x[width:]
            x *= M2
            x ^= x >> np.uint64(31)
            width *= 2
        at = 0
        for t in part:
            h = np.sort(x[at:at + max(1, len(t) - SHINGLE + 1)])
            out.append(h[np.concatenate(([True], h[1:] != h[:-1]))])
            at += len(t) + SHINGLE - 1
    return out


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def similar_pairs(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Which sets of ``a`` (rows) and ``b`` reach ``SIMILARITY``; a range of
    hashes at a time, so that memory is bounded whatever the sets' size."""
    size_a, size_b = np.array(list(map(len, a))), np.array(list(map(len, b)))
    common = np.zeros((len(a), len(b)))
    ranges = int(size_a.sum() + size_b.sum()) // HELD + 1
    width = ((1 << 64) - 1) // ranges + 1
    for r in range(ranges):
        if ranges > 1:
            low = np.uint64(r * width)
            cut = [x[np.searchsorted(x, low):] for x in (*a, *b)]
            if r < ranges - 1:
                cut = [x[:np.searchsorted(x, np.uint64((r + 1) * width))] for x in cut]
        else:
            cut = [*a, *b]
        both = np.concatenate(cut)
        order = np.argsort(both, kind="stable")
        who = np.repeat(np.arange(len(cut)), list(map(len, cut)))[order]
        both = both[order]
        if not len(both):
            continue
        kind = np.cumsum(np.r_[0, both[1:] != both[:-1]])
        left = who < len(a)
        shared = (np.bincount(kind, left) > 0) & (np.bincount(kind, ~left) > 0)
        use = shared[kind]
        kind, who, left = (np.cumsum(shared) - 1)[kind[use]], who[use], left[use]
        for at in range(0, int(shared.sum()), 2048):
            x, y = np.searchsorted(kind, (at, at + 2048))
            wide = np.zeros((len(cut), 2048), np.float32)
            wide[who[x:y], kind[x:y] - at] = 1
            common += wide[:len(a)] @ wide[len(a):].T
    return common / (size_a[:, None] + size_b - common) >= SIMILARITY


def spanning(linked: np.ndarray, joined: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (from, to) that span the components of a graph; no place is the
    end of two. Those of ``joined`` are in one component as it is."""
    fresh = np.ones(len(linked), bool)
    out = []
    for start in range(len(linked)):
        todo = [start] if fresh[start] else []
        fresh[start] = False
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & fresh)
            if joined is not None and (joined[at] or joined[new].any()):
                todo += [*new[~joined[new]].tolist(), *np.flatnonzero(joined & fresh).tolist()]
                new = np.r_[new[~joined[new]], new[joined[new]][:not joined[at]]]
                fresh &= ~joined
                joined = None
            else:
                todo += new.tolist()
            fresh[new] = False
            out += [(at, j) for j in new.tolist()]
    return out


def forest(sets: list[np.ndarray], units: list[list[int]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Links of at least ``SIMILARITY`` inside ``units`` (places of ``sets``)
    that span the components, and the places not linked to the first directly."""
    if len(sets) > FEW:
        meet = np.zeros((len(sets), len(sets)), bool)
        for unit in units:
            meet[np.ix_(unit, unit)] = True
        linked = similar_pairs(sets, sets) & meet
        return spanning(linked), np.flatnonzero(~linked[0]).tolist()
    size = list(map(len, sets))
    part = list(range(len(sets)))
    links, apart = [], []
    for i, j in sorted({(i, j) for unit in units for j in unit for i in unit if i < j}):
        if i and part[i] == part[j]:
            continue
        low, high = sorted((size[i], size[j]))
        if low >= SIMILARITY * high and similarity(sets[i], sets[j]) >= SIMILARITY:
            links.append((i, j))
            old = part[j]
            part = [part[i] if x == old else x for x in part]
        elif not i:
            apart.append(j)
    return links, apart


BANDS_OUT = pa.schema([("bucket", pa.int32()), ("home", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
                       ("name", pa.binary()), ("line", pa.binary()), ("doc_id", pa.binary()), ("named", pa.binary()),
                       ("line_no", pa.binary()), ("later", pa.binary()), ("counts", pa.binary())])
MEMBERS = pa.schema([("unit", pa.int64()), ("hot", pa.int64()), ("route", pa.int64()), ("home", pa.int32()),
                     ("line", pa.int32()), ("copy_of", pa.int64()), ("doc_id", pa.int64()), ("line_no", pa.int32()),
                     ("later", pa.binary()), ("counts", pa.binary())])
TEXTS = pa.schema([("unit", pa.int64()), ("hot", pa.int64()), ("route", pa.int64()), ("side", pa.int32()), ("node", pa.int64()),
                   ("doc_id", pa.int64()), ("line_no", pa.int32()), ("line_text", pa.string())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hot", pa.int64()), ("node", pa.int64()),
                   ("doc_id", pa.int64()), ("line_no", pa.int32())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _filled(schema: pa.Schema, **columns) -> pa.Table:
    """A table of these columns, the others null."""
    rows = len(columns["home"])
    return pa.table([columns[f.name] if isinstance(columns.get(f.name), pa.ChunkedArray) else
                     pa.array(columns[f.name], f.type) if f.name in columns else
                     pa.nulls(rows, f.type) for f in schema], schema=schema)


def _unpacked(table: pa.Table, name: str, kind) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    return (np.concatenate(parts) if parts else np.empty(0, kind)), np.array([len(p) for p in parts], np.int64)


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def _name(*parts: int) -> int:
    """A 64-bit name of a sequence of numbers."""
    h = 0x51ED270B
    for x in parts:
        h = ((h ^ (x & (1 << 64) - 1)) * 0xD6E8FEB86659FD93 + 0x9E3779B97F4A7C15) & (1 << 64) - 1
        h ^= h >> 29
    return _signed(h)


def deduplicated_lines(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``docs`` with the lines that stay, and ``n_lines`` and ``n_removed``."""
    n = 2 * buckets(docs.sparkSession)  # a task holds its bucket's lines as Python strings
    rest = [c for c in docs.columns if c != "text"]
    homes = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("home"),
                        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"))
    at_home = homes.groupBy("home")
    texts_at_home = homes.select("home", "doc_id", "text").groupBy("home")

    def send_bands(table: pa.Table) -> pa.Table:
        bucket = Bucket(table)
        first, later, counts = bucket.normal_lines()
        home = table.column("home")[0].as_py()
        note = (home % n, home, *[None] * 7, np.array(later, np.uint32).tobytes(), np.array(counts, np.uint32).tobytes())
        if not first:
            return _table([note], BANDS_OUT)
        name = np.frombuffer(b"".join(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                                      for t in first), np.uint64)
        lines = np.array(list(first.values()))
        row, line_no = bucket.rows(lines)
        ids = bucket.ids(row)
        named, ids = np.asarray(ids.is_valid()), np.asarray(ids.fill_null(0))
        key = band_keys(signatures(list(first))).T.reshape(-1)  # the first band's, then the second's
        which = np.tile(np.arange(len(lines)), BANDS)
        kind, key = (key % np.uint64(n)).astype(np.int32), key // np.uint64(n)
        order = np.argsort(kind, kind="stable")
        kind, key, which, band = kind[order], key[order], which[order], order // len(lines)
        low, high = key.astype(np.uint32), (key >> np.uint64(32)).astype(np.uint32)
        cuts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True])
        out = [note]
        for a, b in zip(cuts, cuts[1:]):
            every = which[a:b]
            once = every[:np.searchsorted(band[a:b], 1)]  # where a line is goes with its first key
            out.append((int(kind[a]), home, low[a:b].tobytes(), high[a:b].tobytes(), name[every].tobytes(),
                        lines[every].astype(np.uint32).tobytes(), ids[once].astype(np.int64).tobytes(), named[once].tobytes(),
                        line_no[once].astype(np.int32).tobytes(), None, None))
        return _table(out, BANDS_OUT)

    def meet(table: pa.Table) -> pa.Table:
        noted = pc.is_valid(table.column("later"))
        notes, table = table.filter(noted), table.filter(pc.invert(noted))
        low, count = _unpacked(table, "low", np.uint32)
        high, _ = _unpacked(table, "high", np.uint32)
        name, _ = _unpacked(table, "name", np.uint64)
        line, _ = _unpacked(table, "line", np.uint32)
        doc_id, placed = _unpacked(table, "doc_id", np.int64)
        named, _ = _unpacked(table, "named", np.bool_)
        line_no, _ = _unpacked(table, "line_no", np.int32)
        node = np.repeat(np.asarray(table.column("home")).astype(np.int64), count) << 32 | line.astype(np.int64)
        # the number of its place (doc_id and so on), or -1
        inside = np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)
        place = np.where(inside < np.repeat(placed, count), inside + np.repeat(np.cumsum(placed) - placed, count), -1)
        key = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
        order = np.lexsort((node, name, key))
        key, name, node, place = key[order], name[order], node[order], place[order]
        # equal lines of different buckets are one node, the smallest
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
        lead = np.flatnonzero(new)
        size = np.diff(np.r_[lead, len(key)])
        copies = np.flatnonzero((np.repeat(size, size) > 1) & (place >= 0))
        copy_of = np.repeat(node[lead], size)[copies]
        key, single = key[lead], node[lead]
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True]) if len(key) else np.empty(0, np.int64)
        units, hots, routes, nodes, seen = [], [], [], [], set()

        def add(unit: int, hot: int | None, route: int, members: list[int]) -> None:
            units.extend([unit] * len(members))
            hots.extend([hot] * len(members))
            routes.extend([route] * len(members))
            nodes.extend(members)

        for g in np.flatnonzero(np.diff(cuts) > 1):
            members = sorted(single[cuts[g]:cuts[g + 1]].tolist())
            few = len(members) <= group
            unit = _name(*members) if few else _name(members[0], members[-1], len(members), int(key[cuts[g]]))
            if unit in seen:
                continue
            seen.add(unit)
            if few:
                add(unit, None, members[0], members)
                continue
            for part in range(0, len(members) - 1, group - 1):  # each part with the smallest node
                add(_name(unit, part), unit, _name(unit, part), [members[0], *members[1 + part:part + group]])
        nodes = np.array(nodes, np.int64)
        at = place[copies]
        return pa.concat_tables([
            _filled(MEMBERS, unit=units, hot=hots, route=routes, home=(nodes >> 32).astype(np.int32),
                    line=(nodes & 0xFFFFFFFF).astype(np.int32)),
            _filled(MEMBERS, home=(node[copies] >> 32).astype(np.int32), line=(node[copies] & 0xFFFFFFFF).astype(np.int32),
                    copy_of=copy_of, doc_id=pa.array(doc_id[at], mask=~named[at]), line_no=line_no[at]),
            _filled(MEMBERS, home=notes.column("home"), later=notes.column("later"), counts=notes.column("counts"))])

    def fetch(table: pa.Table, asked: pa.Table) -> pa.Table:
        if not table.num_rows or not asked.num_rows:
            return _table([], TEXTS)
        bucket = Bucket(table)
        home = table.column("home")[0].as_py()
        lines = np.unique(np.asarray(asked.column("line")).astype(np.int64))
        row, line_no = bucket.rows(lines)
        found, last = {}, -1
        for line, r, at, doc_id in zip(lines.tolist(), row.tolist(), line_no.tolist(), bucket.ids(row).to_pylist()):
            if r != last:
                split, last = bucket.texts[r].as_py().split("\n"), r
            found[line] = doc_id, at, normal(split[at])
        out, sent = [], set()
        columns = (asked.column(c).to_pylist() for c in ("unit", "hot", "route", "side", "line"))
        for unit, hot, route, side, line in sorted(set(zip(*columns)), key=lambda r: (r[2], r[0], r[3], r[4])):
            doc_id, at, text = found[line]
            # a route's text once, whatever number of its units hold the line
            out.append((unit, hot, route, side, home << 32 | line, doc_id, at, None if (route, line) in sent else text))
            sent.add((route, line))
        return _table(out, TEXTS)

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("route", "unit", "side", "node")])
        routes, units, sides, nodes, hots, doc_ids, line_nos, texts = (table.column(c).to_pylist() for c in (
            "route", "unit", "side", "node", "hot", "doc_id", "line_no", "line_text"))
        cuts = [i for i in range(len(routes)) if not i or routes[i] != routes[i - 1]] + [len(routes)]
        out, tos, froms = [], set(), {}
        shingles, known = {}, 0
        for a, b in zip(cuts, cuts[1:]):
            if a >= known:  # the shingles of some routes are held at a time
                chars, text_of = 0, {}
                while known < len(routes) and (known < b or chars < SLICE):
                    if texts[known] is not None:
                        text_of[nodes[known]] = texts[known]
                        chars += len(texts[known])
                    known += 1
                known = next(c for c in cuts if c >= known)
                text_of |= {x: t for x, t in zip(nodes[a:known], texts[a:known]) if t is not None}
                shingles = dict(zip(text_of, shingle_hashes(list(text_of.values()))))
            place = {x: (d, i) for x, d, i in zip(nodes[a:b], doc_ids[a:b], line_nos[a:b])}
            own = sorted(place)
            at = {x: i for i, x in enumerate(own)}
            sets = [shingles[x] for x in own]
            if sides[b - 1]:  # 1: some against 2 and 3 (2: those that are joined)
                by_side = [[at[x] for x, y in zip(nodes[a:b], sides[a:b]) if y in which] for which in ((1,), (2, 3), (2,))]
                linked, joined = np.zeros((len(own), len(own)), bool), np.zeros(len(own), bool)
                if by_side[0] and by_side[1]:
                    linked[np.ix_(*by_side[:2])] = similar_pairs(*([sets[i] for i in x] for x in by_side[:2]))
                joined[by_side[2]] = True
                links = spanning(linked | linked.T, joined)
            else:
                inside: dict[int, list[int]] = {}
                for x, unit in zip(nodes[a:b], units[a:b]):
                    inside.setdefault(unit, []).append(at[x])
                links, apart = forest(sets, list(inside.values()))
                if hots[a] is not None:
                    out += [(None, None, hots[a], own[i], None, None) for i in apart]
            for i, j in links:  # each with the place of its end
                out.append((own[i], own[j], None, own[j], *place[own[j]]))
                tos.add(own[j])
                froms[own[i]] = place[own[i]]
        out += [(None, None, None, x, *where) for x, where in froms.items() if x not in tos]
        return _table(out, LINKS)

    def verified(asked: DataFrame) -> DataFrame:
        texts = texts_at_home.cogroup(asked.groupBy("home")).applyInArrow(fetch, _ddl(TEXTS))
        # many small units a task; a hashed bucket holds a bounded share of them
        by_bucket = texts.groupBy(F.pmod(F.xxhash64("route"), F.lit(n)))
        return landed(by_bucket.applyInArrow(verify, _ddl(LINKS)), "lines-links")

    met = landed(texts_at_home.applyInArrow(send_bands, _ddl(BANDS_OUT))
                 .groupBy("bucket").applyInArrow(meet, _ddl(MEMBERS)), "lines-groups")
    members = met.where("unit is not null")
    found = verified(members.select("unit", "hot", "route", F.lit(0).alias("side"), "home", "line"))
    apart = found.where("hot is not null").select("hot", "node").distinct()
    if apart.limit(1).count():
        # those not linked to the smallest node of a large group, against all of the group
        every = members.where("hot is not null").select(
            "hot", F.shiftleft(F.col("home").cast("long"), 32).bitwiseOR(F.col("line").cast("long")).alias("node")).distinct()
        blocks = lambda df, name: df.groupBy("hot").agg(F.ceil(F.count("*") / BLOCK).alias(name))
        count = blocks(apart, "n_odd").join(blocks(every, "n_all"), "hot")

        def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
            block = F.pmod(F.xxhash64("node"), F.col(own))
            against = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))
            both = df.join(count, "hot").select("hot", "node", "side", block.alias("own"), against.alias("other"))
            unit = F.xxhash64("hot", *(("own", "other") if own == "n_odd" else ("other", "own")))
            return both.select(unit.alias("unit"), F.lit(None).cast("long").alias("hot"), unit.alias("route"),
                               "side", F.shiftright("node", 32).cast("int").alias("home"),
                               F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("line"))

        odd = apart.withColumn("side", F.lit(1))
        every = every.join(odd.withColumnRenamed("side", "odd"), ["hot", "node"], "left").withColumn(
            "side", F.when(F.col("odd").isNull(), 2).otherwise(3))
        found = found.union(verified(dealt(odd, "n_odd", "n_all").union(dealt(every, "n_all", "n_odd"))))

    roots = components(found.where("a is not null"))
    copies = met.where("copy_of is not null").select(
        "copy_of", F.shiftleft(F.col("home").cast("long"), 32).bitwiseOR(F.col("line").cast("long")).alias("node"), "doc_id", "line_no")
    places = (found.where("line_no is not null").select(F.col("node").alias("copy_of"), "node", "doc_id", "line_no")
              .union(copies).distinct().join(roots.withColumnRenamed("node", "copy_of"), "copy_of", "left"))
    places = landed(places.select("node", "doc_id", "line_no", F.coalesce("root", "copy_of").alias("root")), "lines-roots")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "line_no", "node")
    stays = places.groupBy("root").agg(F.min(order).alias("first")).select("root", F.col("first.node").alias("keeper"))
    gone = places.join(stays, "root").where("node != keeper").select(
        F.shiftright("node", 32).cast("int").alias("home"),
        F.col("node").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("line"))
    notes = gone.unionByName(met.where("counts is not null").select("home", "later", "counts"), allowMissingColumns=True)

    def cut(table: pa.Table, notes: pa.Table) -> pa.Table:
        bucket = Bucket(table)
        later, _ = _unpacked(notes.filter(pc.is_valid(notes.column("later"))), "later", np.uint32)
        counts, _ = _unpacked(notes.filter(pc.is_valid(notes.column("counts"))), "counts", np.uint32)
        gone = pc.drop_null(notes.column("line")).to_numpy().astype(np.int64)
        # lines already kept, or kept elsewhere
        row, line_no = bucket.rows(np.unique(np.r_[later.astype(np.int64), gone]))
        removed = np.bincount(row, minlength=table.num_rows)
        texts = bucket.texts.to_pylist()
        ends = np.cumsum(removed)
        for r in np.flatnonzero(removed).tolist():
            drop = set(line_no[ends[r] - removed[r]:ends[r]].tolist())
            left = [x for i, x in enumerate(texts[r].split("\n")) if i not in drop]
            texts[r] = "\n".join(left) if counts[r] > removed[r] else ""
        return pa.table({"rest": bucket.table.column("rest"), "text": pa.array(texts, pa.string()),
                         "n_lines": pa.array(counts, pa.int32()), "n_removed": pa.array(removed, pa.int32())})

    schema = T.StructType([homes.schema["rest"], T.StructField("text", T.StringType()),
                           T.StructField("n_lines", T.IntegerType()), T.StructField("n_removed", T.IntegerType())])
    out = at_home.cogroup(notes.groupBy("home")).applyInArrow(cut, schema)
    keep = [F.col("text") if c == "text" else
            F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("rest.n_chars")).cast(
                docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else
            F.col(f"rest.`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    return out.select(*keep, "n_lines", "n_removed")


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that stay."""
    return under_other_names(docs, deduplicated_lines)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated_lines(docs).select("doc_id", "n_lines", "n_removed", "text")
