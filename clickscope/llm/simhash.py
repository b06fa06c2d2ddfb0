"""SimHash near-duplicate groups by pigeonhole blocks.

A text's fingerprint is the bitwise majority of the 64-bit hashes of its word
shingles. Two fingerprints link at ``max_bits`` or fewer differing bits. The
64 bits are cut into ``blocks`` blocks; a linked pair differs in at most
``max_bits`` of them, so it agrees on some choice of ``blocks - max_bits``
blocks. Every distinct fingerprint is filed under each such choice, pairs are
joined on it, and the Hamming distance is verified.

A choice shared by more than ``hot`` distinct fingerprints is not joined pair
by pair. Its fingerprints take an exact linear way: for ``max_bits`` 2, two
fingerprints are within two bits exactly if some 64-bit word is within one bit
of both, so each is filed under itself and its 64 one-bit neighbours, and the
at most 65 distinct fingerprints filed under a word are linked to the smallest.

Defined results: a null or empty text has fingerprint zero and links like any
other; rows with a null doc_id keep their fingerprint, and their group's id is
the smallest non-null doc_id (null when there is none); repeated rows share
one fingerprint and appear once each; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import components, landed, read_table, under_other_names

SHINGLE_WORDS = 3
MAX_BITS = 2
BLOCKS = 5
HOT = 64
SEED = 42


def text_fingerprint(text: bytes | None, k: int) -> int:
    """Majority of the XXH64 hashes of the ``k``-word shingles of ``text``."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - k + 1)
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[min(k, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):  # bits of a bounded slice at a time
        bits = np.unpackbits(h[i:i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_id, fp): one row per row of ``docs``; fp as a signed
    long, text_id a 64-bit hash that tells texts of a repeated doc_id apart."""
    def work(batches):
        for batch in batches:
            fps = np.fromiter((text_fingerprint(t, k) for t in batch.column(1).to_pylist()),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(fps.view(np.int64))],
                names=["doc_id", "text_id", "fp"])

    cols = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("text_id"))
    return cols.mapInArrow(work, "doc_id long, text_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """One mask per choice of ``blocks - max_bits`` of the blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [_signed(sum(c)) for c in combinations(parts, blocks - max_bits)]


def links(fps: DataFrame, blocks: int = BLOCKS, hot: int = HOT) -> DataFrame:
    """(a, b): links among the distinct fingerprints ``fps.fp``, enough of
    them that the components are those of all pairs within ``MAX_BITS``."""
    masks = F.array(*(F.lit(m) for m in block_masks(blocks)))
    filed = fps.select("fp", F.posexplode(masks).alias("way", "mask")).select(
        "fp", "way", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
    shared = filed.groupBy("way", "part").count().where("count > 1")
    filed = landed(filed.join(shared, ["way", "part"]), "simhash-blocks")

    cold = filed.where(F.col("count") <= hot)
    x, y = cold.alias("x"), cold.alias("y")
    near = x.join(y, (F.col("x.way") == F.col("y.way")) & (F.col("x.part") == F.col("y.part"))
                  & (F.col("x.fp") < F.col("y.fp"))
                  & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= MAX_BITS))
    near = near.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    flips = F.array(*(F.lit(_signed(b)) for b in (0, *(1 << i for i in range(64)))))
    word = filed.where(F.col("count") > hot).select("fp").distinct().select(
        "fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    first = F.min("fp").over(Window.partitionBy("word"))  # at most 65 rows a word
    stars = word.select(F.col("fp").alias("a"), first.alias("b")).where("a != b")
    return near.union(stars).distinct()


def near_duplicate_groups(docs: DataFrame, k: int = SHINGLE_WORDS, blocks: int = BLOCKS,
                          hot: int = HOT) -> DataFrame:
    """(doc_id, text_id, fp, root, component_id): one row per row of ``docs``;
    root is the smallest fingerprint of the group, and so names it."""
    rows = landed(fingerprints(docs, k), "simhash-fingerprints")
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(firsts, blocks, hot)).withColumnRenamed("node", "fp")
    # fingerprints with a link, folded to the smallest doc_id of their component
    linked = firsts.join(roots, "fp")
    linked = linked.join(linked.groupBy("root").agg(F.min("first").alias("low")), "root")
    linked = linked.select("fp", "root", "low")
    ids = firsts.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("low", "first").alias("component_id"))
    return rows.join(ids, "fp").select("doc_id", "text_id", "fp", "root", "component_id")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_duplicate_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                         "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the row whose
    doc_id is the group's smallest; where that doc_id repeats inside the
    group, one of its texts, once. Rows without a doc_id are all kept."""
    return under_other_names(docs, _first_of_each)


def _first_of_each(docs: DataFrame) -> DataFrame:
    firsts = near_duplicate_groups(docs).where("doc_id = component_id")
    stays = firsts.groupBy("root", "doc_id").agg(F.min("text_id").alias("_text_id"))
    stays = stays.select("doc_id", "_text_id").distinct()
    keyed = docs.withColumn("_text_id", F.xxhash64("text"))
    kept = keyed.join(stays, ["doc_id", "_text_id"], "left_semi").dropDuplicates(["doc_id", "_text_id"])
    return kept.unionByName(keyed.where("doc_id is null")).select(*docs.columns)
