"""Centroid clustering by Walsh-Hadamard progressive search.

Vectors become integers, floor(scale * x). Lloyd's rounds run in exact integer
arithmetic: a vector goes to its nearest centroid (squared Euclidean distance,
ties to the smaller number), a centroid becomes the floor of its vectors' mean.

The search transforms vectors and centroids with the integer Walsh-Hadamard
transform H. H keeps distances up to a factor, |Hx - Hc|^2 = width |x - c|^2,
and gathers what vectors differ in coarsely in the rows with few sign changes.
Squared differences of coefficients are accumulated from those rows on (1, 2,
4, ... of them). What is still to come for a centroid is at least nothing and
at most twice the energy left in both sides, since (a - b)^2 <= 2a^2 + 2b^2;
a centroid whose sum so far is above the least possible total of another one is
strictly worse and goes. The others are carried through all coefficients, so
the distances are exact and ties are seen.

A round is one scan without a shuffle of vectors: a task sends, per centroid,
a count and the sums of the components, which are added up per centroid. Only
centroids reach the driver. Sums travel as decimal text and are added as Python
integers, so they are exact for every finite component; components beyond
2^20 take the same search on Python integers.

Defined results: a null vector, one of another width, one with a null or
non-finite component, or one without an id takes no part; repeated rows count
once each (as seeds too: rows with one id have one hash, then the smaller
vector comes first); with fewer rows than centroids every row is a seed; a
centroid without vectors stays where it is; a distance or inertia beyond 64
bits is null; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import landed, read_table

CLUSTERS = 8
ROUNDS = 10
WIDTH = 64
SCALE = 1024
SEED = 3
SMALL = 1 << 20  # components below it: all sums fit 64 bits
LONG_MAX = (1 << 63) - 1


def hadamard(width: int) -> np.ndarray:
    """Hadamard matrix of a power of two, rows by number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < width:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")]


def levels(width: int) -> list[tuple[int, int]]:
    """Coefficient ranges from coarse to fine: [0,1), [1,2), [2,4), ..."""
    ends = [1 << i for i in range(width.bit_length())]
    return list(zip([0, *ends], ends))


def integers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles: 64-bit where small, else Python integers."""
    if not values.size or np.abs(values).max() * scale < SMALL:
        return np.floor(values * scale).astype(np.int64)
    cells = [int(x) * scale if abs(x) >= 1 << 53 else int(np.floor(x * scale)) for x in values.ravel()]
    return np.array(cells, dtype=object).reshape(values.shape)


def nearest(rows: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of every row."""
    n, width = rows.shape
    wide = rows.dtype == object or max(abs(c) for row in centroids for c in row) >= SMALL
    kind = object if wide else np.int64
    h = hadamard(width).astype(kind)
    x, c = rows.astype(kind) @ h.T, np.array(centroids, kind) @ h.T
    sums = np.zeros((n, len(c)), kind)
    left = (x * x).sum(1)[:, None] + (c * c).sum(1)[None, :]  # energy still to come, both sides
    alive = np.ones((n, len(c)), bool)
    for start, end in levels(width):
        for j in range(len(c)):
            at = np.flatnonzero(alive[:, j])
            if len(at):
                part = x[at, start:end]
                d = part - c[j, start:end]
                sums[at, j] += (d * d).sum(1)
                left[at, j] -= (part * part).sum(1) + (c[j, start:end] * c[j, start:end]).sum()
        most = sums + 2 * left
        bound = np.array([min(m[a]) for m, a in zip(most, alive)], object) if wide else \
            np.where(alive, most, LONG_MAX).min(1)
        alive &= ~(sums > bound[:, None]).astype(bool)
    if wide:
        best = np.array([min(np.flatnonzero(a), key=lambda j: (s[j], j)) for s, a in zip(sums, alive)], int)
    else:
        best = np.where(alive, sums, LONG_MAX).argmin(1)
    return best, sums[np.arange(n), best] // width


def _usable(batch: pa.RecordBatch, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, integer vectors) of the rows of a batch that take part."""
    vectors = batch.column(1)
    long_enough = np.array(vectors.value_lengths().fill_null(-1)) == width
    at = np.flatnonzero(long_enough & np.array(batch.column(0).is_valid()))
    flat = vectors.take(pa.array(at)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(-1, width)  # nulls become NaN
    fine = np.isfinite(values).all(1)
    return at[fine], integers(values[fine], scale)


def seeds(vectors: DataFrame, clusters: int, width: int, scale: int, seed: int) -> list[list[int]]:
    """The first centroids: the vectors with the smallest hashed ids."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") == width) & usable)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(hashed.alias("h"), F.col("embedding").cast("array<double>").alias("v"))
    found = [r.v for r in first.orderBy("h", "v").limit(clusters).collect()]
    return [[int(x) for x in row] for row in integers(np.array(found).reshape(-1, width), scale)]


def recentred(vectors: DataFrame, centroids: list[list[int]], scale: int) -> list[list[int]]:
    """The centroids after one round."""
    width = len(centroids[0])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * len(centroids), [[0] * width for _ in centroids]
        for batch in batches:
            _, rows = _usable(batch, width, scale)
            if not len(rows):
                continue
            best, _ = nearest(rows, centroids)
            for j in np.unique(best):
                mine = rows[best == j]
                counts[j] += len(mine)
                sums[j] = [a + int(b) for a, b in zip(sums[j], mine.sum(0))]
        used = [j for j, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([counts[j] for j in used], pa.int64()),
             pa.array([[str(s) for s in sums[j]] for j in used], pa.list_(pa.string()))],
            names=["cluster", "n", "sums"])

    def add(rows: pa.Table) -> pa.Table:  # one small row a task
        total, n = [0] * width, sum(rows.column("n").to_pylist())
        for sums in rows.column("sums"):
            total = [a + int(b) for a, b in zip(total, sums.as_py())]
        return pa.table({"cluster": rows.column("cluster").slice(0, 1),
                         "centre": pa.array([[str(t // n) for t in total]], pa.list_(pa.string()))})

    parts = vectors.mapInArrow(partial, "cluster int, n long, sums array<string>")
    moved = parts.groupBy("cluster").applyInArrow(add, "cluster int, centre array<string>").collect()
    after = list(centroids)
    for r in moved:
        after[r.cluster] = [int(x) for x in r.centre]
    return after


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH,
            scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance), centroids): every usable row of ``vectors``
    (vec_id, embedding) with its cluster, and the integer centroids. ``width``
    is a power of two."""
    if width < 1 or width & (width - 1):
        raise ValueError("width must be a power of two")
    slim = vectors.select(F.col("vec_id").cast("long"), "embedding")
    centroids = seeds(vectors, clusters, width, scale, seed)
    kind = "vec_id long, cluster int, distance long"
    if not centroids:
        return vectors.sparkSession.createDataFrame([], kind), []
    for _ in range(rounds):
        centroids = recentred(slim, centroids, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = _usable(batch, width, scale)
            best, far = nearest(rows, centroids) if len(rows) else (np.zeros(0, int), np.zeros(0, int))
            fits = [int(d) if d <= LONG_MAX else None for d in far]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(best.astype(np.int32)),
                 pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"])

    return landed(slim.mapInArrow(assign, kind), "clusters"), centroids


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, centroids = cluster(read_table(spark, sf_dir, "embeddings"))
    # a sum that meets a null distance is null, as one beyond 64 bits is
    total = F.when(F.count("*") == F.count("distance"), F.try_sum("distance"))
    each = rows.groupBy("cluster").agg(total.alias("inertia")).collect()  # one row a centroid
    inertia = {r.cluster: r.inertia for r in each}
    whole = None if None in inertia.values() else sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    facts = spark.createDataFrame(
        [(j, s, whole if whole is None or whole <= LONG_MAX else None, digest[j]) for j, s in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds one after the other, each a table of (number, components)."""
    assigned = """
a{r} AS MATERIALIZED (
  SELECT row, vec_id, v, d.cluster, d.distance FROM (
    SELECT e.row, e.vec_id, e.v, min(struct_pack(distance := list_sum(list_transform(list_zip(e.v, c.v),
           lambda p: (p[1] - p[2]) * (p[1] - p[2]))), cluster := c.cluster)) AS d
    FROM e, c{r} c GROUP BY e.row, e.vec_id, e.v))"""
    moved = """
m{r} AS MATERIALIZED (
  SELECT cluster, list(x ORDER BY i) AS v FROM (
    SELECT cluster, i, (s - ((s % n) + n) % n) // n AS x FROM (
      SELECT cluster, i, sum(v[i])::HUGEINT AS s, count(*) AS n
      FROM a{r}, range(1, 65) t(i) GROUP BY cluster, i)) GROUP BY cluster),
c{next} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN m{r} m USING (cluster))"""
    steps = [assigned.format(r=r) + "," + moved.format(r=r, next=r + 1) for r in range(10)]
    return """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v FROM e
  ORDER BY 1 LIMIT 8),""" + ",".join(steps) + "," + assigned.format(r=10) + """
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a10 a JOIN c10 c ON c.cluster = a.cluster
"""


OP11_SQL = _sql()
