"""Join helpers."""

from __future__ import annotations

from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we broadcast; beyond these bounds the join shuffles.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_FILES = 256
MAX_BROADCAST_INPUT_BYTES = 256 * 1024 * 1024


def _input_bytes(dim: DataFrame, max_files: int) -> int | None:
    """Total size of the files ``dim`` reads (file metadata only, no job);
    None when it reads more than ``max_files`` files."""
    files = dim.inputFiles()
    if len(files) > max_files:
        return None
    sc = dim.sparkSession.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    total = 0
    for f in files:
        p = sc._jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total


def _footer_rows(dim: DataFrame) -> int | None:
    """Most rows ``dim`` can have, from the footers of the Parquet files it
    reads (no job): the product over the tables it joins. None when it reads
    something else."""
    files = dim.inputFiles()
    if not files or not all(f.endswith(".parquet") for f in files):
        return None
    sc = dim.sparkSession.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    parquet = sc._jvm.org.apache.parquet.hadoop
    rows: dict[str, int] = {}
    for f in files:
        where = sc._jvm.org.apache.hadoop.fs.Path(f)
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(where, conf))
        try:
            n = reader.getRecordCount()
        finally:
            reader.close()
        # a table is a folder of part files, or a file by its own name
        name = f.rsplit("/", 1)[0] if f.rsplit("/", 1)[1].startswith("part-") else f
        rows[name] = rows.get(name, 0) + n
    return prod(rows.values())


def bounded_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int = MAX_BROADCAST_INPUT_BYTES,
                      max_files: int = MAX_BROADCAST_FILES) -> DataFrame:
    """Mark ``dim`` for broadcast only after checking it is small.

    All checks read file metadata alone: at most ``max_files`` input files of
    at most ``max_bytes`` in total, with at most ``max_rows`` rows by their
    Parquet footers. Only where the footers do not settle it (other formats, a
    filter that keeps few rows) at most ``max_rows + 1`` rows are counted. Call
    it on dimension scans, not on derived results (those are sized by AQE at
    runtime). Above a bound the plain frame is returned and Spark plans a
    shuffled join.
    """
    size = _input_bytes(dim, max_files)
    if size is None or size > max_bytes:
        return dim
    n = _footer_rows(dim)
    if n is None or n > max_rows:
        n = dim.limit(max_rows + 1).count()
    return F.broadcast(dim) if n <= max_rows else dim


def _measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a frame: 8 bytes a value, texts by their length."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{n}`")), F.lit(0)) for n, kind in df.dtypes if kind in ("string", "binary")]
    size = sum(texts, F.lit(8 * len(df.columns)))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("b")).first()
    return row.n, row.b


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_INPUT_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its measured rows and bytes are both
    under their bounds; else it stays as it is and the join shuffles. Use it
    on frames that are cheap to read twice (files, checkpoints)."""
    rows, size = _measured(df)
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def materialized_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                           max_bytes: int = MAX_BROADCAST_INPUT_BYTES) -> DataFrame:
    """Broadcast a *derived* result after measuring it.

    ``small`` is computed once and checkpointed to the shared checkpoint
    folder (which also cuts its lineage); its rows and bytes are then measured
    on the written data. Under both bounds it is broadcast, so the large side
    of the join is read map-side without a shuffle; over one, the checkpointed
    frame joins with a shuffle. Use where the result is usually small but
    has no bound by construction (e.g. the set of banned users).
    """
    return broadcast_if_small(materialized(small), max_rows, max_bytes)


def materialized(df: DataFrame) -> DataFrame:
    """``df`` computed once and checkpointed to the shared checkpoint folder."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BITMAP_BYTES = 4096  # of one bitmap: 32,768 neighbouring ids


def marked_by_bitmaps(rows: DataFrame, ids: DataFrame, col: str, name: str,
                      max_bytes: int = MAX_BROADCAST_INPUT_BYTES) -> DataFrame | None:
    """``rows`` with ``name``: whether their integer ``col`` is one of ``ids``
    (a frame with that column); null for a null. Exact and without a shuffle
    of ``rows``: the ids become one bitmap for each 32,768 neighbouring values,
    which is broadcast. Ten million dense ids take 1.3 MB. None when the
    bitmaps (counted before they are built) are over ``max_bytes``; sparse ids
    can be."""
    bucket = F.bitmap_bucket_number(F.col(col))
    buckets = ids.select(bucket.alias("b")).distinct().count()
    if buckets * BITMAP_BYTES > max_bytes:
        return None
    bits = ids.groupBy(bucket.alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(col))).alias("_bits")).where("_bucket is not null")
    at = F.bitmap_bit_position(F.col(col))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr(f"shiftright(_byte, cast(bitmap_bit_position(`{col}`) & 7 as int)) & 1 = 1")
    joined = rows.withColumn("_b", bucket).join(F.broadcast(bits), F.col("_b") == F.col("_bucket"), "left")
    found = joined.withColumn("_byte", byte).withColumn("_hit", F.coalesce(hit, F.lit(False)))
    return found.select(*rows.columns, F.when(F.col(col).isNotNull(), F.col("_hit")).alias(name))


def anti_join_ids(rows: DataFrame, ids: DataFrame, col: str, max_rows: int = MAX_BROADCAST_ROWS,
                  max_bytes: int = MAX_BROADCAST_INPUT_BYTES) -> DataFrame:
    """``rows`` whose integer ``col`` is not among ``ids``, by the cheapest way
    that the measured size of ``ids`` allows: broadcast as they are, broadcast
    as bitmaps, or a shuffled anti join. ``ids`` is read more than once."""
    n, size = _measured(ids)
    if n <= max_rows and size <= max_bytes:
        return rows.join(F.broadcast(ids), col, "left_anti")
    marked = marked_by_bitmaps(rows, ids, col, "_listed", max_bytes)
    if marked is None:
        return rows.join(ids, col, "left_anti")
    return marked.where(~F.coalesce("_listed", F.lit(False))).drop("_listed")
