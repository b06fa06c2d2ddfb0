"""Consecutive pairs inside ordered groups, safe against hot groups.

``lead(x) over (partition by g order by o)`` sends every row of a group to one
task; a group holding a third of the data would run in one task. Here rows are
clustered by the group and a *piece* of it, a value that does not decrease in
the group's order (the hour of the action, say), so a hot group is cut into as
many tasks as it has pieces. Neighbours inside a piece are paired there. Only
the pairs that a piece's edge cuts are left: they are stitched from the first
and last row of each piece (two rows a piece, however many rows it has) in the
group's order. Every pair appears exactly once. The pieces come from the rows
themselves, so nothing is sampled or stored, and both halves read the same
shuffle.

A piece may be hot as well (a session that runs wild within an hour). Where a
``finer`` value is given, pieces of more than ``hot_rows`` rows, found by a
partial count first, are cut by it (the second, say). There are fewer of them
than rows / ``hot_rows``, so their list is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HOT_ROWS = 1_000_000


def in_pieces(rows: DataFrame, group: str, finer: Column | None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` (with ``_piece`` and ``_finer``) with hot pieces cut: ``_piece``
    becomes (piece, finer), the second part null outside hot pieces."""
    if finer is None:
        return rows
    keys = [F.col(group).alias("_g"), F.col("_piece").alias("_p")]
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    here = F.col(group).eqNullSafe(F.col("_g")) & F.col("_piece").eqNullSafe(F.col("_p"))
    marked = rows.join(F.broadcast(hot), here, "left")
    cut = F.struct("_piece", F.when(F.col("_n").isNotNull(), F.col("_finer")).alias("_cut"))
    return marked.withColumn("_piece", cut).select(*rows.columns)


def consecutive_pairs(df: DataFrame, group: str, order: list[str], value: str, piece: Column,
                      prev_name: str | None = None, next_name: str | None = None,
                      keep_last: bool = False, finer: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(group, prev value, next value) for each pair of neighbouring rows; with
    ``keep_last`` also each group's last row, its next value null.

    ``order`` must make the row order inside a group total (add a unique id
    as the last key), and ``piece`` and ``finer`` must not decrease along it; a
    group with a single row yields no pair.
    """
    prev_name = prev_name or f"from_{value}"
    next_name = next_name or f"to_{value}"
    rows = df.select(group, *order, F.col(value).alias("_v"), piece.alias("_piece"),
                     *([finer.alias("_finer")] if finer is not None else []))
    rows = in_pieces(rows, group, finer, hot_rows)
    inside = Window.partitionBy(group, "_piece").orderBy(*order)
    last = F.lead(F.lit(True)).over(inside).isNull()
    first = F.lag(F.lit(True)).over(inside).isNull()
    marked = rows.select("*", F.lead("_v").over(inside).alias("_next"), first.alias("_first"), last.alias("_last"))

    pair = [F.col(group), F.col("_v").alias(prev_name), F.col("_next").alias(next_name)]
    inner = marked.where(~F.col("_last")).select(*pair)

    across = Window.partitionBy(group).orderBy(*order)  # at most two rows a piece
    edges = marked.where(F.col("_first") | F.col("_last")).drop("_next")
    after = F.lead(F.struct("_v")).over(across)
    ends = F.col("_last") if keep_last else F.col("_last") & F.col("_after").isNotNull()
    stitched = (edges.withColumn("_after", after).where(ends)
                     .withColumn("_next", F.col("_after._v")).select(*pair))
    return inner.unionByName(stitched)
