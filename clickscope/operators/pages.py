"""Page-to-page conversion along a target flow.

Denominator: visits of each flow page but the last. Numerator: how often a
session goes straight from one flow page to the next (neighbouring actions by
time, ties by event id). Ratio: percent, one decimal, half up. Only jumps that
occur are reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import pct_half_up
from ..params import flow_pairs
from .sequence import consecutive_pairs

# Fixed value. A jump's from-page lacking a visit count gets this denominator (cannot
# happen: a jump's from-page is itself a visit of a flow page).
MISSING_VISITS = 100000


def page_visit_counts(visits: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """(page_id, visits) over all actions on the flow's pages but the last."""
    pages = sorted(set(flow[:-1]))
    return (visits.where(F.col("page_id").isin(pages))
                  .groupBy("page_id").agg(F.count(F.lit(1)).alias("visits")))


def session_page_pairs(visits: DataFrame, keep_last: bool = False) -> DataFrame:
    """(session_id, from_page, to_page) for every pair of neighbouring actions;
    with ``keep_last`` one row for every action, ``to_page`` null at the end of
    its session."""
    hour = F.substring("action_time", 1, len("yyyy-MM-dd HH"))
    return consecutive_pairs(visits, "session_id", ["action_time", "event_id"], "page_id", piece=hour,
                             prev_name="from_page", next_name="to_page", keep_last=keep_last,
                             finer=F.col("action_time"))


def _jump(a, b):
    return F.concat_ws("-", a.cast("string"), b.cast("string"))


def page_jump_counts(pairs: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """(page_jump 'a-b', jumps) for the flow's consecutive pairs that occur.

    Membership is an IN-set predicate on the jump text: a repeated pair in
    the flow does not multiply rows, and no join is needed.
    """
    wanted = [f"{a}-{b}" for a, b in flow_pairs(flow)]
    if not wanted:
        return pairs.sparkSession.createDataFrame([], "page_jump string, jumps bigint")
    j = _jump(F.col("from_page"), F.col("to_page"))
    return (pairs.select(j.alias("page_jump"))
                 .where(F.col("page_jump").isin(wanted))
                 .groupBy("page_jump").agg(F.count(F.lit(1)).alias("jumps")))


def page_convert_ratio(jumps: DataFrame, visit_counts: DataFrame) -> DataFrame:
    """(page_jump, ratio) with ratio = jumps / visits of the from-page, in %.

    Both inputs are aggregates bounded by the flow length.
    """
    from_page = F.split(F.col("page_jump"), "-").getItem(0).cast("bigint")
    j = jumps.withColumn("_from", from_page)
    v = visit_counts.withColumnRenamed("page_id", "_from")
    joined = j.join(F.broadcast(v), "_from", "left")
    den = F.coalesce(F.col("visits"), F.lit(MISSING_VISITS))
    return joined.select("page_jump", pct_half_up(F.col("jumps"), den).alias("ratio"))


def page_convert_ratio_of(steps: DataFrame, flow: tuple[int, ...]) -> DataFrame:
    """``page_convert_ratio`` from one pass over every action with the page after
    it (``session_page_pairs`` with ``keep_last``): jumps and visits are both
    counts of (from_page, to_page), at most flow length x pages of them."""
    wanted = [f"{a}-{b}" for a, b in flow_pairs(flow)]
    if not wanted:
        return steps.sparkSession.createDataFrame([], "page_jump string, ratio double")
    counts = (steps.where(F.col("from_page").isin(sorted(set(flow[:-1]))))
                   .groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("jumps")))
    visits = F.sum("jumps").over(Window.partitionBy("from_page"))
    rows = counts.select(_jump(F.col("from_page"), F.col("to_page")).alias("page_jump"), "to_page", "jumps",
                         visits.alias("visits"))
    return (rows.where(F.col("to_page").isNotNull() & F.col("page_jump").isin(wanted))
                .select("page_jump", pct_half_up(F.col("jumps"), F.col("visits")).alias("ratio")))
