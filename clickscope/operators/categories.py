"""Category reports: click/order/pay counts per category, top categories, and
the most active sessions inside each top category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import split_ids


def category_actions(visits: DataFrame) -> DataFrame:
    """One row per (category, action kind) hit: columns ``cid`` and ``kind``.

    An action is a click if it names a click category, else an order if it
    has an order list, else a pay if it has a pay list; exactly one applies.
    Order and pay lists count once per listed id; empty ids are skipped.
    """
    click = F.col("click_category_id").isNotNull() & (F.col("click_category_id") != -1)
    kind = (F.when(click, F.lit("click"))
             .when(F.col("order_category_ids").isNotNull(), F.lit("order"))
             .when(F.col("pay_category_ids").isNotNull(), F.lit("pay")))
    ids = (F.when(click, F.array(F.col("click_category_id").cast("string")))
            .when(F.col("order_category_ids").isNotNull(), split_ids("order_category_ids"))
            .when(F.col("pay_category_ids").isNotNull(), split_ids("pay_category_ids")))
    return (visits.select(kind.alias("kind"), ids.alias("ids"))
                  .where(F.col("kind").isNotNull())
                  .select("kind", F.explode("ids").alias("cid")))


def category_action_counts(visits: DataFrame) -> DataFrame:
    """(cid string, click_count, order_count, pay_count) for every category seen.

    A single hash aggregate with partial (map-side) counts: a hot category
    costs one row per map task before the shuffle.
    """
    a = category_actions(visits)
    return a.groupBy("cid").agg(
        F.count_if(F.col("kind") == "click").alias("click_count"),
        F.count_if(F.col("kind") == "order").alias("order_count"),
        F.count_if(F.col("kind") == "pay").alias("pay_count"),
    )


def category_top(counts: DataFrame, n: int = 10) -> DataFrame:
    """Top n categories by clicks, then orders (then pays, then id)."""
    return counts.orderBy(F.col("click_count").desc(), F.col("order_count").desc(),
                          F.col("pay_count").desc(), F.col("cid").asc()).limit(n)


def category_session_counts(visits: DataFrame, top_categories: DataFrame) -> DataFrame:
    """Clicks per (top category, session).

    ``top_categories`` is a top-n result (a proven small bound), so it is
    broadcast for the semi join; the count is a partial aggregate.
    """
    cids = top_categories.select(F.col("cid").cast("bigint").alias("click_category_id"))
    clicks = visits.select("click_category_id", "session_id")
    hit = clicks.join(F.broadcast(cids), "click_category_id", "left_semi")
    return (hit.groupBy("click_category_id", "session_id")
               .agg(F.count(F.lit(1)).alias("click_count"))
               .select(F.col("click_category_id").cast("string").alias("category_id"),
                       "session_id", "click_count"))


def top_sessions(session_counts: DataFrame, n: int = 10) -> DataFrame:
    """The n sessions with most clicks in each category (ties: session id)."""
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id").asc())
    return (session_counts.withColumn("_rn", F.row_number().over(w))
                          .where(F.col("_rn") <= n).drop("_rn"))
