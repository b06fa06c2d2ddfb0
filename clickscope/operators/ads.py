"""Ad-click reports in batch form: blacklist, daily counts, top ads, last hour.

Micro-batch semantics are kept through a ``batch`` number per event (by
default ``ts div 5000``, the 5-second trigger; a stream test passes its own):

* Each event adds 1 to its (user, ad, day) count. When a count reaches the
  threshold the user is banned; the ban applies from the *next* batch to all
  of the user's ads and days, and the rest of the banning batch still counts.
* Until the first ban nothing of the user is dropped, so the ban batch is the
  first batch in which some (user, ad, day) running count reaches the
  threshold. Only keys whose whole count reaches it are followed batch by batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms_minute, json_pairs
from ..params import BATCH_MS, SLIDE_MS, WINDOW_MS
from ..plans.joins import MAX_BROADCAST_ROWS, broadcast_if_small, marked_by_bitmaps, materialized_broadcast


def with_batch(ads: DataFrame, batch_ms: int = BATCH_MS) -> DataFrame:
    ts = F.col("ts")
    return ads.withColumn("batch", ((ts - F.pmod(ts, F.lit(batch_ms))) / batch_ms).cast("bigint"))


def ban_batches(ads: DataFrame, threshold: int, batch_col: str = "batch") -> DataFrame:
    """(uid, banned_batch): the batch in which each banned user is banned.

    Counts per (user, ad, day) come first (a partial aggregate that a hot key
    passes as one row a task); only the few keys that reach the threshold at
    all get their clicks ordered by batch. Those keys are measured and
    broadcast when small, so the second pass over the records filters them
    where they are read."""
    keys = ["uid", "ads_id", "dt"]
    reach = ads.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= threshold).select(*keys)
    few = ads.join(materialized_broadcast(reach), keys, "left_semi")
    per = few.groupBy(*keys, F.col(batch_col).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = per.withColumn("_run", F.sum("_n").over(w))
    crossed = run.where((F.col("_run") >= threshold) & (F.col("_run") - F.col("_n") < threshold))
    return crossed.groupBy("uid").agg(F.min("_b").alias("banned_batch"))


def blacklist_filter(ads: DataFrame, bans: DataFrame, batch_col: str = "batch") -> DataFrame:
    """Events that pass the blacklist: user never banned, or event in a batch
    no later than the user's ban batch.

    ``bans`` has one row per banned user. Callers pass it through
    ``plans.joins.materialized_broadcast`` (measured, then broadcast when
    small: no shuffle of the ad records); otherwise the join shuffles on uid
    and AQE splits a hot user's partition.
    """
    j = ads.join(bans, "uid", "left")
    keep = F.col("banned_batch").isNull() | (F.col(batch_col) <= F.col("banned_batch"))
    return j.where(keep).drop("banned_batch")


def blacklist(bans: DataFrame, batch_col: str = "batch",
              max_rows: int = MAX_BROADCAST_ROWS) -> Callable[[DataFrame], DataFrame]:
    """``blacklist_filter`` with ``bans`` (checkpointed: it is read more than
    once), by its size, which is measured once. A list too long to broadcast
    goes out as bitmaps of its users: events of all others pass where they are
    read, and only events of listed users are shuffled to their ban's batch."""
    small = broadcast_if_small(bans, max_rows)

    def keep(ads: DataFrame) -> DataFrame:
        if small is not bans:
            return blacklist_filter(ads, small, batch_col)
        marked = marked_by_bitmaps(ads, bans.select("uid"), "uid", "_listed")
        if marked is None:
            return blacklist_filter(ads, bans, batch_col)
        listed = blacklist_filter(marked.where("_listed"), bans, batch_col)
        return marked.where(~F.coalesce("_listed", F.lit(False))).unionByName(listed).drop("_listed")

    return keep


def survivors(ads: DataFrame, bans: DataFrame, batch_col: str = "batch", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    return blacklist(bans, batch_col, max_rows)(ads)


def user_ads_daycount(survivors: DataFrame) -> DataFrame:
    return survivors.groupBy("uid", "ads_id", "dt").agg(F.count(F.lit(1)).alias("clicks"))


def area_city_ads_daycount(survivors: DataFrame) -> DataFrame:
    return (survivors.groupBy("area", "city", "ads_id", "dt")
                     .agg(F.count(F.lit(1)).alias("clicks")))


def area_ads_daycount(area_city_counts: DataFrame) -> DataFrame:
    """Roll the city out of the daily counts."""
    return (area_city_counts.groupBy("area", "ads_id", "dt")
                            .agg(F.sum("clicks").cast("bigint").alias("clicks")))


def top_ads_per_day(area_counts: DataFrame, k: int = 3) -> DataFrame:
    """(dt, area, top3_json) with the k ads with most clicks, as
    ``[{"ad":clicks},...]`` in rank order (ties: ad id)."""
    w = Window.partitionBy("dt", "area").orderBy(F.col("clicks").desc(), F.col("ads_id").asc())
    top = (area_counts.withColumn("_rn", F.row_number().over(w))
                      .where(F.col("_rn") <= k))
    entries = F.sort_array(F.collect_list(F.struct(F.col("_rn").alias("rn"),
                                                   F.col("ads_id").alias("ad"),
                                                   F.col("clicks").alias("n"))))
    return (top.groupBy("dt", "area")
               .agg(entries.alias("_e"))
               .select("dt", "area", json_pairs(F.col("_e"), "ad", "n").alias("top3_json")))


def latest_event(ads: DataFrame) -> int | None:
    """The latest event time (ms) that is not after now: a far-future ts in
    the data must not move the window."""
    now = F.unix_millis(F.current_timestamp())
    return ads.where(F.col("ts") <= now).agg(F.max("ts")).first()[0]


def latest_event_back(scan: Callable[[int | None, int], DataFrame], now_ms: int,
                      first_ms: int = WINDOW_MS, factor: int = 256) -> int | None:
    """``latest_event`` by a probe backwards from now: ``scan(since, until)`` gives
    the records of ``[since, until)``; the newest range is read first, then
    ranges ``factor`` times as long, until one has a record. Data that reaches up
    to now costs one short range, and no range is read twice; the last one has
    no lower end."""
    until, width = now_ms + 1, first_ms
    while True:
        since = now_ms + 1 - width if width < now_ms else None
        found = scan(since, until).agg(F.max("ts")).first()[0]
        if found is not None or since is None:
            return found
        until, width = since, width * factor


def window(latest_ms: int, length_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS) -> tuple[int, int]:
    """(start, end) of the window ``(start, end]`` in ms: it ends with the
    slide pane that holds the latest event."""
    end = latest_ms - latest_ms % slide_ms + slide_ms - 1
    return end - length_ms, end


def last_hour_ads_minutes(survivors: DataFrame, as_of_ms: int | None = None, length_ms: int = WINDOW_MS,
                          slide_ms: int = SLIDE_MS) -> DataFrame:
    """(ads_id, hour_minute, minute_ms, clicks) over ``(as_of - length, as_of]``.

    ``as_of_ms`` defaults to the end of the slide pane of the latest event.
    Callers that can bound their scan take ``window`` of ``latest_event`` and
    pass survivors of that range only."""
    if as_of_ms is None:
        latest = latest_event(survivors)
        as_of_ms = -1 if latest is None else window(latest, length_ms, slide_ms)[1]
    ts = F.col("ts")
    recent = survivors.where((ts > as_of_ms - length_ms) & (ts <= as_of_ms))
    minute = (ts - F.pmod(ts, F.lit(60000))).alias("minute_ms")
    return (recent.groupBy("ads_id", minute, epoch_ms_minute(ts).alias("hour_minute"))
                  .agg(F.count(F.lit(1)).alias("clicks")))


def last_hour_ads_click(minutes: DataFrame) -> DataFrame:
    """(ads_id, minutes_json): ``[{"HH:mm":clicks},...]`` in time order.
    At most one entry per minute of the window per ad."""
    entries = F.sort_array(F.collect_list(F.struct("minute_ms", "hour_minute", "clicks")))
    return (minutes.groupBy("ads_id").agg(entries.alias("_e"))
                   .select("ads_id", json_pairs(F.col("_e"), "hour_minute", "clicks").alias("minutes_json")))
