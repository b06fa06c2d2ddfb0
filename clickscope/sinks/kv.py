"""Key/value (hash-store) sink layouts.

A hash store holds ``key -> {field: value}``. Reports are rendered into
(key, field, value) rows here; strings are built only at this edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed key names of the hash store.
AREA_CITY_ADS_DAYCOUNT = "area_city_ads_daycount"
TOP3_ADS_PER_DAY = "top3_ads_per_day"
LAST_HOUR_ADS_CLICK = "last_hour_ads_click"
USER_ADS_DAYCOUNT = "user_ads_daycount"
BLACKLIST = "blacklist"


def kv_area_city_ads_daycount(counts: DataFrame) -> DataFrame:
    field = F.concat_ws(":", "area", "city", F.col("ads_id").cast("string"), "dt")
    return counts.select(F.lit(AREA_CITY_ADS_DAYCOUNT).alias("key"), field.alias("field"),
                         F.col("clicks").cast("string").alias("value"))


def kv_top3_ads_per_day(top: DataFrame) -> DataFrame:
    return top.select(F.concat(F.lit(TOP3_ADS_PER_DAY + ":"), F.col("dt")).alias("key"),
                      F.col("area").alias("field"), F.col("top3_json").alias("value"))


def kv_last_hour_ads_click(last_hour: DataFrame) -> DataFrame:
    return last_hour.select(F.lit(LAST_HOUR_ADS_CLICK).alias("key"),
                            F.col("ads_id").cast("string").alias("field"),
                            F.col("minutes_json").alias("value"))


def kv_user_ads_daycount(counts: DataFrame) -> DataFrame:
    field = F.concat_ws(":", F.col("uid").cast("string"), F.col("ads_id").cast("string"), "dt")
    return counts.select(F.lit(USER_ADS_DAYCOUNT).alias("key"), field.alias("field"),
                         F.col("clicks").cast("string").alias("value"))


def kv_blacklist(bans: DataFrame) -> DataFrame:
    """Set members as fields with an empty value."""
    return bans.select(F.lit(BLACKLIST).alias("key"), F.col("uid").cast("string").alias("field"),
                       F.lit("").alias("value"))
