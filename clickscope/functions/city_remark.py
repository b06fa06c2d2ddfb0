"""``city_remark``: how an (area, product)'s clicks split across cities.

Text form: the two cities with most clicks, each with its share in percent
truncated to one decimal, then the remainder as "other", always present:
``北京:66.6%,上海:33.3%,其他:0.1%``. Ties between cities break on the name.

The batch path composes it from built-in aggregates (partial aggregation, no
Python). ``register_city_remark`` adds a SQL function of the same name that
takes the counts per city, so SQL callers count per city first too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scalars import tenths_text, tenths_truncated

# Fixed values of the output format.
OTHER_LABEL = "其他"
TOP_CITIES = 2


def _entry(city: Column, tenths: Column) -> Column:
    return F.concat(city, F.lit(":"), tenths_text(tenths), F.lit("%"))


def city_remark_by_group(rows: DataFrame, group_cols: list[str], city_col: str,
                         count_col: str | None = None) -> DataFrame:
    """One row per group: ``clicount`` (rows in the group) and ``remark``.

    ``rows`` holds one row per click, or, with ``count_col``, pre-counted
    (group, city, n) rows. The per-city counts are a partial aggregate, so a
    hot group costs one row per city after the map side, never a list of
    clicks in one task. The window then sees at most one row per city.
    """
    n = F.count(F.lit(1)) if count_col is None else F.sum(count_col)
    per_city = rows.groupBy(*group_cols, city_col).agg(n.cast("bigint").alias("_n"))
    w_all = Window.partitionBy(*group_cols)
    w_rank = w_all.orderBy(F.col("_n").desc(), F.col(city_col).asc())
    ranked = (per_city
              .withColumn("_total", F.sum("_n").over(w_all))
              .withColumn("_rk", F.row_number().over(w_rank)))
    t = tenths_truncated(F.col("_n"), F.col("_total"))
    top = F.when(F.col("_rk") <= TOP_CITIES, F.struct(F.col("_rk").alias("rk"),
                                                       F.col(city_col).alias("city"),
                                                       t.alias("t")))
    agg = (ranked.groupBy(*group_cols)
                 .agg(F.max("_total").alias("clicount"),
                      F.sort_array(F.collect_list(top)).alias("_top")))
    other = F.lit(1000) - F.aggregate(F.col("_top"), F.lit(0).cast("bigint"), lambda acc, e: acc + e["t"])
    parts = F.concat(F.transform(F.col("_top"), lambda e: _entry(e["city"], e["t"])),
                     F.array(_entry(F.lit(OTHER_LABEL), other)))
    return agg.select(*group_cols, "clicount", F.array_join(parts, ",").alias("remark"))


def register_city_remark(spark: SparkSession, name: str = "city_remark") -> None:
    """Register ``city_remark(array of (city, n))`` as a SQL function of the
    session, built from SQL expressions: one entry a city, in any order."""
    tenths = "((x.n * 1000) div total)"
    ranked = ("array_sort(cities, (x, y) -> CASE WHEN x.n > y.n THEN -1 WHEN x.n < y.n THEN 1 "
              "WHEN x.city < y.city THEN -1 WHEN x.city > y.city THEN 1 ELSE 0 END)")
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(cities ARRAY<STRUCT<city: STRING, n: BIGINT>>) RETURNS STRING
RETURN (
  SELECT concat_ws(',', transform(top, x -> concat(x.city, ':', {tenths} / 10.0D, '%')),
                   concat('{OTHER_LABEL}:', (1000 - aggregate(top, 0L, (a, x) -> a + {tenths})) / 10.0D, '%'))
  FROM (SELECT slice({ranked}, 1, {TOP_CITIES}) AS top, aggregate(cities, 0L, (a, x) -> a + x.n) AS total))""")
