"""Area top-3 products report (clicks per area and product, with a city split)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.city_remark import city_remark_by_group
from ..plans.joins import bounded_broadcast


def area_city_clicks(uva: DataFrame, city_info: DataFrame) -> DataFrame:
    """Product clicks placed in their city and area.

    The city dimension is broadcast after a bounded size check; above the
    bound the join shuffles.
    """
    clicks = uva.where(F.col("click_product_id") > 0).select("city_id", "click_product_id")
    return (clicks.join(bounded_broadcast(city_info), "city_id")
                  .select("area", "city_name", "click_product_id"))


def area_product_clicks(clicks: DataFrame) -> DataFrame:
    """(area, click_product_id, clicount, remark) from product-click rows."""
    return city_remark_by_group(clicks, ["area", "click_product_id"], "city_name")


def area_top3_product(product_clicks: DataFrame, product_info: DataFrame, k: int = 3) -> DataFrame:
    """The k most-clicked products of each area, then named.

    Ranking runs before the product join, so a product missing from
    ``product_info`` drops its slot instead of promoting the next one. Ties
    break on the product id. ``row_number() <= k`` lets Spark insert a
    partial WindowGroupLimit before the shuffle, so each map task ships at
    most k rows per area; those rows (k for each area of the city dimension)
    are broadcast to the product table, which stays where it is.
    """
    w = Window.partitionBy("area").orderBy(F.col("clicount").desc(), F.col("click_product_id").asc())
    top = (product_clicks.withColumn("rn", F.row_number().over(w))
                         .where(F.col("rn") <= k))
    return (product_info.join(F.broadcast(top), top.click_product_id == product_info.product_id)
               .select("area", "product_name", "clicount", "remark"))
