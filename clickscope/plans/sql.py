"""The SQL surface: the model's tables as temp views and ``city_remark`` as a
function, for users who query with ``spark.sql``.

Views are lazy projections over the scans (filters and column pruning reach
them as with the DataFrame API); their names take a prefix, so that a session's
own tables are left alone. ``city_remark`` takes the clicks of each city as an
array and is built in: count per city first, then the remark of the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.city_remark import register_city_remark
from ..sources import tables as tb

VIEWS = {
    "user_visit_action": tb.user_visit_action, "user_info": tb.user_info, "product_info": tb.product_info,
    "city_info": tb.city_info, "ads_log": tb.ads_log,
}


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "") -> None:
    for name, binding in VIEWS.items():
        binding(spark, sf_dir).createOrReplaceTempView(prefix + name)
    register_city_remark(spark, "city_remark")


# The area report as one statement over the views (ties break on the product).
AREA_TOP3 = """
WITH located AS (
  SELECT town.area, town.city_name AS city, visit.click_product_id AS product
  FROM {p}user_visit_action AS visit INNER JOIN {p}city_info AS town USING (city_id)
  WHERE visit.click_product_id > 0
), by_city AS (
  SELECT area, product, city, count(*) AS n FROM located GROUP BY area, product, city
), by_product AS (
  SELECT area, product, sum(n) AS clicks, city_remark(collect_list(named_struct('city', city, 'n', n))) AS remark
  FROM by_city GROUP BY area, product
), best AS (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY clicks DESC, product) AS place FROM by_product
)
SELECT best.area, goods.product_name, best.clicks AS clicount, best.remark
FROM best INNER JOIN {p}product_info AS goods ON goods.product_id = best.product
WHERE best.place <= 3
"""


def area_top3_product_sql(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The area top-3 report through ``spark.sql`` over registered views."""
    return spark.sql(AREA_TOP3.format(p=prefix))
