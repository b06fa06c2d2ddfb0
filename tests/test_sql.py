"""SQL over the registered views gives the DataFrame reports' results."""
import __spark_entry__ as E
from clickscope.params import FILTER_PARAMS as P
from clickscope.plans.sql import area_top3_product_sql, register_views

from .conftest import SF_SMALL


def _equal(spark, df, key):
    want = E.queries()[key](spark, SF_SMALL)
    assert df.columns == want.columns
    got = sorted(map(tuple, df.collect()))
    assert got and got == sorted(map(tuple, want.collect()))


def test_area_report_in_sql(spark):
    register_views(spark, SF_SMALL, prefix="shop_")
    assert not spark.catalog.tableExists("user_visit_action")
    _equal(spark, area_top3_product_sql(spark, prefix="shop_"), "area_top3_product")


def test_visits_of_known_users_in_sql(spark):
    register_views(spark, SF_SMALL, prefix="shop_")
    df = spark.table("shop_user_visit_action").join(spark.table("shop_user_info"), "user_id")
    df.createOrReplaceTempView("known_visits")
    _equal(spark, spark.sql(f"""
        SELECT event_id, user_id, date, age FROM known_visits
        WHERE date BETWEEN '{P.start_date}' AND '{P.end_date}' AND age BETWEEN {P.start_age} AND {P.end_age}
    """), "user_visit_filter")
