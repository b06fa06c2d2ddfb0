"""Fixed input and output schemas of the click-stream data model."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType([
    T.StructField("event_id", T.LongType()),          # tie-break for same-second actions
    T.StructField("date", T.StringType()),             # yyyy-MM-dd
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),      # yyyy-MM-dd HH:mm:ss
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),  # -1 or NULL: not a click
    T.StructField("click_product_id", T.LongType()),   # -1 or NULL: not a click
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# One parsed ad-click record; ts is epoch milliseconds.
ADS_LOG = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("ads_id", T.LongType()),
])

# Key/value sink rows (the hash-store layouts): key, field, value.
KV_ROW = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("value", T.StringType()),
])
