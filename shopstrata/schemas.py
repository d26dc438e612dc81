"""Record schemas. Money is decimal(16,2); raw log times are epoch milliseconds."""

from pyspark.sql import types as T

MONEY = T.DecimalType(16, 2)

_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "decimal(16,2)": MONEY}


def _ddl(text: str) -> T.StructType:
    """A struct from `name type` pairs; Spark's own reader of these needs a session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (pair.split() for pair in text.split(", "))])


# Names and order of the records' fields.
COMMON = _ddl("ar string, uid string, os string, ch string, is_new string, md string, mid string, vc string, ba string")
START = _ddl("entry string, loading_time long, open_ad_id long, open_ad_ms long, open_ad_skip_ms long")
PAGE = _ddl("page_id string, item string, item_type string, last_page_id string, during_time long")
DISPLAYS = T.ArrayType(T.StructType([T.StructField("item", T.StringType())]))

APP_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("start", START),
    T.StructField("page", PAGE),
    T.StructField("displays", DISPLAYS),
    T.StructField("ts", T.LongType()),
])

# What the log split writes: `log_id` is the record's position in the raw topic.
_LOG_META = [T.StructField("ts", T.LongType()), T.StructField("log_id", T.LongType())]
PAGE_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("displays", DISPLAYS),
    *_LOG_META,
])
START_LOG = T.StructType([T.StructField("common", COMMON), T.StructField("start", START), *_LOG_META])
DISPLAY_LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page_id", T.StringType()),
    T.StructField("item", T.StringType()),
    *_LOG_META,
])

STRING_MAP = T.MapType(T.StringType(), T.StringType())

PAGE_VIEW = T.StructType([
    T.StructField("common", STRING_MAP),
    T.StructField("page", STRING_MAP),
    T.StructField("ts", T.LongType()),
])

CDC_ROW = T.StructType([
    T.StructField("database", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("xid", T.LongType()),
    T.StructField("data", STRING_MAP),
])

CDC_ROWCHANGE = T.StructType([
    T.StructField("schema", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("execute_time", T.LongType()),
    T.StructField("entry_type", T.StringType()),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("before", STRING_MAP),
        T.StructField("after", STRING_MAP),
    ]))),
])

ROUTING = _ddl(
    "source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, sink_pk "
    "string, sink_extend string"
)

ORDER_INFO = _ddl(
    "id long, province_id long, order_status string, user_id long, total_amount decimal(16,2), "
    "activity_reduce_amount decimal(16,2), coupon_reduce_amount decimal(16,2), original_total_amount "
    "decimal(16,2), feight_fee decimal(16,2), expire_time string, create_time string, operate_time string"
)
ORDER_DETAIL = _ddl(
    "id long, order_id long, sku_id long, order_price decimal(16,2), sku_num long, sku_name string, create_time "
    "string, split_total_amount decimal(16,2), split_activity_amount decimal(16,2), split_coupon_amount "
    "decimal(16,2)"
)
PAYMENT_INFO = _ddl(
    "id long, order_id long, user_id long, total_amount decimal(16,2), subject string, payment_type string, "
    "create_time string, callback_time string"
)
FAVOR_INFO = _ddl("sku_id long, create_time string")
CART_INFO = FAVOR_INFO
REFUND_INFO = _ddl("sku_id long, order_id long, refund_amount decimal(16,2), create_time string")
COMMENT_INFO = _ddl("sku_id long, appraise string, create_time string")

ORDER_WIDE = _ddl(
    "detail_id long, order_id long, sku_id long, order_price decimal(16,2), sku_num long, sku_name string, "
    "province_id long, order_status string, user_id long, total_amount decimal(16,2), activity_reduce_amount "
    "decimal(16,2), coupon_reduce_amount decimal(16,2), original_total_amount decimal(16,2), feight_fee "
    "decimal(16,2), split_feight_fee decimal(16,2), split_activity_amount decimal(16,2), split_coupon_amount "
    "decimal(16,2), split_total_amount decimal(16,2), expire_time string, create_time string, operate_time "
    "string, create_date string, create_hour string, province_name string, province_area_code string, "
    "province_iso_code string, province_3166_2_code string, user_age int, user_gender string, spu_id long, tm_id "
    "long, category3_id long, spu_name string, tm_name string, category3_name string"
)
PAYMENT_WIDE = _ddl(
    "payment_id long, subject string, payment_type string, payment_create_time string, callback_time string, "
    "create_ts long, detail_id long, order_id long, sku_id long, order_price decimal(16,2), sku_num long, "
    "sku_name string, province_id long, order_status string, user_id long, total_amount decimal(16,2), "
    "activity_reduce_amount decimal(16,2), coupon_reduce_amount decimal(16,2), original_total_amount "
    "decimal(16,2), feight_fee decimal(16,2), split_feight_fee decimal(16,2), split_activity_amount "
    "decimal(16,2), split_coupon_amount decimal(16,2), split_total_amount decimal(16,2), order_create_time "
    "string, province_name string, province_area_code string, province_iso_code string, province_3166_2_code "
    "string, user_age int, user_gender string, spu_id long, tm_id long, category3_id long, spu_name string, "
    "tm_name string, category3_name string"
)

# Column order of the serving tables.
VISITOR_STATS = "stt edt vc ch ar is_new uv_ct pv_ct sv_ct uj_ct dur_sum ts".split()
PRODUCT_STATS = (
    "stt edt sku_id sku_name sku_price spu_id spu_name tm_id tm_name category3_id category3_name display_ct click_ct"
    " favor_ct cart_ct order_sku_num order_amount order_ct payment_amount paid_order_ct refund_order_ct refund_amount"
    " comment_ct good_comment_ct ts"
).split()
PROVINCE_STATS = (
    "stt edt province_id province_name province_area_code province_iso_code province_3166_2_code order_amount"
    " order_count ts"
).split()
KEYWORD_STATS = "keyword ct source stt edt ts".split()
