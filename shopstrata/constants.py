"""Names and codes shared with the shop's producers and consumers."""

# Topic (table) names of the layers.
ODS_LOG = "ods_base_log"
ODS_DB = "ods_base_db_m"
DWD_PAGE = "dwd_page_log"
DWD_START = "dwd_start_log"
DWD_DISPLAY = "dwd_display_log"
DWD_DEFAULT = "dwd_default_topic"
# Own name: page records that could not be read.
DWD_DIRTY = "dwd_dirty_page_log"
DWD_ORDER_INFO = "dwd_order_info"
DWD_ORDER_DETAIL = "dwd_order_detail"
DWD_PAYMENT_INFO = "dwd_payment_info"
DWD_FAVOR_INFO = "dwd_favor_info"
DWD_CART_INFO = "dwd_cart_info"
DWD_REFUND_INFO = "dwd_order_refund_info"
DWD_COMMENT_INFO = "dwd_comment_info"
DWM_UNIQUE_VISIT = "dwm_unique_visit"
DWM_USER_JUMP = "dwm_user_jump_detail"
DWM_ORDER_WIDE = "dwm_order_wide"
DWM_PAYMENT_WIDE = "dwm_payment_wide"

# Routing targets of the change-record configuration.
SINK_STREAM = "kafka"
SINK_DIM = "hbase"

# Fixed value: the code of a good review.
REVIEW_GOOD = "1203"

# What a page row must say to count as a product click or a search.
PAGE_PRODUCT_DETAIL = "good_detail"
ITEM_KEYWORD = "keyword"

# Fixed value: the origin of a searched keyword.
KEYWORD_SEARCH = "SEARCH"

# Text form of an event time and of a report day.
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"
DAY_TEXT = "yyyyMMdd"
SHOP_ZONE = "+08:00"

# Dimension tables and the columns the jobs use; the key is `id`.
DIMENSIONS = {
    "users": ("dim_user_info", "id birthday gender"),
    "provinces": ("dim_base_province", "id name area_code iso_code iso_3166_2"),
    "skus": ("dim_sku_info", "id sku_name price spu_id tm_id category3_id"),
    "spus": ("dim_spu_info", "id spu_name"),
    "trademarks": ("dim_base_trademark", "id tm_name"),
    "categories": ("dim_base_category3", "id name"),
}
#: The facts' key columns of the dimensions that they ask for.
FACT_KEYS = {"users": "user_id", "provinces": "province_id", "skus": "sku_id"}

# Serving tables.
VISITOR_TABLE = "visitor_stats"
PRODUCT_TABLE = "product_stats"
PROVINCE_TABLE = "province_stats"
KEYWORD_TABLE = "keyword_stats"

#: The column of a topic's records that holds an id which a repeated record has again.
RECORD_ID = "record_id"
