"""The shop's tables as views of the sample star schema (parquet files in one folder).

Events are the application log, orders and line items the orders, parts the products and nations the provinces. Where
the sample has no counterpart a column is derived from a key, so that every row of the sample takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import SINK_DIM, SINK_STREAM
from ..functions.times import time_text
from ..operators.changes import routing_rows
from ..schemas import MONEY


# Columns of the sample tables, declared so that no job has to infer them.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def table(spark: SparkSession, folder: str, name: str, stream: bool = False) -> DataFrame:
    """A sample table, or the stream of its files; its zone-less times become instants of the session's zone."""
    path = f"{folder}/{name}.parquet"
    # The pattern lets a stream read a table that is one file as well as one that is a folder of files.
    reader, path = (spark.readStream, f"{path}*") if stream else (spark.read, path)
    df = reader.schema(_COLUMNS[name]).parquet(path)
    zoneless = [n for n, t in df.dtypes if t == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in zoneless})


def _money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def _share(price: str, discount: str) -> Column:
    """Price less discount, in decimals throughout."""
    return (_money(price) * (1 - F.col(discount).cast("decimal(4,2)"))).cast(MONEY)


def app_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as log records: sign-ups start the application, views search, clicks open a product and show others."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name")
    events = table(spark, folder, "events").withColumn("_parts", parts.agg(F.count(F.lit(1))).scalar())
    n_parts, event_id, user_id, kind = (F.col(c) for c in ("_parts", "event_id", "user_id", "event_type"))
    sku = F.pmod(event_id, n_parts)
    k = F.get_json_object("props", "$.k").cast("int")
    shown = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(3)), lambda i: i < F.pmod(k, F.lit(4))),
        lambda i: F.struct(F.pmod(event_id + i, n_parts).cast("string").alias("item")),
    )
    common = F.struct(
        F.concat(F.lit("ar"), F.pmod(user_id, F.lit(7))).alias("ar"),
        user_id.cast("string").alias("uid"),
        F.lit("Android").alias("os"),
        F.concat(F.lit("ch"), F.pmod(event_id, F.lit(5))).alias("ch"),
        F.when(F.pmod(event_id, F.lit(2)) == 0, "1").otherwise("0").alias("is_new"),
        F.lit("phone").alias("md"),
        F.concat(F.lit("mid_"), user_id).alias("mid"),
        F.concat(F.lit("v"), F.pmod(event_id, F.lit(3))).alias("vc"),
        F.lit("phone").alias("ba"),
    )
    start = F.when(
        kind == "signup",
        F.struct(
            F.lit("icon").alias("entry"),
            F.floor(F.col("value") * 1000).alias("loading_time"),
            event_id.alias("open_ad_id"),
            F.lit(0).cast("long").alias("open_ad_ms"),
            F.lit(0).cast("long").alias("open_ad_skip_ms"),
        ),
    )
    page = F.struct(
        F.when(kind == "click", "good_detail").otherwise(kind).alias("page_id"),
        F.when(kind == "view", F.col("p_name")).otherwise(sku.cast("string")).alias("item"),
        F.when(kind == "view", "keyword").otherwise("sku_id").alias("item_type"),
        F.when(kind != "view", "home").alias("last_page_id"),
        F.floor(F.col("value") * 1000).alias("during_time"),
    )
    return events.join(parts, sku == F.col("p_partkey"), "left").select(
        common.alias("common"),
        start.alias("start"),
        F.when(kind != "signup", page).alias("page"),
        F.when(kind == "click", shown).alias("displays"),
        F.unix_millis("ts").alias("ts"),
        event_id.alias("log_id"),
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The log as JSON texts, as an application would send it."""
    log = app_log(spark, folder)
    return log.select(F.to_json(F.struct("common", "start", "page", "displays", "ts")).alias("value"), "log_id")


def order_info(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    orders = table(spark, folder, "orders", stream)
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nothing = F.lit(0).cast(MONEY)
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("long").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        nothing.alias("activity_reduce_amount"),
        nothing.alias("coupon_reduce_amount"),
        _money("o_totalprice").alias("original_total_amount"),
        nothing.alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        time_text(F.col("o_orderdate")).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"),
    )


def order_detail(spark: SparkSession, folder: str) -> DataFrame:
    """Line items; their id is order * 8 + line number, which repeats where the sample repeats a line number."""
    lines = table(spark, folder, "lineitem")
    return lines.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        _money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("long").alias("sku_num"),
        F.concat(F.lit("line "), F.col("l_linenumber")).alias("sku_name"),
        time_text(F.col("l_shipdate")).alias("create_time"),
        _share("l_extendedprice", "l_discount").alias("split_total_amount"),
        (_money("l_extendedprice") - _share("l_extendedprice", "l_discount")).cast(MONEY).alias("split_activity_amount"),
        F.lit(0).cast(MONEY).alias("split_coupon_amount"),
    )


def payment_info(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Orders that are finished or partly shipped, paid up to half an hour after they were made."""
    orders = table(spark, folder, "orders", stream).where(F.col("o_orderstatus").isin("F", "P"))
    paid_at = F.timestamp_add("MINUTE", F.pmod("o_orderkey", F.lit(30)).cast("int"), "o_orderdate")
    return orders.select(
        (F.col("o_orderkey") + 1_000_000_000).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey")).alias("subject"),
        F.when(F.col("o_orderstatus") == "F", "1101").otherwise("1102").alias("payment_type"),
        time_text(paid_at).alias("create_time"),
        time_text(paid_at).alias("callback_time"),
    )


def _user_actions(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    n_parts = table(spark, folder, "part").agg(F.count(F.lit(1))).scalar()
    events = table(spark, folder, "events").where(F.col("event_type") == kind)
    return events.select(F.pmod("event_id", n_parts).alias("sku_id"), time_text(F.col("ts")).alias("create_time"))


def favor_info(spark: SparkSession, folder: str) -> DataFrame:
    return _user_actions(spark, folder, "signup")


def cart_info(spark: SparkSession, folder: str) -> DataFrame:
    return _user_actions(spark, folder, "purchase")


def refund_info(spark: SparkSession, folder: str) -> DataFrame:
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.select(
        F.col("l_partkey").alias("sku_id"),
        F.col("l_orderkey").alias("order_id"),
        _share("l_extendedprice", "l_discount").alias("refund_amount"),
        time_text(F.col("l_shipdate")).alias("create_time"),
    )


def comment_info(spark: SparkSession, folder: str) -> DataFrame:
    kept = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "N")
    return kept.select(
        F.col("l_partkey").alias("sku_id"),
        F.when(F.col("l_discount") < 0.05, "1203").otherwise("1201").alias("appraise"),
        time_text(F.col("l_shipdate")).alias("create_time"),
    )


# Dimensions; all columns are texts.


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), F.pmod(key, F.lit(15000)).cast("int"))
    return table(spark, folder, "customer").select(
        key.cast("string").alias("id"),
        born.cast("string").alias("birthday"),
        F.when(F.pmod(key, F.lit(2)) == 0, "F").otherwise("M").alias("gender"),
    )


def provinces(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    return table(spark, folder, "nation").select(
        key.alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("area_code"),
        F.concat(F.lit("CN-"), key).alias("iso_code"),
        F.concat(F.lit("ISO-"), key).alias("iso_3166_2"),
    )


def _brand_id(brand: Column) -> Column:
    return F.regexp_extract(brand, r"(\d+)", 1)


def _type_id(kind: Column) -> Column:
    return F.conv(F.substring(F.md5(kind), 1, 8), 16, 10)


def skus(spark: SparkSession, folder: str) -> DataFrame:
    """Parts; a part's size is the number of its product family."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("sku_name"),
        _money("p_retailprice").cast("string").alias("price"),
        F.col("p_size").cast("string").alias("spu_id"),
        _brand_id(F.col("p_brand")).alias("tm_id"),
        _type_id(F.col("p_type")).alias("category3_id"),
    )


def spus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("spu_name")
    )


def trademarks(spark: SparkSession, folder: str) -> DataFrame:
    brands = table(spark, folder, "part").select("p_brand").distinct()
    return brands.select(_brand_id(F.col("p_brand")).alias("id"), F.col("p_brand").alias("tm_name"))


def categories(spark: SparkSession, folder: str) -> DataFrame:
    kinds = table(spark, folder, "part").select("p_type").distinct()
    return kinds.select(_type_id(F.col("p_type")).alias("id"), F.col("p_type").alias("name"))


# Change records.


def cdc_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of orders (inserts, updates and rows of an initial load) and of customers, some of them empty."""
    orders = table(spark, folder, "orders")
    status = F.col("o_orderstatus")
    order_rows = orders.select(
        F.lit("shop").alias("database"),
        F.lit("order_info").alias("table"),
        F.when(status == "O", "insert").when(status == "P", "bootstrap-insert").otherwise("update").alias("type"),
        F.col("o_orderkey").alias("xid"),
        F.create_map(
            F.lit("id"), F.col("o_orderkey").cast("string"),
            F.lit("user_id"), F.col("o_custkey").cast("string"),
            F.lit("order_status"), status,
            F.lit("priority"), F.col("o_orderpriority"),
        ).alias("data"),
    )
    customers = table(spark, folder, "customer")
    customer_rows = customers.select(
        F.lit("shop").alias("database"),
        F.lit("user_info").alias("table"),
        F.when(F.col("c_mktsegment") == "BUILDING", "delete").otherwise("insert").alias("type"),
        (F.col("c_custkey") + 2_000_000_000).alias("xid"),
        F.when(
            F.col("c_acctbal") >= 0,
            F.create_map(
                F.lit("id"), F.col("c_custkey").cast("string"),
                F.lit("name"), F.col("c_name"),
                F.lit("segment"), F.col("c_mktsegment"),
            ),
        ).alias("data"),
    )
    return order_rows.unionByName(customer_rows)


def row_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Log entries of orders: deletes, updates and inserts of up to three rows, some entries being transaction marks."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")

    def image(value: Column) -> Column:
        return F.create_map(F.lit("id"), key.cast("string"), F.lit("amount"), value.cast("string"))

    row = lambda i: F.struct(image(key + i).alias("before"), image(key + i + 1).alias("after"))
    rows = F.transform(F.sequence(F.lit(0), F.pmod(key, F.lit(3)).cast("int")), row)
    return table(spark, folder, "orders").select(
        F.lit("shop").alias("schema"),
        F.lit("order_info").alias("table"),
        F.when(status == "F", "DELETE").when(status == "P", "UPDATE").otherwise("INSERT").alias("event_type"),
        key.alias("execute_time"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "TRANSACTIONBEGIN").otherwise("ROWDATA").alias("entry_type"),
        rows.alias("rows"),
    )


def routing(spark: SparkSession) -> DataFrame:
    return routing_rows(spark, [
        ("order_info", "insert", SINK_STREAM, "dwd_order_info", "id,user_id,order_status", "id", None),
        ("order_info", "update", SINK_STREAM, "dwd_order_info_update", "id,order_status", None, None),
        ("user_info", "insert", SINK_DIM, "dim_user_info", "id,name", None, None),
    ])
