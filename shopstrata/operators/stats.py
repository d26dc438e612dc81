"""Windowed statistics by visitor segment, product, province and keyword."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import ITEM_KEYWORD, KEYWORD_SEARCH, PAGE_PRODUCT_DETAIL, RECORD_ID, REVIEW_GOOD
from ..functions.times import event_time, text_time, window_bounds
from ..functions.words import explode_words, words
from ..schemas import MONEY
from .logs import entry_pages, is_entry

SEGMENT = ["vc", "ch", "ar", "is_new"]
VISITOR_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
PRODUCT_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct", "good_comment_ct"]
PRODUCT_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
# Number of distinct orders: measure name and the column with the order's id.
PRODUCT_ORDERS = {"order_ct": "order_id", "paid_order_ct": "paid_order_id", "refund_order_ct": "refund_order_id"}
PROVINCE = ["province_id", "province_name", "province_area_code", "province_iso_code", "province_3166_2_code"]

# How far rows of one topic may be out of order: its partitions and the micro-batches of the job that writes it, whose
# trigger is ten seconds. Kept apart from how far one topic is behind another, which each one's own watermark covers.
LATENESS = "30 seconds"


def watermarked(df: DataFrame, delay: str, column: str = "ts") -> DataFrame:
    """Bound the lateness of a stream; a batch has none."""
    return df.withWatermark(column, delay) if df.isStreaming else df


def record_id(rows: DataFrame, number: str | None = None) -> list[Column]:
    """The records' ids, if the rows of a stream have them; `number` tells several rows of a record apart."""
    if not rows.isStreaming or RECORD_ID not in rows.columns:
        return []
    return [(F.concat(F.col(RECORD_ID), F.lit("-"), F.col(number).cast("string")) if number else F.col(RECORD_ID)).alias(RECORD_ID)]


def once(rows: DataFrame) -> DataFrame:
    """Rows of a stream with a watermark, each record once: one that a writer repeated has its id. Rows without an id all
    stay. An id is remembered until the watermark is as far past its row as it may be late."""
    if RECORD_ID not in rows.columns:
        return rows
    if not rows.isStreaming:
        return rows.drop(RECORD_ID)
    named = rows.withColumn(RECORD_ID, F.coalesce(RECORD_ID, F.expr("uuid()")))
    return named.dropDuplicatesWithinWatermark([RECORD_ID]).drop(RECORD_ID)


# Visitors


def _visitor_rows(rows: DataFrame, **measures: Column) -> DataFrame:
    return rows.select(
        event_time("ts").alias("ts"),
        *[F.col(f"common.{c}").alias(c) for c in SEGMENT],
        *[measures.get(m, F.lit(0)).cast("long").alias(m) for m in VISITOR_MEASURES],
        *record_id(rows),
    )


def page_views(pages: DataFrame) -> DataFrame:
    duration = F.coalesce(F.col("page.during_time"), F.lit(0))
    return _visitor_rows(pages, pv_ct=F.lit(1), dur_sum=duration)


def session_starts(pages: DataFrame) -> DataFrame:
    return _visitor_rows(entry_pages(pages), sv_ct=F.lit(1))


def visits_counted(visits: DataFrame) -> DataFrame:
    return _visitor_rows(visits, uv_ct=F.lit(1))


def jumps_counted(jumps: DataFrame) -> DataFrame:
    return _visitor_rows(jumps, uj_ct=F.lit(1))


def visitor_union(pages: DataFrame, visits: DataFrame, jumps: DataFrame, delay: str = LATENESS) -> DataFrame:
    """Measures of the page log, the unique visits and the jumps. Views and session starts share one pass.

    Each stream has a watermark of its own, and the slowest one holds: jumps arrive a timeout and some triggers after
    their page without being late. A topic that stays idle holds the others' windows open.
    """
    duration = F.coalesce(F.col("page.during_time"), F.lit(0))
    views = _visitor_rows(pages, pv_ct=F.lit(1), sv_ct=is_entry().cast("long"), dur_sum=duration)
    views, visits, jumps = (once(watermarked(x, delay)) for x in (views, visits_counted(visits), jumps_counted(jumps)))
    return views.unionByName(visits).unionByName(jumps)


def visitor_stats(rows: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Measures by segment and window of the rows of `visitor_union`."""
    sums = [F.sum(m).alias(m) for m in VISITOR_MEASURES]
    grouped = rows.groupBy(F.window("ts", size).alias("w"), *SEGMENT).agg(*sums)
    return grouped.select(*window_bounds(F.col("w")), *SEGMENT, *VISITOR_MEASURES)


# Products


def _product_rows(rows: DataFrame, ts: Column, sku: Column | str, **measures: Column) -> DataFrame:
    def measure(name: str, kind) -> Column:
        return F.coalesce(measures.get(name, F.lit(0)), F.lit(0)).cast(kind).alias(name)

    return rows.select(
        ts.alias("ts"),
        (F.col(sku) if isinstance(sku, str) else sku).cast("long").alias("sku_id"),
        *[measure(m, "long") for m in PRODUCT_COUNTS],
        *[measure(m, MONEY) for m in PRODUCT_AMOUNTS],
        *[measures.get(c, F.lit(None)).cast("long").alias(c) for c in PRODUCT_ORDERS.values()],
        *record_id(rows),
    )


def shown_and_clicked(pages: DataFrame) -> DataFrame:
    """Clicks and displays of the page log in one pass: a row for each displayed item, and one for a product's page."""
    item = lambda value, clicked: F.struct(value.alias("item"), F.lit(clicked).alias("clicked"))
    none = F.array().cast("array<struct<item:string,clicked:int>>")
    click = F.when(F.col("page.page_id") == PAGE_PRODUCT_DETAIL, F.array(item(F.col("page.item").cast("string"), 1))).otherwise(none)
    shown = F.coalesce(F.transform("displays", lambda d: item(d["item"].cast("string"), 0)), none)
    rows = pages.select("*", F.posexplode(F.concat(click, shown)).alias("_n", "_i"))
    rows = rows.select("ts", "_i", *record_id(rows, "_n"))
    return _product_rows(
        rows, event_time("ts"), "_i.item", click_ct=F.col("_i.clicked"), display_ct=1 - F.col("_i.clicked")
    )


def clicks(pages: DataFrame) -> DataFrame:
    shown = pages.where(F.col("page.page_id") == PAGE_PRODUCT_DETAIL)
    return _product_rows(shown, event_time("ts"), "page.item", click_ct=F.lit(1))


def displays(pages: DataFrame) -> DataFrame:
    items = pages.where("size(displays) > 0").select("ts", F.explode("displays.item").alias("item"))
    return _product_rows(items, event_time("ts"), "item", display_ct=F.lit(1))


def favors(rows: DataFrame) -> DataFrame:
    return _product_rows(rows, text_time("create_time"), "sku_id", favor_ct=F.lit(1))


def carts(rows: DataFrame) -> DataFrame:
    return _product_rows(rows, text_time("create_time"), "sku_id", cart_ct=F.lit(1))


def ordered(wide: DataFrame) -> DataFrame:
    """The line's own share of the order, so that an order of several lines is counted once."""
    return _product_rows(
        wide,
        text_time("create_time"),
        "sku_id",
        order_amount=F.col("split_total_amount"),
        order_sku_num=F.col("sku_num"),
        order_id=F.col("order_id"),
    )


def paid(payments: DataFrame) -> DataFrame:
    return _product_rows(
        payments,
        text_time("payment_create_time"),
        "sku_id",
        payment_amount=F.col("split_total_amount"),
        paid_order_id=F.col("order_id"),
    )


def refunded(rows: DataFrame) -> DataFrame:
    return _product_rows(
        rows,
        text_time("create_time"),
        "sku_id",
        refund_amount=F.col("refund_amount"),
        refund_order_id=F.col("order_id"),
    )


def reviewed(rows: DataFrame) -> DataFrame:
    good = F.when(F.col("appraise") == REVIEW_GOOD, 1).otherwise(0)
    return _product_rows(rows, text_time("create_time"), "sku_id", comment_ct=F.lit(1), good_comment_ct=good)


def product_union(*sources: DataFrame, delay: str = LATENESS) -> DataFrame:
    """The sources' rows. Streams have a watermark each, and the slowest one holds (see `visitor_union`)."""
    return reduce(DataFrame.unionByName, [once(watermarked(s, delay)) for s in sources])


def distinct_orders(rows: DataFrame, keys: list, names: list[str], sums=(), totals=()) -> DataFrame:
    """Exact numbers of distinct orders per key, with sums beside them.

    `keys` are the columns to group by and `names` what they are called. A row has at most one of the order columns, or
    the same order in several.
    """
    order = F.coalesce(*PRODUCT_ORDERS.values()).alias("_order")
    seen = [F.max(F.col(c).isNotNull().cast("long")).alias(m) for m, c in PRODUCT_ORDERS.items()]
    by_order = rows.groupBy(*keys, order).agg(*sums, *seen)
    return by_order.groupBy(*names).agg(*totals, *[F.sum(m).alias(m) for m in PRODUCT_ORDERS])


def product_stats(rows: DataFrame, size: str = "2 seconds") -> DataFrame:
    """Measures by product and window of the rows of `product_union`, with exact numbers of distinct orders.

    The first aggregation is by product and order, so an order is one row to the second, which only counts. A product
    with a third of all orders is spread over its orders there; no set of ids is ever built.
    """
    keys = [F.window("ts", size).alias("w"), F.col("sku_id")]
    sums = [F.sum(m).alias(m) for m in PRODUCT_COUNTS + PRODUCT_AMOUNTS]
    totals = [F.sum(m).alias(m) for m in PRODUCT_COUNTS + PRODUCT_AMOUNTS]
    grouped = distinct_orders(rows, keys, ["w", "sku_id"], sums, totals)
    return grouped.select(
        *window_bounds(F.col("w")), "sku_id", *PRODUCT_COUNTS, *PRODUCT_AMOUNTS, *PRODUCT_ORDERS
    )


# Provinces


def province_stats(wide: DataFrame, size: str = "2 seconds", delay: str = LATENESS) -> DataFrame:
    """Amount, lines and orders by province and window of the order's creation."""
    timed = wide.withColumn("ts", text_time("create_time")) if "ts" not in wide.columns else wide
    by_order = (
        once(watermarked(timed, delay))
        .groupBy(F.window("ts", size).alias("w"), *PROVINCE, "order_id")
        .agg(F.sum("split_total_amount").alias("order_amount"), F.count(F.lit(1)).alias("order_count"))
    )
    grouped = by_order.groupBy("w", *PROVINCE).agg(
        F.sum("order_amount").alias("order_amount"),
        F.sum("order_count").alias("order_count"),
        F.count("order_id").alias("order_dcount"),
    )
    return grouped.select(*window_bounds(F.col("w")), *PROVINCE, "order_amount", "order_count", "order_dcount")


# Keywords


def searches(pages: DataFrame) -> DataFrame:
    """Search phrases with their event time."""
    asked = pages.where((F.col("page")["item_type"] == ITEM_KEYWORD) & F.col("page")["item"].isNotNull())
    time = F.col("rowtime") if "rowtime" in pages.columns else event_time("ts")
    return asked.select(F.col("page")["item"].alias("full_word"), time.alias("ts"), *record_id(pages))


def keyword_stats(phrases: DataFrame, size: str = "2 seconds", delay: str = "2 seconds", split=words) -> DataFrame:
    """Occurrences of each word by window."""
    said = explode_words(once(watermarked(phrases, delay)), "full_word", "keyword", split)
    return counted(said, size, "keyword").withColumn("source", F.lit(KEYWORD_SEARCH)).select("keyword", "ct", "source", "stt", "edt")


def counted(rows: DataFrame, size: str, *keys: str) -> DataFrame:
    """Rows by window and keys."""
    grouped = rows.groupBy(F.window("ts", size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("ct"))
    return grouped.select(*window_bounds(F.col("w")), *keys, "ct")
