"""Wide order and payment rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import text_time
from ..schemas import ORDER_WIDE, PAYMENT_WIDE
from .joins import interval_join

# Which columns of a wide row come from where.
_FROM_ORDER = (
    "order_status create_time create_date create_hour activity_reduce_amount coupon_reduce_amount"
    " original_total_amount feight_fee total_amount province_id user_id"
).split()
_FROM_DETAIL = (
    "sku_id sku_name order_price sku_num split_activity_amount split_coupon_amount split_total_amount"
).split()
_DIM_COLUMNS = (
    "province_name province_area_code province_iso_code province_3166_2_code user_age user_gender spu_id tm_id"
    " category3_id spu_name tm_name category3_name"
).split()
_UNSET = ["split_feight_fee", "expire_time", "operate_time"]

# What an incomplete wide row takes from another row of the same order.
FILLED_FROM_OTHER = (
    "order_status create_time create_date coupon_reduce_amount activity_reduce_amount original_total_amount"
    " feight_fee total_amount user_id sku_id sku_name order_price sku_num"
).split()


def derive_order_time(orders: DataFrame) -> DataFrame:
    """Date and time of day of `create_time` as texts, and the instant as `create_at`."""
    parts = F.split("create_time", " ")
    return orders.select(
        "*",
        parts.getItem(0).alias("create_date"),
        parts.getItem(1).alias("create_hour"),
        text_time("create_time").alias("create_at"),
    )


def derive_create_at(rows: DataFrame) -> DataFrame:
    return rows.withColumn("create_at", text_time("create_time"))


def _wide(names: list[str], schema, given: dict[str, Column]) -> list[Column]:
    return [given[n].alias(n) if n in given else F.lit(None).cast(schema[n].dataType).alias(n) for n in names]


def merge_order_wide(joined: DataFrame) -> DataFrame:
    """Wide rows of joined details (`b`) and orders (`s`), with the dimension columns either side already has."""
    order = set(joined.select("s.*").columns)
    detail = set(joined.select("b.*").columns)
    given = {n: F.col(f"s.{n}") for n in _FROM_ORDER}
    given |= {n: F.col(f"b.{n}") for n in _FROM_DETAIL}
    given |= {"order_id": F.col("s.id"), "detail_id": F.col("b.id")}
    for n in _DIM_COLUMNS:
        side = "s" if n in order else "b" if n in detail else None
        if side:
            given[n] = F.col(f"{side}.{n}")
    given = {n: c for n, c in given.items() if n not in _UNSET}
    return joined.select(*_wide(ORDER_WIDE.names, ORDER_WIDE, given), F.col("s.create_at").alias("create_at"))


def order_only(orders: DataFrame) -> DataFrame:
    """Wide rows that know only their order."""
    given = {n: F.col(n) for n in _FROM_ORDER} | {"order_id": F.col("id")}
    return derive_order_time(orders).select(*_wide(ORDER_WIDE.names, ORDER_WIDE, given))


def detail_only(details: DataFrame) -> DataFrame:
    """Wide rows that know only their detail and its order's id."""
    given = {n: F.col(n) for n in _FROM_DETAIL} | {"detail_id": F.col("id"), "order_id": F.col("order_id")}
    return details.select(*_wide(ORDER_WIDE.names, ORDER_WIDE, given))


def join_orders(
    orders: DataFrame,
    details: DataFrame,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Details with their order, where the detail was created within [order + lower, order + upper]."""
    times = ("create_at", "create_at")
    return interval_join(details, orders, ("order_id", "id"), times, lower, upper, sized_by)


def join_payments(
    payments: DataFrame, wide: DataFrame, lower: str = "-15 minutes", upper: str = "5 seconds"
) -> DataFrame:
    """Wide orders with their payment, where the order was created within [payment + lower, payment + upper]."""
    return interval_join(wide, payments, ("order_id", "order_id"), ("create_at", "create_at"), lower, upper)


def merge_payment_wide(joined: DataFrame) -> DataFrame:
    """Payment rows on their wide order (`b`); where both have a column, the payment (`s`) wins."""
    wide = set(joined.select("b.*").columns)
    given = {n: F.col(f"b.{n}") for n in PAYMENT_WIDE.names if n in wide}
    given |= {n: F.col(f"s.{n}") for n in "subject payment_type callback_time order_id user_id total_amount".split()}
    given |= {
        "payment_id": F.col("s.id"),
        "payment_create_time": F.col("s.create_time"),
        "create_ts": F.unix_millis("s.create_at"),
        "order_create_time": F.col("b.create_time"),
    }
    return joined.select(
        *_wide(PAYMENT_WIDE.names, PAYMENT_WIDE, given), F.col("s.create_at").alias("payment_create_at")
    )


def province_from_order(wide: DataFrame) -> DataFrame:
    """A wide order as a one-row province statistic."""
    return wide.select(
        "province_id",
        "province_name",
        "province_area_code",
        "province_iso_code",
        "province_3166_2_code",
        F.col("split_total_amount").alias("order_amount"),
        F.lit(1).cast("long").alias("order_count"),
    )
