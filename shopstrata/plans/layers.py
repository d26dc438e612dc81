"""The warehouse's jobs as functions of their input tables; batch and stream use the same ones unless noted."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import dims, stats, visits, wide
from ..operators.logs import page_rows, repair_is_new


@dataclass
class Dimensions:
    """Current dimension tables."""

    users: DataFrame
    provinces: DataFrame
    skus: DataFrame
    spus: DataFrame
    trademarks: DataFrame
    categories: DataFrame

    def flat_skus(self) -> DataFrame:
        return dims.flat_skus(self.skus, self.spus, self.trademarks, self.categories)


def page_log(log: DataFrame, id_col: str = "log_id", exclusive: bool = False) -> DataFrame:
    """Batch form: raw log to repaired page rows."""
    return page_rows(repair_is_new(log, id_col), exclusive)


def order_wide(
    orders: DataFrame,
    details: DataFrame,
    dimensions: Dimensions,
    as_of: dt.date | None = None,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Batch form: order lines with their order and all dimensions.

    Each side gets its dimensions before the two are joined: an order meets its user and province once instead of once
    a line, and the rows that are shuffled for it are the narrow ones. The dimensions are matched by unique key, so
    the result is the same. `sized_by` is a plain table with the rows of `orders` when that is itself made by joins.
    """
    heads, lines = orders, details
    orders, details = wide.derive_order_time(orders), wide.derive_create_at(details)
    orders = dims.with_user(orders, dimensions.users, as_of, spread_by=["id"], counted_in=heads)
    orders = dims.with_province(orders, dimensions.provinces, spread_by=["id"], counted_in=heads)
    flat = dimensions.flat_skus()
    details = dims.with_flat_sku(details, flat, spread_by=["id"], sized_by=dimensions.skus, counted_in=lines)
    return wide.merge_order_wide(wide.join_orders(orders, details, lower, upper, sized_by))


def bare_order_wide(
    orders: DataFrame,
    details: DataFrame,
    lower: str = "-5 seconds",
    upper: str = "5 seconds",
    delay: str = "0 seconds",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Order lines with their order, without dimensions; the form for streams, which are named per micro-batch."""
    orders = stats.watermarked(wide.derive_order_time(orders), delay, "create_at")
    details = stats.watermarked(wide.derive_create_at(details), delay, "create_at")
    return wide.merge_order_wide(wide.join_orders(orders, details, lower, upper, sized_by))


def name_order_wide(bare: DataFrame, dimensions: Dimensions, as_of: dt.date | None = None) -> DataFrame:
    """Add the dimensions to bare wide orders, a table (or kept micro-batch) that is read more than once."""
    by = {"spread_by": ["detail_id"], "counted_in": bare}
    rows = dims.with_user(bare, dimensions.users, as_of, **by)
    rows = dims.with_province(rows, dimensions.provinces, **by)
    rows = dims.with_flat_sku(rows, dimensions.flat_skus(), sized_by=dimensions.skus, **by)
    return rows.select(*bare.columns)


def payment_wide(
    payments: DataFrame,
    orders_wide: DataFrame,
    lower: str = "-15 minutes",
    upper: str = "5 seconds",
    delay: str = "0 seconds",
) -> DataFrame:
    payments = stats.watermarked(wide.derive_create_at(payments), delay, "create_at")
    return wide.merge_payment_wide(wide.join_payments(payments, orders_wide, lower, upper))


def visitor_stats(
    pages: DataFrame,
    visits_rows: DataFrame | None = None,
    jumps_rows: DataFrame | None = None,
    jump_timeout: int = 10,
    zone: str | None = None,
    size: str = "10 seconds",
    delay: str = stats.LATENESS,
) -> DataFrame:
    """Visitor statistics of a page log; the visits and jumps of a batch are derived here when not given."""
    visits_rows = visits.unique_visits(pages, zone=zone) if visits_rows is None else visits_rows
    jumps_rows = visits.user_jumps(pages, jump_timeout) if jumps_rows is None else jumps_rows
    return stats.visitor_stats(stats.visitor_union(pages, visits_rows, jumps_rows, delay), size)


def product_rows(
    pages: DataFrame,
    favors: DataFrame,
    carts: DataFrame,
    orders_wide: DataFrame,
    payments_wide: DataFrame,
    refunds: DataFrame,
    comments: DataFrame,
    delay: str = stats.LATENESS,
) -> DataFrame:
    return stats.product_union(
        stats.shown_and_clicked(pages),
        stats.favors(favors),
        stats.carts(carts),
        stats.ordered(orders_wide),
        stats.paid(payments_wide),
        stats.refunded(refunds),
        stats.reviewed(comments),
        delay=delay,
    )


def product_stats(rows: DataFrame, dimensions: Dimensions, size: str = "2 seconds") -> DataFrame:
    """Product statistics, aggregated first and named afterwards."""
    return name_products(stats.product_stats(rows, size), dimensions)


def name_products(grouped: DataFrame, dimensions: Dimensions) -> DataFrame:
    return dims.with_flat_sku(
        grouped, dimensions.flat_skus(), price=True, spread_by=["stt"], sized_by=dimensions.skus
    )
