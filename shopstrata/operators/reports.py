"""Reports on the product statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def day_sums(stats: DataFrame) -> DataFrame:
    """Order amounts by day and trademark: of product statistics, or of such sums again."""
    day = F.col("dt") if "dt" in stats.columns else F.substring("stt", 1, 10)
    return stats.groupBy(day.cast("string").alias("dt"), "tm_id", "tm_name").agg(F.sum("order_amount").cast("decimal(38,2)").alias("order_amount"))


def of_day(stats: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Windows that start on `day` (default: today). A range on the text `stt`, which reaches the scan as it is.

    A table kept by day has a `dt` column besides; it leaves the other days' files unread. A rollup has `dt` alone.
    """
    if day is None:
        first = F.date_format(F.current_date(), "yyyy-MM-dd")
        after = F.date_format(F.date_add(F.current_date(), 1), "yyyy-MM-dd")
    else:
        first, after = F.lit(day.isoformat()), F.lit((day + dt.timedelta(days=1)).isoformat())
    if "dt" in stats.columns:
        stats = stats.where(F.col("dt").cast("date") == first.cast("date")) if "stt" in stats.columns else stats.where(F.col("dt") == first)
    if "stt" not in stats.columns:
        return stats
    return stats.where((F.col("stt") >= first) & (F.col("stt") < after))


def gmv(stats: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Order amount of a day; null when nothing was sold."""
    return of_day(stats, day).agg(F.sum("order_amount").alias("order_amount"))


def top_trademarks(stats: DataFrame, day: dt.date | None = None, limit: int = 10) -> DataFrame:
    """The trademarks with the largest order amount of a day, equal amounts by name."""
    amounts = of_day(stats, day).groupBy("tm_name").agg(F.sum("order_amount").alias("order_amount"))
    return amounts.where("order_amount > 0").orderBy(F.desc("order_amount"), "tm_name").limit(limit)


def chart_series(top: DataFrame, name: str = "tm_name", value: str = "order_amount") -> DataFrame:
    """One chart document of an already limited report: names and their values, largest first."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col(value)).alias("k"), F.col(name).alias("n"), F.col(value).alias("v"))))
    data = F.struct(
        F.transform("rows", lambda r: r["n"]).alias("categories"),
        F.array(F.struct(F.transform("rows", lambda r: r["v"]).alias("data"))).alias("series"),
    )
    reply = F.struct(F.lit(0).alias("status"), data.alias("data"))
    return top.agg(rows.alias("rows")).select(F.to_json(reply).alias("reply"))


def gmv_reply(amount: DataFrame) -> DataFrame:
    """The day's amount as a reply document."""
    reply = F.struct(F.lit(0).alias("status"), F.lit("").alias("msg"), F.col("order_amount").alias("data"))
    return amount.select(F.to_json(reply, _KEEP_NULLS).alias("reply"))
