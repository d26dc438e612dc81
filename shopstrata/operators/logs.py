"""Application log: new-visitor repair and the split into page, start and display rows."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import DWD_DISPLAY, DWD_PAGE, DWD_START, RECORD_ID

_NEW = "1"
_KNOWN = "0"


def time_order(ts: str, id_col: str) -> Column:
    """Time and id as one number, in that order: a fixed-width value that hash aggregates can hold."""
    number = F.col(ts).cast("decimal(17,0)") * F.lit(Decimal(10**20))
    return (number + F.col(id_col).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))).cast("decimal(38,0)")


def is_entry() -> Column:
    """The page was not reached from another page."""
    return F.coalesce(F.col("page.last_page_id"), F.lit("")) == ""


def entry_pages(pages: DataFrame) -> DataFrame:
    return pages.where(is_entry())


def repair_is_new(log: DataFrame, id_col: str = "log_id") -> DataFrame:
    """Keep a device's first `is_new = '1'` by time and turn its later ones into '0'.

    The first row per device is a small hash aggregate. Marked rows are joined with it on the row's full identity rather
    than on the device, so a device with a third of the log is spread like any other. All other rows, also those
    without a device, pass beside the join. `id_col` must be unique; it orders rows of the same millisecond.
    """
    marked = F.coalesce(F.col("common.is_new") == _NEW, F.lit(False)) & F.col("common.mid").isNotNull()
    rows = log.where(marked).select("*", F.col("common.mid").alias("_mid"), time_order("ts", id_col).alias("_order"))
    firsts = rows.groupBy("_mid").agg(F.min("_order").alias("_order")).withColumn("_first", F.lit(True))
    is_new = F.when(F.col("_first"), _NEW).otherwise(_KNOWN)
    common = F.col("common").withField("is_new", is_new).alias("common")
    fixed = rows.join(firsts, ["_mid", "_order"], "left").select(*[common if c == "common" else c for c in log.columns])
    return log.where(~marked).unionByName(fixed)


def start_rows(log: DataFrame) -> DataFrame:
    return log.where("start is not null").drop("page", "displays")


def display_rows(log: DataFrame) -> DataFrame:
    """One row per displayed item, with the page it was shown on."""
    shown = log.where("start is null and size(displays) > 0")
    kept = [c for c in log.columns if c not in ("start", "page", "displays")]
    return shown.select(*kept, F.col("page.page_id").alias("page_id"), F.explode("displays").alias("_d")).select(
        *kept, "page_id", "_d.*"
    )


def page_rows(log: DataFrame, exclusive: bool = False) -> DataFrame:
    """Page rows; `exclusive` leaves out pages that have displays."""
    pages = log.where("start is null")
    if exclusive:
        pages = pages.where(F.coalesce(F.size("displays"), F.lit(0)) <= 0)
    return pages.drop("start")


def route_log(log: DataFrame, exclusive: bool = False, ids: bool = False) -> DataFrame:
    """All three outputs in one pass: the topic of each record and its JSON text.

    ids: also an id, from the raw record's `log_id` and the output's number; null where there is no `log_id`.
    """
    meta = [c for c in log.columns if c not in ("start", "page", "displays")]
    targets = "array<struct<topic:string,item:string>>"

    def target(topic: str, item: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), item.cast("string").alias("item"))

    shown = F.coalesce(F.transform("displays", lambda d: target(DWD_DISPLAY, d["item"])), F.array().cast(targets))
    page = F.array(target(DWD_PAGE, F.lit(None)))
    start = F.array(target(DWD_START, F.lit(None)))
    beside = F.when(F.size(shown) > 0, F.array().cast(targets)).otherwise(page) if exclusive else page
    out = F.when(F.col("start").isNotNull(), start).otherwise(F.concat(beside, shown))
    value = (
        F.when(F.col("_t.topic") == DWD_START, F.to_json(F.struct(*meta, "start")))
        .when(F.col("_t.topic") == DWD_PAGE, F.to_json(F.struct(*meta, "page", "displays")))
        .otherwise(F.to_json(F.struct(*meta, F.col("page.page_id").alias("page_id"), F.col("_t.item").alias("item"))))
    )
    rows = log.select("*", F.posexplode(out).alias("_n", "_t"))
    number = F.col("log_id").cast("string") if "log_id" in log.columns else F.lit(None).cast("string")
    record_id = [F.concat(number, F.lit("-"), F.col("_n").cast("string")).alias(RECORD_ID)] if ids else []
    return rows.select(F.col("_t.topic").alias("topic"), value.alias("value"), *record_id)
