"""Unique visits and bounced visits of a page log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import day_of, event_time
from ..streaming.state import first_day_visits, jumps_by_slots
from .joins import balanced_join
from .logs import entry_pages, is_entry, time_order


def unique_visits(
    pages: DataFrame, mode: str = "first", zone: str | None = None, id_col: str = "log_id", delay: str = "1 second",
    keep_ms: int | None = None,
) -> DataFrame:
    """Entry pages that count a visitor once a day.

    `first` keeps a device's first entry page of each day. `first_day` keeps every entry page of the first day the
    device was seen on, and nothing later. A stream keeps the first row to arrive and, in mode `first`, forgets a day once
    the watermark is a day past it; `keep_ms` makes mode `first_day` forget a device (see `state.first_day_visits`).
    """
    visits = entry_pages(pages).where("common.mid is not null").withColumn("_day", day_of(event_time("ts"), zone))
    if pages.isStreaming:
        if mode == "first_day":
            return first_day_visits(pages, zone, keep_ms, delay)
        if mode != "first":
            raise ValueError(f"unknown mode {mode!r}")
        keyed = visits.select("*", F.col("common.mid").alias("_mid"), event_time("ts").alias("_at"))
        state_kept = f"{delay} 24 hours"
        return (
            keyed.withWatermark("_at", state_kept)
            .dropDuplicatesWithinWatermark(["_mid", "_day"])
            .drop("_day", "_mid", "_at")
        )
    if mode == "first":
        # The aggregate holds numbers only; the pages are found again by device and by time and id.
        keyed = visits.select("*", F.col("common.mid").alias("_mid"), time_order("ts", id_col).alias("_order"))
        firsts = keyed.groupBy("_mid", "_day").agg(F.min("_order").alias("_order"))
        return keyed.join(firsts, ["_mid", "_day", "_order"], "left_semi").select(*pages.columns)
    if mode == "first_day":
        keyed = visits.withColumn("_mid", F.col("common.mid"))
        first_days = keyed.groupBy("_mid").agg(F.min("_day").alias("_day"))
        same_day = balanced_join(
            keyed, first_days, [("_mid", "_mid"), ("_day", "_day")], "left_semi", [id_col], sized_by=pages
        )
        return same_day.select(*pages.columns)
    raise ValueError(f"unknown mode {mode!r}")


def user_jumps(
    pages: DataFrame, timeout_seconds: int = 10, id_col: str = "log_id", delay: str = "0 seconds"
) -> DataFrame:
    """Entry pages not followed by another page of the device within the timeout.

    A follow-up is a page reached from another page, after the entry (by time and id) and less than the timeout later.
    """
    if pages.isStreaming:
        return jumps_by_slots(pages, timeout_seconds, delay, id_col)
    timeout = timeout_seconds * 1000
    # A device's log is cut into slots of one timeout, so a busy device is many groups, and of a slot's follow-ups only
    # the last and the first matter: a later one in the entry's own slot is within the timeout, and of the next slot
    # the first one tells.
    slotted = pages.where("common.mid is not null").select("*", F.col("common.mid").alias("_mid"), F.floor(F.col("ts") / timeout).alias("_slot"), time_order("ts", id_col).alias("_order"))
    follows = slotted.where(~is_entry()).groupBy("_mid", "_slot").agg(F.max("_order").alias("_last"), F.min("ts").alias("_first"))
    own, following = follows.select("_mid", "_slot", "_last"), follows.select("_mid", (F.col("_slot") - 1).alias("_slot"), "_first")
    entries = slotted.where(is_entry()).join(own, ["_mid", "_slot"], "left").join(following, ["_mid", "_slot"], "left")
    followed = (F.col("_last") > F.col("_order")) | (F.col("_first") < F.col("ts") + timeout)
    return entries.where(~F.coalesce(followed, F.lit(False))).select(*pages.columns)
