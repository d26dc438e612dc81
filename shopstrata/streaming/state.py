"""The operators that need state of their own on a stream: new visitors, a visitor's first day, and jumps.

The first two need the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.times import day_of, event_time
from ..operators.logs import entry_pages, is_entry

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of the state store. The numbers of its rows, which no job reads, would cost a look-up for every row that is written.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
_NEW, _KNOWN = "1", "0"
_ROW = T.StructType([T.StructField("is_new", T.StringType()), T.StructField("record", T.StringType())])
_RECORD = T.StructType([T.StructField("record", T.StringType())])


def _as_record(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns)).alias("record")


def _from_record(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(F.from_json("record", like.schema).alias("r")).select(*[F.col(f"r.{c}") for c in like.columns])


class _FirstVisit(StatefulProcessor):
    """Remembers per device that a new-visitor mark was seen; there is no expiry."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._seen = handle.getValueState("seen", T.StructType([T.StructField("ts", T.LongType())]))

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803
        self._seen.update((int(initialState["ts"].min()),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        seen = self._seen.exists()
        for chunk in rows:
            chunk = chunk.sort_values("ts", kind="stable")
            mark = pd.Series(_KNOWN, index=chunk.index)
            if not seen:
                mark.iloc[0] = _NEW
                self._seen.update((int(chunk["ts"].iloc[0]),))
                seen = True
            yield pd.DataFrame({"is_new": mark, "record": chunk["record"]})

    def close(self) -> None:
        pass


def known_visitors(log: DataFrame) -> DataFrame:
    """The devices (mid, ts) of a batch of the log that had a new-visitor mark, with its first time."""
    marked = log.where((F.col("common.is_new") == _NEW) & F.col("common.mid").isNotNull())
    return marked.groupBy(F.col("common.mid").alias("mid")).agg(F.min("ts").alias("ts"))


def repair_is_new_stream(log: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Keep a device's first `is_new = '1'` to arrive (by time within a batch of rows) and turn later ones into '0'.

    Only marked records need state; all others pass beside it. `known` (mid, ts; see `known_visitors`) are devices that were
    new before this stream: a new checkpoint starts with them, an old one has its own state and doesn't read them.
    """
    marked = F.coalesce(F.col("common.is_new") == _NEW, F.lit(False)) & F.col("common.mid").isNotNull()
    rows = log.where(marked).select(F.col("common.mid").alias("mid"), "ts", _as_record(log.columns))
    start = None
    if known is not None:
        start = known.where("mid is not null").select("mid", F.coalesce(F.col("ts").cast("long"), F.lit(0)).alias("ts")).groupBy("mid")
    fixed = rows.groupBy("mid").transformWithStateInPandas(
        statefulProcessor=_FirstVisit(), outputStructType=_ROW, outputMode="Append", timeMode="None", initialState=start
    )
    record = F.from_json("record", log.schema).alias("r")
    common = F.col("r.common").withField("is_new", F.col("is_new")).alias("common")
    fixed = fixed.select("is_new", record).select(*[common if c == "common" else F.col(f"r.{c}") for c in log.columns])
    return log.where(~marked).unionByName(fixed)


class _FirstDay(StatefulProcessor):
    """Remembers per device the first day it was seen on, and by a timer forgets it `keep` after its last entry that counted."""

    def __init__(self, keep_ms: int | None):
        self._keep = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._day = handle.getValueState("day", T.StructType([T.StructField("day", T.IntegerType()), T.StructField("until", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        chunks = list(rows)
        known = self._day.get()
        day = min(int(c["day"].min()) for c in chunks) if known is None else known[0]
        mine = [c.loc[c["day"] == day, ["ts", "record"]] for c in chunks]
        times = [int(c["ts"].max()) for c in mine if len(c)]
        if times:
            until = max(times) + (self._keep or 0)
            if known is not None and known[1] >= until:
                until = known[1]
            elif self._keep is not None:
                if known is not None:
                    self._handle.deleteTimer(known[1])
                self._handle.registerTimer(until)
            self._day.update((day, until))
        yield from (c[["record"]] for c in mine)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self._day.clear()
        yield pd.DataFrame({"record": pd.Series([], dtype=str)})

    def close(self) -> None:
        pass


def first_day_visits(pages: DataFrame, zone: str | None = None, keep_ms: int | None = None, delay: str = "0 seconds") -> DataFrame:
    """Entry pages of the first day that a device was seen on, of those to arrive; nothing of it later.

    keep_ms: forget a device once the watermark is so long past its last entry that counted; its next day is then a first one
    again. Without it, devices are remembered for good. Of a micro-batch the earliest day counts, whatever the order of its
    rows.
    """
    visits = entry_pages(pages).where("common.mid is not null and ts is not null")
    day = F.unix_date(day_of(event_time("ts"), zone)).alias("day")
    rows = visits.select(F.col("common.mid").alias("mid"), day, "ts", _as_record(pages.columns), event_time("ts").alias("at"))
    if keep_ms is not None:
        rows = rows.withWatermark("at", delay)
    kept = rows.groupBy("mid").transformWithStateInPandas(
        statefulProcessor=_FirstDay(keep_ms), outputStructType=_RECORD, outputMode="Append", timeMode="None" if keep_ms is None else "EventTime"
    )
    return _from_record(kept, pages)


#: Ids of pages that have none: such a follow-up counts as later than an entry of the same time.
_LATEST = (1 << 63) - 1


def jumps_by_slots(pages: DataFrame, timeout_seconds: int, delay: str, id_col: str = "log_id") -> DataFrame:
    """Entry pages that no page of their device followed within the timeout, as `visits.user_jumps` defines them.

    A window is two slots of one timeout: the entries of the first, and of the follow-ups only two numbers. An entry is
    followed by a later page of its own slot, or by one of the next slot that is less than the timeout behind it. An entry
    comes out when the watermark has passed the end of its window, so at most two timeouts behind it; then the window is
    forgotten.
    """
    identity = F.coalesce(F.col(id_col).cast("long"), F.lit(_LATEST)) if id_col in pages.columns else F.lit(_LATEST)
    known = pages.where("common.mid is not null and ts is not null")
    rows = known.select(
        F.col("common.mid").alias("mid"), "ts", identity.alias("id"), is_entry().alias("entry"),
        F.when(is_entry(), F.struct(*pages.columns)).alias("record"), event_time("ts").alias("at"),
    )
    window = F.window("at", f"{2 * timeout_seconds} seconds", f"{timeout_seconds} seconds").alias("w")
    timed = rows.withWatermark("at", delay).select("*", window)
    own = F.col("ts") < F.unix_millis("w.start") + timeout_seconds * 1000
    slots = timed.where(~F.col("entry") | own).groupBy("w", "mid").agg(
        F.collect_list(F.when(F.col("entry"), F.struct("ts", "id", "record"))).alias("entries"),
        F.max(F.when(~F.col("entry") & own, F.struct("ts", "id"))).alias("last"),
        F.min(F.when(~F.col("entry") & ~own, F.col("ts"))).alias("after"),
    )

    def followed(e: Column) -> Column:
        order = F.struct(e["ts"].alias("ts"), F.when(e["id"] == _LATEST, -1).otherwise(e["id"]).alias("id"))
        return F.coalesce(F.col("last") > order, F.lit(False)) | F.coalesce(F.col("after") < e["ts"] + timeout_seconds * 1000, F.lit(False))

    jumps = slots.select(F.explode(F.filter("entries", lambda e: ~followed(e))).alias("e"))
    return jumps.select(*[F.col(f"e.record.{c}").alias(c) for c in pages.columns])
