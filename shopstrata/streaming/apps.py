"""The warehouse's jobs wired to topics, dimension tables and serving tables.

    spark-submit -m shopstrata.streaming.apps log_split --servers host:9092 --root hdfs:///shop
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..plans.layers import Dimensions
from ..schemas import KEYWORD_STATS, PRODUCT_STATS, PROVINCE_STATS, VISITOR_STATS
from ..operators.stats import LATENESS
from ..sources.dimstore import DimStore
from ..sources.jdbc import read_query
from ..sources.topics import PER_TRIGGER, FolderTopics, KafkaTopics
from . import jobs
from .routing import RoutingConfig
from .sinks import BatchWriter, both, day_rollup, serving_folder, start_batches, topic_rows
from .state import STATE_STORE


#: Which of several topics' watermarks holds: `min`, the slowest one's, or `max`. A query keeps what its checkpoint began with.
WATERMARK_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


@dataclass
class Warehouse:
    """What the jobs read and write. `root` is a folder every executor can reach."""

    spark: SparkSession
    topics: KafkaTopics | FolderTopics
    root: str
    routing: Callable[[], DataFrame] | None = None
    serving: Callable[[str, list[str]], BatchWriter] | None = None
    trigger: dict = field(default_factory=lambda: {"processingTime": "10 seconds"})
    bounds: dict[str, str] = field(default_factory=dict)
    jump_timeout: int = 10
    # How far rows of one topic may be out of order, for all jobs and, by name, for some.
    lateness: str = LATENESS
    latenesses: dict[str, str] = field(default_factory=dict)
    # Devices (mid, ts) that a new checkpoint of the log split knows already; see `state.known_visitors`.
    known_visitors: Callable[[], DataFrame] | None = None
    # A unique visit is a device's first of a day (`first`), or any of the first day it was seen on (`first_day`).
    visit_mode: str = "first"
    visit_keep_ms: int | None = None

    def __post_init__(self):
        self.serving = self.serving or serving_folder(f"{self.root}/serving")

    @property
    def dim_root(self) -> str:
        return f"{self.root}/dims"

    @property
    def rollup(self) -> str:
        """The day sums of the product statistics, for the reports."""
        return f"{self.root}/rollups/product_days"

    def read(self, topic: str, job: str) -> DataFrame:
        return self.topics.read(self.spark, topic, job)

    def delay(self, job: str) -> str:
        return self.latenesses.get(job, self.lateness)

    def dimensions(self, facts: DataFrame | None = None) -> Dimensions:
        """The dimension tables; of those that facts ask for by a key of theirs, only the buckets of their keys are read."""
        store = DimStore(self.spark, self.dim_root)
        keys = {C.DIMENSIONS[part][0]: c for part, c in C.FACT_KEYS.items() if facts is not None and c in facts.columns}
        rows = store.rows_for(facts, keys) if keys else store.rows()
        tables = {part: store.read(name, columns.split(), rows=rows) for part, (name, columns) in C.DIMENSIONS.items()}
        return Dimensions(**tables)

    def to_topic(self, topic: str, job: str, *identity: str) -> BatchWriter:
        return topic_rows(topic, self.topics.writer(job), list(identity))

    def start(self, rows: DataFrame, job: str, write: BatchWriter) -> StreamingQuery:
        return start_batches(rows, write, f"{self.root}/checkpoints/{job}", trigger=self.trigger)


def log_split(w: Warehouse) -> StreamingQuery:
    known = w.known_visitors() if w.known_visitors else None
    return w.start(jobs.log_records(w.read(C.ODS_LOG, "log_split"), known=known), "log_split", w.topics.writer("log_split"))


def change_route(w: Warehouse) -> StreamingQuery:
    if w.routing is None:
        raise ValueError("change_route needs a routing configuration")
    write = jobs.routed_changes(RoutingConfig(w.routing), w.topics.writer("change_route"), w.dim_root)
    return w.start(jobs.change_rows(w.read(C.ODS_DB, "change_route")), "change_route", write)


def unique_visit(w: Warehouse) -> StreamingQuery:
    lines = w.read(C.DWD_PAGE, "unique_visit")
    rows = jobs.unique_visits(lines, delay=w.delay("unique_visit"), mode=w.visit_mode, keep_ms=w.visit_keep_ms)
    return w.start(rows, "unique_visit", w.to_topic(C.DWM_UNIQUE_VISIT, "unique_visit", "log_id"))


def user_jump(w: Warehouse) -> StreamingQuery:
    rows = jobs.user_jumps(w.read(C.DWD_PAGE, "user_jump"), w.jump_timeout, w.delay("user_jump"))
    return w.start(rows, "user_jump", w.to_topic(C.DWM_USER_JUMP, "user_jump", "log_id"))


def dirty_page(w: Warehouse) -> StreamingQuery:
    return w.start(jobs.dirty_pages(w.read(C.DWD_PAGE, "dirty_page")), "dirty_page", w.topics.writer("dirty_page"))


def order_wide(w: Warehouse) -> StreamingQuery:
    orders, details = (w.read(t, "order_wide") for t in (C.DWD_ORDER_INFO, C.DWD_ORDER_DETAIL))
    write = jobs.named_orders(w.dimensions, w.to_topic(C.DWM_ORDER_WIDE, "order_wide", "detail_id"), by_batch=True)
    return w.start(jobs.order_wide(orders, details, w.delay("order_wide"), **w.bounds), "order_wide", write)


def payment_wide(w: Warehouse) -> StreamingQuery:
    payments, wide = (w.read(t, "payment_wide") for t in (C.DWD_PAYMENT_INFO, C.DWM_ORDER_WIDE))
    rows = jobs.payment_wide(payments, wide, w.delay("payment_wide"))
    return w.start(rows, "payment_wide", w.to_topic(C.DWM_PAYMENT_WIDE, "payment_wide", "payment_id", "detail_id"))


def visitor_stats(w: Warehouse) -> StreamingQuery:
    inputs = [w.read(t, "visitor_stats") for t in (C.DWD_PAGE, C.DWM_UNIQUE_VISIT, C.DWM_USER_JUMP)]
    rows = jobs.visitor_stats(*inputs, jump_timeout=w.jump_timeout, delay=w.delay("visitor_stats"))
    return w.start(rows, "visitor_stats", w.serving(C.VISITOR_TABLE, VISITOR_STATS))


def product_stats(w: Warehouse) -> StreamingQuery:
    topics = (
        C.DWD_PAGE,
        C.DWD_FAVOR_INFO,
        C.DWD_CART_INFO,
        C.DWM_ORDER_WIDE,
        C.DWM_PAYMENT_WIDE,
        C.DWD_REFUND_INFO,
        C.DWD_COMMENT_INFO,
    )
    rows = jobs.product_stats(*[w.read(t, "product_stats") for t in topics], delay=w.delay("product_stats"))
    return w.start(rows, "product_stats", jobs.named_products(w.dimensions, both(w.serving(C.PRODUCT_TABLE, PRODUCT_STATS), day_rollup(w.rollup)), by_batch=True))


def province_stats(w: Warehouse) -> StreamingQuery:
    rows = jobs.province_stats(w.read(C.DWM_ORDER_WIDE, "province_stats"), delay=w.delay("province_stats"))
    return w.start(rows, "province_stats", w.serving(C.PROVINCE_TABLE, PROVINCE_STATS))


def keyword_stats(w: Warehouse) -> StreamingQuery:
    rows = jobs.keyword_stats(w.read(C.DWD_PAGE, "keyword_stats"), delay=w.delay("keyword_stats"))
    return w.start(rows, "keyword_stats", w.serving(C.KEYWORD_TABLE, KEYWORD_STATS))


# In the order in which each finds its input written by those before it.
APPS: dict[str, Callable[[Warehouse], StreamingQuery]] = {
    app.__name__: app
    for app in (
        log_split,
        change_route,
        dirty_page,
        unique_visit,
        user_jump,
        order_wide,
        payment_wide,
        visitor_stats,
        product_stats,
        province_stats,
        keyword_stats,
    )
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("app", choices=sorted(APPS))
    parser.add_argument("--root", required=True, help="shared folder for checkpoints, dimensions and serving tables")
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--servers", help="Kafka bootstrap servers")
    where.add_argument("--topic-folder", help="shared folder holding topics as text files")
    parser.add_argument("--routing-url", help="JDBC address of the routing configuration")
    parser.add_argument("--routing-query", default="select * from table_process")
    parser.add_argument("--lateness", default=LATENESS, help="how far rows of a topic may be out of order")
    parser.add_argument("--per-trigger", type=int, default=PER_TRIGGER, help="rows of a Kafka topic, or files of a folder, in a batch")
    parser.add_argument(
        "--idle-topics", action="store_true", help="close windows by the topic that is furthest, so that a silent one holds none open; rows of a slower topic are late then"
    )
    parser.add_argument("--known-visitors", help="parquet (mid, ts) of devices that were new before log_split's checkpoint began")
    parser.add_argument("--visit-mode", default="first", choices=["first", "first_day"], help="which entries of a device are unique visits")
    parser.add_argument("--visit-keep-hours", type=float, help="first_day: forget a device so long after its last entry that counted")
    parser.add_argument("--once", action="store_true", help="process what is there and stop")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName(args.app).config(map=STATE_STORE)
    builder = builder.config(WATERMARK_POLICY, "max" if args.idle_topics else "min")
    spark = builder.getOrCreate()
    topics = KafkaTopics(args.servers, per_trigger=args.per_trigger) if args.servers else FolderTopics(args.topic_folder, args.per_trigger)
    routing = (lambda: read_query(spark, args.routing_url, args.routing_query)) if args.routing_url else None
    trigger = {"availableNow": True} if args.once else {"processingTime": "10 seconds"}
    known = (lambda: spark.read.parquet(args.known_visitors)) if args.known_visitors else None
    keep_ms = None if args.visit_keep_hours is None else round(args.visit_keep_hours * 3_600_000)
    warehouse = Warehouse(
        spark, topics, args.root, routing, trigger=trigger, lateness=args.lateness, known_visitors=known, visit_mode=args.visit_mode, visit_keep_ms=keep_ms
    )
    APPS[args.app](warehouse).awaitTermination()


if __name__ == "__main__":
    main()
