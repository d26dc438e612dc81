"""Each streaming job against the batch form of the same rows, with restarts and late rows."""

import datetime as dt
import json
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopstrata.checks import queries as Q
from shopstrata.operators import logs, reports, stats, visits, wide
from shopstrata.plans import layers
from shopstrata.schemas import ROUTING
from shopstrata.sources import sample
from shopstrata.sources.dimstore import DimStore
from shopstrata.sources.topics import FolderTopics
from shopstrata.streaming import apps, jobs, sinks
from shopstrata.streaming.routing import RoutingConfig
from shopstrata.streaming.state import known_visitors

from .streams import as_dicts, lines, new_dir, run, write_file, write_files

FAR = 4_102_444_800_000  # 2100-01-01, closes all windows
FAR_TEXT = "2100-01-01 00:00:00"
JUMP = 6 * 3600


def page(mid, ts, last=None, **fields):
    body = {"page_id": fields.pop("page_id", "home"), "during_time": 100, "last_page_id": last} | fields
    common = {"mid": mid, "vc": "v1", "ch": "c1", "ar": "a1", "is_new": "0"}
    return {"common": common, "page": {k: v for k, v in body.items() if v is not None}, "ts": ts}


# Filters reach below the watermark, so the closing rows have to pass the filters of every job.
SEARCH = {"item_type": "keyword", "item": "closing"}
CLOSING = [
    page("closing", FAR, **SEARCH),
    page("closing", FAR, last="home", **SEARCH),
    page("closing", FAR, page_id="good_detail", item="-1"),
]


@pytest.fixture(scope="module")
def pages(spark, sample_dir):
    rows = logs.page_rows(sample.app_log(spark, sample_dir)).orderBy("ts", "log_id")
    return as_dicts(rows)


@pytest.fixture(scope="module")
def page_folder(pages):
    folder = write_files(new_dir() / "pages", pages, 3)
    write_file(folder, CLOSING)
    write_file(folder, CLOSING)
    return folder


def open_rows(df, time="ts"):
    return df.where(F.col(time) < FAR)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_jumps_equal_batch(spark, sample_dir, page_folder):
    work = new_dir()
    found = run(jobs.user_jumps(lines(spark, page_folder), JUMP), work / "out", work / "cp")
    batch = visits.user_jumps(logs.page_rows(sample.app_log(spark, sample_dir)), JUMP)
    assert rows_of(open_rows(found).select("log_id")) == rows_of(batch.select("log_id"))


def test_jumps_with_many_follow_ups_and_late_arrivals(spark):
    """1,000 follow-ups of an entry are two numbers of state; order of arrival inside the lateness doesn't matter."""
    base, folder, work = 1_704_067_200_000, new_dir() / "pages", new_dir()
    busy = [page("busy", base)] + [page("busy", base + 1 + k, last="home") for k in range(1000)] + [page("busy", base + 20_000)]
    write_file(folder, busy)
    # The follow-ups arrive before the entry; the one of c is a millisecond too late, d's entry is followed in its own millisecond.
    write_file(folder, [page("b", base + 9_000, last="home"), page("c", base + 10_000, last="home"), page("e", base + 5_000)])
    write_file(folder, [page("b", base), page("c", base), page("d", base), page("d", base, last="home")])
    write_file(folder, [page("e", base + 14_999, last="home"), page("f", base), page("f", base + 3_000), page("f", base + 4_000, last="home")])
    write_file(folder, CLOSING)
    write_file(folder, CLOSING)
    found = run(jobs.user_jumps(lines(spark, folder)), work / "out", work / "cp")
    assert rows_of(open_rows(found).select("common.mid", "ts")) == Counter({("busy", base + 20_000): 1, ("c", base): 1})


def test_jumps_survive_a_restart(spark):
    base, folder, work = 1_704_067_200_000, new_dir() / "pages", new_dir()
    steps = [[page("a", base), page("b", base)], [page("a", base + 8_000, last="home")], [page("z", base + 60_000)], [page("z", base + 61_000)], CLOSING, CLOSING]
    for step in steps:
        write_file(folder, step)
        found = run(jobs.user_jumps(lines(spark, folder)), work / "out", work / "cp")
    assert sorted(r["mid"] for r in open_rows(found).select("common.mid").collect()) == ["b", "z", "z"]


def test_first_day_visits(spark):
    day, folder, work = 86_400_000, new_dir() / "pages", new_dir()
    base = 19_800 * day
    write_file(folder, [page("a", base + day), page("a", base + 5), page("b", base + day)])
    write_file(folder, [page("a", base + 9), page("a", base + day + 1), page("a", base + 10, last="home"), page("b", base + 2 * day)])
    job = lambda keep=None: jobs.unique_visits(lines(spark, folder), mode="first_day", keep_ms=keep)
    found = run(job(), work / "out", work / "cp")
    want = {("a", base + 5): 1, ("a", base + 9): 1, ("b", base + day): 1}
    assert rows_of(found.select("common.mid", "ts")) == Counter(want)
    # Three days after its last entry that counted a device is forgotten: then its next day is a first one.
    found = {}
    for later in (None, base + 3 * day, base + 4 * day, base + 9 * day, base + 20 * day, base + 21 * day):
        if later:
            write_file(folder, [page("a", later), page("other", later + 30_000)])
        found = run(job(3 * day), work / "kept", work / "cp-kept")
    seen = [ts - base for mid, ts in rows_of(found.select("common.mid", "ts")) if mid == "a"]
    assert sorted(seen) == [5, 9, 9 * day, 21 * day]


def test_new_checkpoint_knows_old_devices(spark, sample_dir):
    log = sample.app_log(spark, sample_dir)
    half = log.agg(F.percentile_approx("ts", 0.5)).first()[0]
    folder, work = write_files(new_dir() / "log", as_dicts(log.where(F.col("ts") >= half).orderBy("ts", "log_id")), 2), new_dir()
    known = known_visitors(log.where(F.col("ts") < half))
    parsed = jobs.jsonio.parse(lines(spark, folder), log.schema)
    found = run(jobs.repair_is_new_stream(parsed, known), work / "out", work / "cp")
    expected = logs.repair_is_new(log).where(F.col("ts") >= half)
    assert rows_of(found.select("log_id", "common.is_new")) == rows_of(expected.select("log_id", "common.is_new"))
    old = {r["mid"] for r in known.collect()}
    assert old and not [r for r in found.where("common.is_new = '1'").select("common.mid").collect() if r["mid"] in old]


def test_unique_visits_equal_batch_by_visitor_and_day(spark, sample_dir, page_folder):
    work = new_dir()
    found = run(jobs.unique_visits(lines(spark, page_folder)), work / "out", work / "cp")
    batch = visits.unique_visits(logs.page_rows(sample.app_log(spark, sample_dir)))
    key = ["common.mid", F.floor(F.col("ts") / 86_400_000)]
    assert rows_of(open_rows(found).select(*key)) == rows_of(batch.select(*key))


def test_new_visitor_equals_batch(spark, sample_dir):
    log = sample.app_log(spark, sample_dir)
    folder = write_files(new_dir() / "log", as_dicts(log.orderBy("ts", "log_id")), 3)
    work = new_dir()
    schema_lines = lines(spark, folder)
    parsed = jobs.jsonio.parse(schema_lines, log.schema)
    found = run(jobs.repair_is_new_stream(parsed), work / "out", work / "cp")
    expected = logs.repair_is_new(log)
    key = ["log_id", "common.mid", "common.is_new", "page.item", "ts"]
    assert rows_of(found.select(*key)) == rows_of(expected.select(*key))


def test_log_records_split(spark):
    start = {"common": {"mid": "a", "is_new": "1"}, "start": {"entry": "icon"}, "ts": 1}
    shown = {"common": {"mid": "a", "is_new": "1"}, "page": {"page_id": "p"}, "displays": [{"item": "7"}], "ts": 2}
    folder = write_files(new_dir() / "log", [start, shown], 1)
    work = new_dir()
    found = run(jobs.log_records(lines(spark, folder)), work / "out", work / "cp")
    assert Counter(r["topic"] for r in found.collect()) == {"dwd_start_log": 1, "dwd_page_log": 1, "dwd_display_log": 1}
    is_new = dict(found.select("topic", F.get_json_object("value", "$.common.is_new")).collect())
    assert is_new == {"dwd_start_log": "1", "dwd_page_log": "0", "dwd_display_log": "0"}


def test_visitor_stats_equal_batch(spark, sample_dir, page_folder):
    batch_pages = logs.page_rows(sample.app_log(spark, sample_dir))
    parts = {"visits": visits.unique_visits(batch_pages), "jumps": visits.user_jumps(batch_pages, JUMP)}
    folders = {}
    for name, rows in parts.items():
        folders[name] = write_files(new_dir() / name, as_dicts(rows.orderBy("ts")), 3)
        write_file(folders[name], CLOSING)
        write_file(folders[name], CLOSING)
    work = new_dir()
    job = jobs.visitor_stats(
        lines(spark, page_folder), lines(spark, folders["visits"]), lines(spark, folders["jumps"]), JUMP
    )
    found = run(job, work / "out", work / "cp")
    expected = layers.visitor_stats(batch_pages, jump_timeout=JUMP)
    assert rows_of(found.where("stt < '2100'")) == rows_of(expected)


def test_keyword_stats_equal_batch(spark, sample_dir, page_folder):
    work = new_dir()
    found = run(jobs.keyword_stats(lines(spark, page_folder)), work / "out", work / "cp")
    expected = stats.keyword_stats(stats.searches(logs.page_rows(sample.app_log(spark, sample_dir))))
    assert rows_of(found.where("stt < '2100'")) == rows_of(expected)


def in_three(rows, time, closing):
    folder = write_files(new_dir() / "in", as_dicts(rows.orderBy(time)), 3)
    write_file(folder, [closing])
    write_file(folder, [closing])
    return folder


def test_order_wide_province_and_payment_equal_batch(spark, sample_dir):
    orders, details = sample.order_info(spark, sample_dir), sample.order_detail(spark, sample_dir)
    dimensions = Q.dimensions(spark, sample_dir)
    order_folder = in_three(orders, "create_time", {"id": -1, "create_time": FAR_TEXT})
    detail_folder = in_three(details, "create_time", {"id": -1, "order_id": -2, "create_time": FAR_TEXT})
    work = new_dir()
    job = jobs.order_wide(lines(spark, order_folder), lines(spark, detail_folder), **Q.ORDER_BOUNDS)
    write = jobs.named_orders(lambda: dimensions, sinks.batch_folders(str(work / "wide")))
    sinks.start_batches(job, write, str(work / "cp")).awaitTermination()
    found = spark.read.parquet(str(work / "wide")).drop("batch")
    expected = layers.order_wide(orders, details, dimensions, **Q.ORDER_BOUNDS).drop("create_at")
    assert found.columns == expected.columns
    assert expected.count() > 0
    assert rows_of(found) == rows_of(expected)

    closing = {"order_id": -1, "create_time": FAR_TEXT}
    wide_folder = in_three(expected, "create_time", closing)
    provinces = run(jobs.province_stats(lines(spark, wide_folder)), work / "prov", work / "cp2")
    assert rows_of(provinces.where("stt < '2100'")) == rows_of(stats.province_stats(expected))

    payments = sample.payment_info(spark, sample_dir)
    pay_folder = in_three(payments, "create_time", {"id": -1, "order_id": -3, "create_time": FAR_TEXT})
    paid = run(jobs.payment_wide(lines(spark, pay_folder), lines(spark, wide_folder)), work / "paid", work / "cp3")
    timed = wide.derive_create_at(expected)
    expected_paid = layers.payment_wide(payments, timed).drop("payment_create_at")
    assert expected_paid.count() > 0
    assert rows_of(paid) == rows_of(expected_paid)


def test_product_stats_equal_batch(spark, sample_dir, page_folder):
    pages = logs.page_rows(sample.app_log(spark, sample_dir))
    tables = [
        sample.favor_info(spark, sample_dir),
        sample.cart_info(spark, sample_dir),
        Q.order_wide_of(spark, sample_dir).drop("create_at"),
        layers.payment_wide(sample.payment_info(spark, sample_dir), Q.order_wide_of(spark, sample_dir)).drop("payment_create_at"),
        sample.refund_info(spark, sample_dir),
        sample.comment_info(spark, sample_dir),
    ]
    folders = []
    for table in tables:
        time = "payment_create_time" if "payment_create_time" in table.columns else "create_time"
        folders.append(in_three(table, time, {"sku_id": -1, time: FAR_TEXT}))
    work = new_dir()
    job = jobs.product_stats(*[lines(spark, f) for f in (page_folder, *folders)])
    write = jobs.named_products(lambda: Q.dimensions(spark, sample_dir), sinks.batch_folders(str(work / "out")))
    sinks.start_batches(job, write, str(work / "cp")).awaitTermination()
    found = spark.read.parquet(str(work / "out")).drop("batch").where("stt < '2100'")
    expected = layers.product_stats(layers.product_rows(pages, *tables), Q.dimensions(spark, sample_dir))
    assert rows_of(found) == rows_of(expected.select(*found.columns))


def test_restart_from_checkpoint(spark):
    folder, work = new_dir() / "pages", new_dir()
    base = 1_704_067_200_000
    write_file(folder, [page("a", base), page("b", base + 1000)])
    run(jobs.unique_visits(lines(spark, folder)), work / "out", work / "cp")
    write_file(folder, [page("a", base + 2000), page("c", base + 3000)])
    found = run(jobs.unique_visits(lines(spark, folder)), work / "out", work / "cp")
    assert Counter(r[0] for r in found.select("common.mid").collect()) == {"a": 1, "b": 1, "c": 1}


def test_late_rows_are_dropped(spark):
    folder, work = new_dir() / "pages", new_dir()
    base = 1_704_067_200_000
    search = {"item_type": "keyword"}
    write_file(folder, [page("a", base, item="red ring", **search)])
    write_file(folder, [page("a", base + 120_000, item="blue ring", **search)])
    # Lateness is judged by the watermark of the batch before, so one more batch passes in between.
    write_file(folder, [page("a", base + 130_000, item="blue", **search)])
    write_file(folder, [page("a", base, item="late ring", **search)])
    write_file(folder, CLOSING)
    write_file(folder, CLOSING)
    found = run(jobs.keyword_stats(lines(spark, folder)), work / "out", work / "cp")
    words = {r["keyword"]: r["ct"] for r in found.where("stt < '2100'").groupBy("keyword").agg(F.sum("ct").alias("ct")).collect()}
    assert words == {"red": 1, "ring": 2, "blue": 2}


def test_changes_follow_the_configuration(spark):
    folder, work = new_dir() / "cdc", new_dir()
    first = [
        {"table": "user_info", "type": "insert", "xid": 1, "data": {"id": 1, "name": "Ann", "tel": "5"}},
        {"table": "order_info", "type": "insert", "xid": 2, "data": {"id": 9, "status": "1001"}},
        {"table": "unknown", "type": "insert", "xid": 3, "data": {"id": 9}},
        {"table": "user_info", "type": "insert", "xid": 4, "data": {}},
        {"database": "shop", "xid": 7, "data": {"id": 4}},
    ]
    second = [{"table": "user_info", "type": "bootstrap-insert", "xid": 5, "data": {"id": 1, "name": "Anna"}}]
    write_file(folder, first)
    write_file(folder, second)
    rows = [
        ("user_info", "insert", "hbase", "dim_user", "id,name", None, None),
        ("order_info", "insert", "kafka", "dwd_order_info", "id", "id", None),
    ]
    config = RoutingConfig(lambda: spark.createDataFrame(rows, ROUTING))
    write = jobs.routed_changes(config, sinks.batch_folders(str(work / "records")), str(work / "dims"), fold_every=1)
    sinks.start_batches(jobs.change_rows(lines(spark, folder)), write, str(work / "cp")).awaitTermination()
    records = spark.read.parquet(str(work / "records")).select("topic", "value").collect()
    assert [tuple(r) for r in records] == [("dwd_order_info", '{"id":"9"}')]
    users = DimStore(spark, str(work / "dims")).read("dim_user", ["id", "name"])
    assert [tuple(r) for r in users.collect()] == [("1", "Anna")]


def test_records_to_a_folder_per_topic_once(spark):
    folder, work = new_dir() / "log", new_dir()
    for n in range(2):
        write_file(folder, [page(f"m{n}", n)])
        records = lines(spark, folder).select(F.lit(f"topic{n}").alias("topic"), "value")
        writer = sinks.folder_writer(records, str(work / "out"), str(work / "cp"), ["topic"])
        writer.trigger(availableNow=True).start().awaitTermination()
    found = spark.read.parquet(str(work / "out")).groupBy("topic").count()
    assert dict(found.collect()) == {"topic0": 1, "topic1": 1}


def test_console_writer_starts(spark):
    folder, work = new_dir() / "log", new_dir()
    write_file(folder, [page("m", 1)])
    writer = sinks.console_writer(lines(spark, folder)).option("checkpointLocation", str(work / "cp"))
    writer.trigger(availableNow=True).start().awaitTermination()


def rounds(spark, job, folders, files, work):
    """Run a job after each round of files (`files[topic][round]`, None: nothing arrives) and return what it wrote."""
    for n in range(len(next(iter(files.values())))):
        for topic, parts in files.items():
            if parts[n]:
                write_file(folders[topic], parts[n])
        out = run(job(), work / "out", work / "cp")
    return out


def test_topics_that_lag_lose_nothing(spark):
    """Jumps 40 seconds and wide orders 40 seconds behind the pages, payments 15 minutes: by default all count."""
    base, work = 1_704_067_200_000, new_dir()
    at = lambda ms: [page("m", ms), page("m", ms, last="home", page_id="good_detail", item="7")]
    folders = {t: work / t for t in ("pages", "visits", "jumps")}
    files = {
        "pages": [at(base), at(base + 40_000), at(base + 80_000), at(base + 120_000), CLOSING, CLOSING],
        "visits": [[page("m", base)], [page("m", base + 30_000)], None, None, CLOSING, CLOSING],
        "jumps": [[page("m", base - 40_000)], [page("m", base)], [page("m", base + 40_000)], None, CLOSING, CLOSING],
    }
    for f in folders.values():
        f.mkdir(parents=True)
    inputs = lambda: [lines(spark, f) for f in folders.values()]
    found = rounds(spark, lambda: jobs.visitor_stats(*inputs()), folders, files, work / "v").where("stt < '2100'")
    assert tuple(found.agg(F.sum("pv_ct"), F.sum("uv_ct"), F.sum("uj_ct")).first()) == (8, 2, 3)

    text = lambda ms: spark.range(1).select(F.date_format(F.timestamp_millis(F.lit(ms)), "yyyy-MM-dd HH:mm:ss")).first()[0]
    closing = {t: [{"sku_id": -1, "create_time": FAR_TEXT, "payment_create_time": FAR_TEXT}] for t in ("favor", "cart", "wide", "paid", "refund", "comment")}
    wide_row = lambda k, ms: {"detail_id": k, "order_id": k, "sku_id": 7, "sku_num": 1, "split_total_amount": "19.00", "create_time": text(ms)}
    paid_row = lambda k, ms: wide_row(k, ms) | {"payment_id": k, "payment_create_time": text(ms)}
    files = {
        "pages": [at(base), at(base + 600_000), at(base + 960_000), CLOSING, CLOSING],
        "favor": [None, None, None], "cart": [None, None, None], "refund": [None, None, None], "comment": [None, None, None],
        "wide": [None, [wide_row(1, base - 40_000)], [wide_row(2, base + 560_000)]],
        "paid": [None, [paid_row(1, base - 300_000)], [paid_row(2, base + 60_000)]],
    }
    files = {t: parts if t == "pages" else [*parts, closing[t], closing[t]] for t, parts in files.items()}
    order = ["pages", "favor", "cart", "wide", "paid", "refund", "comment"]
    folders = {t: work / "p" / t for t in order}
    for f in folders.values():
        f.mkdir(parents=True)
    job = lambda: jobs.product_stats(*[lines(spark, folders[t]) for t in order])
    found = rounds(spark, job, folders, files, work / "w").where("stt < '2100' and sku_id = 7")
    sums = found.agg(F.sum("click_ct"), F.sum("order_ct"), F.sum("order_amount"), F.sum("paid_order_ct"), F.sum("payment_amount")).first()
    assert [float(x) for x in sums] == [3, 2, 38.0, 2, 38.0]


def test_a_batch_written_twice_counts_once(spark, sample_dir):
    """Topics whose writers repeated a micro-batch under a new name, as after a lost acknowledgement."""
    pages = logs.page_rows(sample.app_log(spark, sample_dir)).where("ts is not null")
    wide_rows = Q.order_wide_of(spark, sample_dir).drop("create_at")
    paid = layers.payment_wide(sample.payment_info(spark, sample_dir), Q.order_wide_of(spark, sample_dir)).drop("payment_create_at")
    inputs = {"pages": (pages, ["log_id"]), "wide": (wide_rows, ["detail_id"]), "paid": (paid, ["payment_id", "detail_id"])}
    empty = {t: f(spark, sample_dir) for t, f in (("favor", sample.favor_info), ("cart", sample.cart_info), ("refund", sample.refund_info), ("comment", sample.comment_info))}
    work = new_dir()
    found = {}
    for times in (1, 2):
        topics_ = FolderTopics(str(work / f"topics{times}"), 1)
        for topic, (rows, identity) in inputs.items():
            write = sinks.topic_rows(topic, topics_.writer(f"job-{topic}"), identity)
            for n in range(times):
                write(rows.coalesce(1), sinks.Batch.of(0, f"query{n}"))
        ends = {"wide": {"sku_id": -1, "create_time": FAR_TEXT}, "paid": {"sku_id": -1, "payment_create_time": FAR_TEXT}}
        ends |= {t: {"sku_id": -1, "create_time": FAR_TEXT} for t in empty}
        closing = [(t, json.dumps(r)) for t, r in ends.items()] + [("pages", json.dumps(r)) for r in CLOSING]
        for n in (2, 3):
            topics_.writer("end")(spark.createDataFrame(closing, "topic string, value string").coalesce(1), n)
        read = lambda t: topics_.read(spark, t, "job")  # noqa: E731, B023
        product = jobs.product_stats(read("pages"), read("favor"), read("cart"), read("wide"), read("paid"), read("refund"), read("comment"))
        keyword = jobs.keyword_stats(read("pages"))
        province = jobs.province_stats(read("wide"))
        found[times] = [
            rows_of(run(job, work / f"{name}{times}", work / f"cp-{name}{times}").where("stt < '2100'"))
            for name, job in (("product", product), ("keyword", keyword), ("province", province))
        ]
        assert all(found[times])
    assert found[1] == found[2]


def test_ids_of_records(spark):
    rows = spark.createDataFrame([("t", '{"a":1}', "7-1"), ("t", "{}", 'x"y'), ("t", '{"a":2}', None), ("t", "no object", "9")], "topic string, value string, record_id string")
    topics_ = FolderTopics(str(new_dir()))
    topics_.writer("job")(rows, 0)
    work = new_dir()
    found = run(topics_.read(spark, "t", "job"), work / "out", work / "cp")
    want = {('{"record_id":"7-1","a":1}', "7-1"), ('{"record_id":"x\\"y"}', 'x"y'), ('{"a":2}', None), ("no object", None)}
    assert {tuple(r) for r in found.select("value", "record_id").collect()} == want
    log = spark.createDataFrame([('{"common":{"mid":"a"},"page":{"page_id":"p"},"displays":[{"item":"7"},{"item":"8"}],"ts":2}', 41)], "value string, log_id long")
    records = logs.route_log(jobs.jsonio.parse(log, jobs.APP_LOG), ids=True).collect()
    assert sorted(r.record_id for r in records) == ["41-0", "41-1", "41-2"]


def test_dirty_pages_have_a_topic(spark):
    folder, work = new_dir() / "pages", new_dir()
    write_file(folder, [page("a", 1), {"ts": "never"}, {"common": {}}])
    found = run(jobs.dirty_pages(lines(spark, folder)), work / "out", work / "cp")
    assert sorted(r["value"] for r in found.collect()) == ['{"common": {}}', '{"ts": "never"}']


def test_serving_days_fold(spark):
    root = str(new_dir())
    write = sinks.serving_folder(root)("t", ["stt", "n"])
    rows = lambda *x: spark.createDataFrame(x, "stt string, n int")
    write(rows(("2024-03-01 00:00:00", 1), ("2024-03-02 00:00:00", 2)), sinks.Batch.of(0, "a"))
    write(rows(("2024-03-01 00:00:00", 1), ("2024-03-02 00:00:00", 2)), sinks.Batch.of(0, "a"))
    write(rows(("2024-03-01 00:00:02", 3)), sinks.Batch.of(0, "b"))
    read = lambda: sorted((str(r["dt"]), r["n"]) for r in spark.read.parquet(f"{root}/t").collect())
    want = [("2024-03-01", 1), ("2024-03-01", 3), ("2024-03-02", 2)]
    assert read() == want
    sinks.fold_day(spark, f"{root}/t", "2024-03-01")
    sinks.fold_day(spark, f"{root}/t", "2024-03-01")
    assert read() == want


def test_folds_that_stop_lose_nothing(spark):
    """A fold that stops behind any of its steps: a later one ends it, and no row is lost or doubled."""
    rows = lambda *x: spark.createDataFrame(x, "stt string, n int")
    for steps in range(8):
        root = str(new_dir())
        write = sinks.serving_folder(root)("t", ["stt", "n"])
        for n in range(3):
            write(rows(("2024-03-01 00:00:00", n)), sinks.Batch.of(n, "a"))
        folding = sinks._folding(spark, f"{root}/t", "dt=2024-03-01", lambda x: x)
        done = [step for step, _ in zip(folding, range(steps))]
        sinks.fold_day(spark, f"{root}/t", "2024-03-01")
        found = spark.read.parquet(f"{root}/t")
        assert sorted(r["n"] for r in found.collect()) == [0, 1, 2], (steps, done)
        assert found.select("batch").distinct().count() == 1


def test_rollup_of_days(spark):
    path = str(new_dir() / "rollup")
    write = sinks.day_rollup(path)
    rows = lambda *x: spark.createDataFrame(x, "stt string, tm_id long, tm_name string, order_amount decimal(16,2)")
    first = rows(("2024-03-01 00:00:00", 1, "A", Decimal("2.50")), ("2024-03-01 00:00:02", 1, "A", Decimal("1.00")), ("2024-04-01 00:00:00", 2, "B", None))
    for _ in range(2):
        write(first, sinks.Batch.of(0, "a"))
    write(rows(("2024-03-01 23:59:58", 1, "A", Decimal("4.00")), ("2024-03-01 00:00:00", None, None, Decimal("1.00"))), sinks.Batch.of(1, "a"))
    day = dt.date(2024, 3, 1)
    for _ in range(2):
        parts = sinks.read_rollup(spark, path, "2024-03-01")
        assert reports.gmv(parts, day).first()[0] == Decimal("8.50")
        assert [tuple(r) for r in reports.top_trademarks(parts.where("tm_name is not null"), day).collect()] == [("A", Decimal("7.50"))]
        sinks.fold_month(spark, path, "2024-03")
    assert reports.gmv(sinks.read_rollup(spark, path, "2024-05-01"), dt.date(2024, 5, 1)).first()[0] is None


def test_a_silent_topic_may_hold_no_window(spark):
    """By the policy `max` windows close without the jumps' topic; by default they wait for it."""
    base = 1_704_067_200_000
    found = {}
    for policy in ("min", "max"):
        work = new_dir()
        folders = {t: work / t for t in ("pages", "visits", "jumps")}
        for t, folder in folders.items():
            folder.mkdir(parents=True)
            for at in () if t == "jumps" else (base, base + 120_000, base + 240_000):
                write_file(folder, [page("m", at)])
        spark.conf.set(apps.WATERMARK_POLICY, policy)
        try:
            out = run(jobs.visitor_stats(*[lines(spark, f) for f in folders.values()]), work / "out", work / "cp")
            found[policy] = out.agg(F.sum("pv_ct"), F.sum("uv_ct")).first()
        finally:
            spark.conf.unset(apps.WATERMARK_POLICY)
    assert tuple(found["min"]) == (None, None)
    assert tuple(found["max"]) == (2, 2)
