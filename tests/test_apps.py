"""All jobs one after the other, from raw records to the serving tables and the reports on them."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shopstrata import constants as C
from shopstrata.operators import changes, reports
from shopstrata.sources.topics import FolderTopics
from shopstrata.streaming import apps

from .streams import new_dir

DAY = "2024-03-01 "
FAR = "2100-01-01 00:00:00"
FAR_MS = 4_102_444_800_000
T0 = 1_709_287_200_000  # 2024-03-01 10:00:00 UTC


def change(xid, table, kind="insert", **data):
    return {"database": "shop", "table": table, "type": kind, "xid": xid, "data": data}


def log(mid, ts, page=None, start=None, displays=None, is_new="1"):
    record = {"common": {"mid": mid, "vc": "v1", "ch": "c1", "ar": "a1", "is_new": is_new}, "ts": ts}
    record |= {k: v for k, v in {"page": page, "start": start, "displays": displays}.items() if v is not None}
    return record


LOGS = [
    log("m1", T0, start={"entry": "icon"}),
    log("m1", T0 + 500, page={"page_id": "home", "during_time": 10}),
    log("m1", T0 + 3000, page={"page_id": "good_detail", "item": "7", "last_page_id": "home", "during_time": 20}, displays=[{"item": "7"}, {"item": "8"}]),
    log("m2", T0 + 1000, page={"page_id": "good_list", "item": "Red Ring", "item_type": "keyword", "last_page_id": "", "during_time": 30}, is_new="0"),
]
CLOSING = [
    log("end", FAR_MS, page={"page_id": "x", "item": "end", "item_type": "keyword"}, is_new="0"),
    log("end", FAR_MS, page={"page_id": "x", "item": "end", "item_type": "keyword", "last_page_id": "y"}, is_new="0"),
    log("end", FAR_MS, page={"page_id": "good_detail", "item": "-1"}, is_new="0"),
]
DIMS = [
    change(1, "user_info", id=5, birthday="2000-01-01", gender="F", tel="1"),
    change(2, "base_province", id=3, name="North", area_code="10", iso_code="CN-N", iso_3166_2="N"),
    change(3, "sku_info", id=7, sku_name="ring", price="9.50", spu_id=70, tm_id=700, category3_id=7000),
    change(4, "spu_info", id=70, spu_name="rings"),
    change(5, "base_trademark", id=700, tm_name="Acme"),
    change(6, "base_category3", id=7000, name="jewels"),
]
FACTS = [
    change(10, "order_info", id=1, province_id=3, user_id=5, order_status="1001", total_amount="30.00", create_time=DAY + "10:00:00"),
    change(11, "order_detail", id=11, order_id=1, sku_id=7, sku_num=2, order_price="9.50", split_total_amount="19.00", create_time=DAY + "10:00:05"),
    change(12, "order_detail", id=12, order_id=1, sku_id=8, sku_num=1, order_price="11.00", split_total_amount="11.00", create_time=DAY + "09:59:55"),
    change(13, "order_detail", id=13, order_id=1, sku_id=7, sku_num=9, order_price="1.00", split_total_amount="9.00", create_time=DAY + "10:00:06"),
    change(14, "payment_info", id=100, order_id=1, user_id=5, total_amount="30.00", create_time=DAY + "10:15:00"),
    change(15, "favor_info", sku_id=7, create_time=DAY + "10:00:00"),
    change(16, "cart_info", sku_id=7, create_time=DAY + "10:00:01"),
    change(17, "order_refund_info", sku_id=7, order_id=1, refund_amount="19.00", create_time=DAY + "10:00:01"),
    change(18, "comment_info", sku_id=7, appraise="1203", create_time=DAY + "10:00:01"),
]


def routing(spark):
    rows = [
        ("user_info", "insert", "hbase", "dim_user_info", "id,birthday,gender", "id", None),
        ("base_province", "insert", "hbase", "dim_base_province", "id,name,area_code,iso_code,iso_3166_2", None, None),
        ("sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name,price,spu_id,tm_id,category3_id", None, None),
        ("spu_info", "insert", "hbase", "dim_spu_info", "id,spu_name", None, None),
        ("base_trademark", "insert", "hbase", "dim_base_trademark", "id,tm_name", None, None),
        ("base_category3", "insert", "hbase", "dim_base_category3", "id,name", None, None),
    ]
    facts = sorted({r["table"] for r in FACTS})
    columns = {t: ",".join(sorted({c for r in FACTS if r["table"] == t for c in r["data"]})) for t in facts}
    rows += [(t, "insert", "kafka", f"dwd_{t}", columns[t], None, None) for t in facts]
    return changes.routing_rows(spark, rows)


@pytest.fixture(scope="module")
def warehouse(spark):
    root = new_dir()
    topics = FolderTopics(str(root / "topics"))
    w = apps.Warehouse(spark, topics, str(root), lambda: routing(spark), trigger={"availableNow": True})

    def send(batch, **records):
        rows = [(topic, json.dumps(r)) for topic, rs in records.items() for r in rs]
        topics.writer("test")(spark.createDataFrame(rows, "topic string, value string"), batch)

    send(0, **{C.ODS_LOG: LOGS, C.ODS_DB: DIMS + FACTS})
    for app in apps.APPS.values():
        app(w).awaitTermination()
    far = {"id": -1, "order_id": -2, "sku_id": -1, "create_time": FAR}
    facts = {f"dwd_{r['table']}": [far] for r in FACTS}
    wide = {C.DWM_ORDER_WIDE: [far], C.DWM_UNIQUE_VISIT: CLOSING, C.DWM_USER_JUMP: CLOSING}
    send(1, **facts, **wide, **{C.DWD_PAGE: CLOSING, C.DWM_PAYMENT_WIDE: [{"sku_id": -1, "payment_create_time": FAR}]})
    for name, app in apps.APPS.items():
        if name not in ("log_split", "change_route"):
            app(w).awaitTermination()
    return w


def served(w, name):
    return w.spark.read.parquet(f"{w.root}/serving/{name}").where("stt < '2100'")


def totals(df, *names):
    return tuple(df.agg(*[F.sum(n) for n in names]).first())


def test_order_wide_joins_within_five_seconds_and_is_named(warehouse):
    lines = warehouse.spark.read.text(f"{warehouse.root}/topics/*/topic={C.DWM_ORDER_WIDE}")
    found = [json.loads(r[0]) for r in lines.collect()]
    found = {r["detail_id"]: r for r in found if "detail_id" in r}
    assert set(found) == {11, 12}
    assert found[11]["tm_name"] == "Acme" and found[11]["province_name"] == "North" and found[11]["user_gender"] == "F"
    assert "tm_name" not in found[12]


def test_visitors(warehouse):
    rows = served(warehouse, C.VISITOR_TABLE)
    assert totals(rows, "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum") == (2, 3, 2, 1, 60)
    assert {r["is_new"] for r in rows.collect()} == {"0"}  # the start record took the only new-visitor mark


def test_products(warehouse):
    rows = served(warehouse, C.PRODUCT_TABLE).where("sku_id = 7")
    counts = "display_ct click_ct favor_ct cart_ct order_sku_num order_ct paid_order_ct refund_order_ct comment_ct good_comment_ct"
    assert totals(rows, *counts.split()) == (1, 1, 1, 1, 2, 1, 1, 1, 1, 1)
    assert [float(x) for x in totals(rows, "order_amount", "payment_amount", "refund_amount")] == [19.0, 19.0, 19.0]
    assert {(r["sku_name"], r["tm_name"], r["category3_name"]) for r in rows.collect()} == {("ring", "Acme", "jewels")}


def test_provinces_and_keywords(warehouse):
    province = served(warehouse, C.PROVINCE_TABLE).collect()
    assert [(r["province_name"], float(r["order_amount"]), r["order_count"]) for r in province] == [("North", 30.0, 2)]
    words = {(r["keyword"], r["ct"], r["source"]) for r in served(warehouse, C.KEYWORD_TABLE).collect()}
    assert words == {("red", 1, "SEARCH"), ("ring", 1, "SEARCH")}


def test_reports(warehouse):
    table = warehouse.spark.read.parquet(f"{warehouse.root}/serving/{C.PRODUCT_TABLE}")
    day = dt.date(2024, 3, 1)
    assert float(reports.gmv(table, day).first()[0]) == 30.0
    top = reports.top_trademarks(table.where("tm_name is not null"), day, 5)
    assert json.loads(reports.chart_series(top).first()[0])["data"]["categories"] == ["Acme"]


def test_command_line(warehouse, capsys):
    where = ["--root", warehouse.root, "--topic-folder", f"{warehouse.root}/topics", "--once"]
    before = served(warehouse, C.KEYWORD_TABLE).count()
    apps.main(["keyword_stats", *where])
    assert served(warehouse, C.KEYWORD_TABLE).count() == before
    with pytest.raises(SystemExit):
        apps.main(["keyword_stats", "--root", warehouse.root])
    with pytest.raises(ValueError):
        apps.main(["change_route", *where])
