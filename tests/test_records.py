"""Records as the shop writes them, and the small parts around them."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopstrata.functions import jsonio, times, words
from shopstrata.operators import changes, dims, logs, reports, stats, visits, wide
from shopstrata.schemas import APP_LOG, CDC_ROW, CDC_ROWCHANGE, ORDER_INFO, PAGE_VIEW, PRODUCT_STATS, ROUTING
from shopstrata.sources import jdbc, topics
from shopstrata.sources.dimstore import DimStore, table_columns
from shopstrata.checks import queries
from shopstrata.streaming import sinks
from shopstrata.streaming.routing import RoutingConfig

from .streams import new_dir

# A start record repeats a key; a page record has no new-visitor mark and an empty previous page.
START = (
    '{"common":{"ar":"north","uid":"3","ch":"store","is_new":"1","mid":"device-1","vc":"1.0","vc":"1.1"},'
    '"start":{"entry":"icon","loading_time":1200,"open_ad_id":4},"ts":1704067200000}'
)
PAGE = (
    '{"common":{"ar":"south","uid":"9","ch":"web","mid":"device-2","vc":"1.1"},"page":{"page_id":"search",'
    '"item":"手机","during_time":800,"item_type":"keyword","last_page_id":""},"ts":1704067260885}'
)


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_start_and_page_records(spark):
    log = jsonio.parse(text(spark, START, PAGE), APP_LOG)
    assert [r["vc"] for r in logs.start_rows(log).select("common.vc").collect()] == ["1.1"]
    pages = logs.page_rows(log)
    assert logs.entry_pages(pages).select("common.mid", "page.item").collect() == [("device-2", "手机")]
    assert stats.searches(pages).select("full_word").collect() == [("手机",)]


def test_bad_text_is_dirty_and_good_text_is_not(spark):
    bad = ["", "nope", "null", "5", '{"ts":"x"}', '{"ts":1']
    marked = jsonio.parse_or_mark(text(spark, START, PAGE, *bad), APP_LOG, required=("ts",))
    assert jsonio.clean(marked).count() == 2
    assert sorted(r[0] for r in jsonio.dirty(marked).collect()) == sorted(bad)


def test_bad_text_fails_a_strict_job(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        jsonio.parse(text(spark, "nope"), APP_LOG).collect()


def test_numbers_may_be_texts(spark):
    rows = jsonio.parse(text(spark, '{"id":"1","total_amount":"2.50"}', '{"id":1,"total_amount":2.5}'), ORDER_INFO)
    assert rows.select("id", F.col("total_amount").cast("string")).distinct().collect() == [(1, "2.50")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        jsonio.parse(text(spark, '{"id":"x"}'), ORDER_INFO).collect()


def test_repeated_key_in_a_map_keeps_its_last_value(spark):
    row = topics.page_views(text(spark, START)).select(F.col("common")["vc"], F.map_keys("common")).first()
    assert row[0] == "1.1" and row[1].count("vc") == 1
    assert jsonio.parse(text(spark, START), PAGE_VIEW).count() == 1


def test_change_without_table_is_unroutable(spark):
    rows = jsonio.parse(text(spark, '{"database":"shop","xid":7,"data":{"id":4,"name":"Ann"}}'), CDC_ROW)
    routing = spark.createDataFrame([("t", "insert", "kafka", "x", "id", None, None)], ROUTING)
    assert changes.route_changes(rows, routing).count() == 0
    assert changes.unrouted_changes(rows, routing).count() == 1


def test_unknown_target_is_dropped_and_key_defaults(spark):
    rows = jsonio.parse(
        text(spark, '{"table":"a","type":"insert","xid":1,"data":{"id":1,"b":2}}', '{"table":"c","type":"insert","xid":2,"data":{"id":1}}'),
        CDC_ROW,
    )
    routing = spark.createDataFrame(
        [("a", "insert", "hbase", "dim_a", "id,x", None, None), ("c", "insert", "clickhouse", "c", "id", None, None)], ROUTING
    )
    found = changes.route_changes(rows, routing).select("sink_table", "sink_pk", F.to_json("data")).collect()
    assert [tuple(r) for r in found] == [("dim_a", "id", '{"id":"1"}')]


def test_row_changes(spark):
    entries = [
        {"table": "t", "event_type": kind, "entry_type": entry, "rows": [{"before": {"id": "1"}, "after": {"id": "2"}}]}
        for kind, entry in [
            ("INSERT", "ROWDATA"), ("UPDATE", "ROWDATA"), ("DELETE", "ROWDATA"), ("TRUNCATE", "ROWDATA"),
            ("INSERT", "TRANSACTIONBEGIN"), ("INSERT", "TRANSACTIONEND"),
        ]
    ]
    found = changes.explode_row_changes(jsonio.parse(text(spark, *map(json.dumps, entries)), CDC_ROWCHANGE))
    assert sorted((r[0], r[1], r[2]) for r in found.select("event_type", "image", F.col("data")["id"]).collect()) == [
        ("DELETE", "before", "1"), ("INSERT", "after", "2"), ("UPDATE", "after", "2"), ("UPDATE", "before", "1"),
    ]


def test_routing_config_refresh(spark):
    tables = [[("a", "insert", "kafka", "x", "id", None, None), ("b", "insert", "kafka", "y", "id", None, None)],
              [("a", "insert", "kafka", "z", "id", None, None)]]
    now = [0.0]
    config = RoutingConfig(lambda: spark.createDataFrame(tables[1 if now[0] else 0], ROUTING), 5.0, lambda: now[0])
    targets = lambda: {r["source_table"]: r["sink_table"] for r in config.current(spark).collect()}
    assert targets() == {"a": "x", "b": "y"}
    now[0] = 4.0
    assert targets() == {"a": "x", "b": "y"}
    now[0] = 6.0
    assert targets() == {"a": "z", "b": "y"}
    with pytest.raises(RuntimeError):
        RoutingConfig(lambda: spark.createDataFrame([], ROUTING)).current(spark)


def dim_changes(spark, *rows, table="dim_user"):
    rows = [(table, "id", *r, 0) if len(r) == 2 else (table, "id", *r) for r in rows]
    return spark.createDataFrame(rows, "sink_table string, sink_pk string, xid long, data map<string,string>, log_id long")


def test_dimensions_merge_by_column_version_and_place(spark):
    store = DimStore(spark, str(new_dir()))
    users = lambda: {tuple(r) for r in store.read("dim_user", ["id", "name", "city"]).collect()}
    assert users() == set()
    first = dim_changes(spark, (1, {"id": "1", "name": "Ann", "city": "Oslo"}), (2, {"id": "2", "name": "Bo"}))
    store.write(first, 0)
    store.write(first, 0)
    store.write(dim_changes(spark, (4, {"id": "1", "name": "Anna"}), (3, {"id": "1", "name": "Anne"}), (5, {"id": "1", "city": None})), 1)
    store.write(dim_changes(spark, (1, {"id": "7"}), (1, {"name": "no key"}), table="dim_other"), 2)
    expected = {("1", "Anna", None), ("2", "Bo", None)}
    assert users() == expected
    store.fold()
    store.fold()
    assert users() == expected and store.read("dim_other", ["id"]).count() == 1
    store.write(dim_changes(spark, (9, {"id": "1", "name": "again"})), 1)  # folded already
    assert users() == expected
    # An earlier version that arrives after the fold stays behind, a later one wins; of one version the later place.
    store.write(dim_changes(spark, (3, {"id": "1", "name": "old"}), (6, {"id": "2", "city": "Bonn"}, 5), (6, {"id": "2", "city": "Rome"}, 8)), 3)
    assert users() == {("1", "Anna", None), ("2", "Bo", "Rome")}
    store.fold()
    assert users() == {("1", "Anna", None), ("2", "Bo", "Rome")}


def test_dimensions_after_a_new_checkpoint_and_their_files(spark):
    root = new_dir()
    store = DimStore(spark, str(root))
    for n in range(6):
        store.write(dim_changes(spark, (n, {"id": "1", "name": f"old{n}"})), n, "first")
        if n % 2:
            store.fold()
    # What the last fold replaced stays for its readers, until the next fold.
    assert sorted(p.name for p in root.glob("changes/*/batch=*")) == ["batch=4", "batch=5"]
    assert len(list(root.glob("base/*"))) == 2 and len(list(root.glob("marks/*"))) == 2
    store.fold()
    assert not list(root.glob("changes/*/batch=*"))
    assert len(list(root.glob("base/*"))) == 1 and len(list(root.glob("marks/*"))) == 1
    store.write(dim_changes(spark, (9, {"id": "1", "name": "new"})), 0, "second")
    assert [tuple(r) for r in store.read("dim_user", ["id", "name"]).collect()] == [("1", "new")]


def test_folds_write_touched_buckets_and_reads_take_theirs(spark):
    root = new_dir()
    store = DimStore(spark, str(root), 16)
    store.write(dim_changes(spark, *[(1, {"id": str(k), "name": f"n{k}"}) for k in range(200)]), 0)
    store.fold()
    assert len(list(root.glob("base/generation=1/sink_table=dim_user/bucket=*"))) == 16
    store.write(dim_changes(spark, (2, {"id": "7", "name": "new", "city": "Oslo"}), (2, {"id": "500", "name": "n500"})), 1)
    # A reader of this moment goes on while the change is folded.
    before = store.read("dim_user", ["id", "name", "city"])
    store.fold()
    touched = list(root.glob("base/generation=2/sink_table=dim_user/bucket=*"))
    assert 1 <= len(touched) <= 2
    want = {(str(k), "new" if k == 7 else f"n{k}", "Oslo" if k == 7 else None) for k in [*range(200), 500]}
    assert {tuple(r) for r in before.collect()} == want == {tuple(r) for r in store.read("dim_user", ["id", "name", "city"]).collect()}
    store.write(dim_changes(spark, (3, {"id": "8", "name": "later"}), (3, {"id": "9", "name": "later"})), 2)
    facts = spark.createDataFrame([(7, "a"), (8, "b"), (8, "c"), (None, "d")], "user_id long, x string")
    some = store.rows_for(facts, {"dim_user": "user_id"})
    paths = some.inputFiles()
    buckets = {p.split("bucket=")[1].split("/")[0] for p in paths if "bucket=" in p}
    assert len(buckets) <= 3
    found = {r["id"]: r["name"] for r in store.read("dim_user", ["id", "name"], rows=some).collect()}
    assert found["7"] == "new" and found["8"] == "later" and len(found) < 100
    store.fold()
    store.fold()
    assert {r["id"]: r["name"] for r in store.read("dim_user", ["id", "name"]).collect()}["9"] == "later"
    # Untouched buckets are still the first fold's.
    assert len(list(root.glob("base/generation=1/sink_table=dim_user/bucket=*"))) >= 10


def test_a_fold_that_stopped_is_begun_again(spark):
    root = new_dir()
    store = DimStore(spark, str(root))
    store.write(dim_changes(spark, (1, {"id": "1", "name": "Ann"})), 0)
    store.fold()
    store.write(dim_changes(spark, (2, {"id": "1", "name": "Anna"}), (2, {"id": "2", "name": "Bo"})), 1)
    store.fold()
    # As if the driver had stopped before the last mark: its folder of the base is there, the mark is not.
    for path in (root / "marks/2").iterdir():
        path.unlink()
    read = lambda: {tuple(r) for r in store.read("dim_user", ["id", "name"]).collect()}
    assert read() == {("1", "Anna"), ("2", "Bo")}
    store.fold()
    assert read() == {("1", "Anna"), ("2", "Bo")}
    store.fold()
    assert read() == {("1", "Anna"), ("2", "Bo")}


def test_dimension_columns_of_all_routing_rows():
    row = {"sink_table": "dim_x", "sink_columns": "id,name", "sink_pk": None}
    other = {"sink_table": "dim_x", "sink_columns": "id,level", "sink_pk": "id"}
    assert table_columns([row, other]) == {"dim_x": (["id", "name", "level"], "id")}
    with pytest.raises(ValueError):
        table_columns([row | {"sink_pk": "code"}])
    with pytest.raises(ValueError):
        table_columns([row, {"sink_table": "dim_x", "sink_columns": "id,name", "sink_pk": "name"}])


def test_lookup_needs_a_column(spark):
    dim = spark.createDataFrame([("19", "x"), ("20", "y")], "id string, tm_name string")
    assert changes.where_equal(dim, {"id": "19", "tm_name": "x"}).count() == 1
    with pytest.raises(ValueError):
        changes.where_equal(dim, {})
    with pytest.raises(ValueError):
        dims.lookup(dim, dim, {}, [])


def test_times(spark):
    ts = F.lit("2021-07-23 20:13:22.5").cast("timestamp")
    row = spark.range(1).select(
        times.time_text(ts), times.time_text(ts, "Asia/Shanghai"), times.day_of(ts, "Asia/Shanghai"), times.day_number(ts),
        times.text_millis(F.lit("2021-07-23 08:13:22")), times.years_between(F.lit("2000-01-01").cast("date"), F.lit("2003-12-31").cast("date")),
    ).first()
    assert tuple(row) == (
        "2021-07-23 20:13:22", "2021-07-24 04:13:22", dt.date(2021, 7, 24), 20210723, 1626999202000, 4,
    )


def test_words(spark):
    phrase = spark.createDataFrame([("Spark实时数仓 v2.1 Été",), (None,), ("",)], "p string")
    plain = [r[0] for r in words.explode_words(phrase, "p").collect()]
    assert plain == ["spark", "实", "时", "数", "仓", "v2", "1", "été"]
    split = words.word_list_splitter(spark, ["实时", "数仓", "时数仓"])
    assert [r[0] for r in words.explode_words(phrase, "p", split=split).collect()] == ["spark", "实时", "数仓", "v2", "1", "été"]


def cuts(run, known):
    """All cuts of a run into known words and single characters."""
    if not run:
        return [[]]
    return [[run[:n], *rest] for n in range(1, len(run) + 1) if n == 1 or run[:n] in known for rest in cuts(run[n:], known)]


def best_cut(run, known):
    return min(cuts(run, known), key=lambda c: (len(c), [-len(w) for w in c]))


def test_word_list_takes_the_fewest_words(spark, sample_dir):
    rnd, known = random.Random(3), {"ab", "abc", "bcd", "cd", "d", "dea", "ea", "aaaa", "bb", ""}
    trie = words.trie_of(known)
    for _ in range(300):
        run = "".join(rnd.choice("abcde") for _ in range(rnd.randrange(1, 12)))
        assert words.fewest_words(run, trie) == best_cut(run, known)
    phrases = [tuple(r) for r in queries.han_phrases(spark, sample_dir).collect()]
    want = Counter((k, w) for k, p in phrases for run in p.split() for w in best_cut(run, set(queries.HAN_WORDS)))
    found = Counter(tuple(r) for r in queries.QUERIES["udtf_tokenize_word_list"](spark, sample_dir).select("p_partkey", "keyword").collect())
    assert found == want and any(len(w) > 1 for _, w in found)
    with pytest.raises(ValueError):
        words.word_list_splitter(spark, ["实时"], list_bytes=10)


def test_reports(spark):
    rows = [("2021-07-21 23:59:58", "b", 3), ("2021-07-21 00:00:00", "a", 3), ("2021-07-21 10:00:00", "c", 9),
            ("2021-07-21 10:00:00", "zero", 0), ("2021-07-22 00:00:00", "c", 100), ("2021-07-20 23:59:58", "c", 100)]
    table = spark.createDataFrame(rows, "stt string, tm_name string, order_amount long")
    table = table.withColumn("order_amount", F.col("order_amount").cast("decimal(16,2)"))
    day = dt.date(2021, 7, 21)
    top = reports.top_trademarks(table, day, 3)
    assert [r["tm_name"] for r in top.collect()] == ["c", "a", "b"]
    reply = json.loads(reports.chart_series(top).first()[0])
    assert reply == {"status": 0, "data": {"categories": ["c", "a", "b"], "series": [{"data": [9, 3, 3]}]}}
    assert json.loads(reports.gmv_reply(reports.gmv(table, day)).first()[0]) == {"status": 0, "msg": "", "data": 15}
    assert json.loads(reports.gmv_reply(reports.gmv(table, dt.date(2020, 1, 1))).first()[0])["data"] is None
    assert reports.gmv(table).first()[0] is None
    empty = json.loads(reports.chart_series(reports.top_trademarks(table, dt.date(2020, 1, 1))).first()[0])
    assert empty["data"] == {"categories": [], "series": [{"data": []}]}


def test_serving_rows(spark):
    rows = spark.range(1).select(F.lit(1).alias("b"), F.lit(2).alias("a"), F.lit(3).alias("ids"))
    assert sinks.serving_rows(rows, ["a", "ids", "b", "ts"], ("ids",)).columns == ["a", "b"]
    assert sinks.serving_rows(sinks.stamped(rows), ["a", "ts"]).columns == ["a", "ts"]
    with pytest.raises(ValueError):
        sinks.serving_rows(rows, ["nowhere"])
    assert len(PRODUCT_STATS) == 25


def test_options():
    kafka = topics.kafka_options("host:1", "ods_base_log", "split", "earliest")
    assert kafka["subscribe"] == "ods_base_log" and kafka["startingOffsets"] == "earliest"
    options = jdbc.query_options("jdbc:x", "select 1", "id", (0, 100), 8, user="u")
    assert options["numPartitions"] == "8" and options["dbtable"] == "(select 1) q" and options["user"] == "u"
    assert [jdbc.camel_case(n) for n in ("source_table", "id", "SINK_PK")] == ["sourceTable", "id", "sinkPk"]


def test_merge_fills_only_what_is_missing(spark):
    details = spark.createDataFrame([(1, 5, 7)], "id long, order_id long, sku_id long")
    names = ["sku_name", "order_price", "sku_num", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
    rows = wide.detail_only(details.select("*", *[F.lit(None).cast("string").alias(n) for n in names]))
    assert rows.select("detail_id", "order_id", "total_amount").first() == (1, 5, None)


def test_modes_are_checked(spark):
    log = jsonio.parse(text(spark, PAGE), APP_LOG).withColumn("log_id", F.lit(1))
    with pytest.raises(ValueError):
        visits.unique_visits(log, "other")
