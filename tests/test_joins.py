"""Joins and aggregates under skew give the rows of a plain join."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shopstrata.operators import dims, joins, logs, stats, visits


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def always_shuffle(monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a: False)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belong to key 0, another tenth has no key, the rest are spread."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500 + 1)
    return spark.range(6000).select("id", key.cast("long").alias("key"), F.timestamp_seconds("id").alias("at"))


def test_hot_keys_are_exact_and_few(skewed):
    hot = {r["_k0"]: r["_slices"] for r in joins.hot_keys(skewed, ["key"], 0.05).collect()}
    counts = {r["key"]: r["count"] for r in skewed.groupBy("key").count().collect()}
    assert set(hot) == {k for k, n in counts.items() if n > 300}
    assert all(hot[k] == -(-counts[k] // 300) for k in hot)


def test_hot_keys_are_cut_into_even_slices(spark, skewed):
    cut, _ = joins.spread_hot(skewed, spark.range(3).withColumnRenamed("id", "key"), [("key", "key")], ["id"], share=0.05)
    sizes = cut.groupBy("key", "_slice").count().agg(F.max("count")).first()[0]
    assert sizes < 2 * 300


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_balanced_join_equals_plain_join(spark, skewed, always_shuffle, how):
    small = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    found = joins.balanced_join(skewed, small, [("key", "k")], how, ["id"])
    plain = skewed.join(small, F.col("key") == F.col("k"), how)
    columns = ["id", "key"] if how in ("left_semi", "left_anti") else ["id", "key", "k", "v"]
    assert rows_of(found.select(*columns)) == rows_of(plain.select(*columns))


def test_interval_join_bounds_are_inclusive(spark, always_shuffle):
    base = "2024-01-01 00:00:00"
    orders = spark.createDataFrame([(1, base)], "id long, t string").select("id", F.col("t").cast("timestamp").alias("at"))
    offsets = [-900.001, -900, -1, 0, 5, 5.001]
    details = spark.createDataFrame([(1, float(o)) for o in offsets], "order_id long, o double").select(
        "order_id", "o", F.timestamp_micros(F.unix_micros(F.lit(base).cast("timestamp")) + (F.col("o") * 1e6).cast("long")).alias("at")
    )
    pairs = joins.interval_join(details, orders, ("order_id", "id"), ("at", "at"), "-15 minutes", "5 seconds")
    assert sorted(r[0] for r in pairs.select("o").collect()) == [-900, -1, 0, 5]


def test_enrich_keeps_misses_and_overwrites_matches(spark, always_shuffle):
    facts = spark.createDataFrame([(1, 10, "old"), (2, 99, "old"), (3, None, "old")], "id long, sku_id long, sku_name string")
    dim = spark.createDataFrame([("10", "new", "7", "8", "9", "1.50")], "id string, sku_name string, spu_id string, tm_id string, category3_id string, price string")
    found = dims.with_sku(facts, dim, price=True).select("id", "sku_name", "spu_id", "sku_price")
    assert {tuple(map(str, r)) for r in found.collect()} == {
        ("1", "new", "7", "1.50"), ("2", "old", "None", "None"), ("3", "old", "None", "None"),
    }


def page(log_id, mid, ts, last, is_new="0"):
    return (log_id, ts, {"mid": mid, "is_new": is_new, "vc": "v", "ch": "c", "ar": "a"}, {"last_page_id": last, "during_time": 1})


PAGE = (
    "log_id long, ts long, common struct<mid:string,is_new:string,vc:string,ch:string,ar:string>,"
    " page struct<last_page_id:string,during_time:long>"
)


def test_jumps_at_the_edges(spark):
    rows = [
        page(1, "gap", 0, None), page(2, "gap", 10_000, "home"),  # exactly the timeout: a jump
        page(3, "near", 0, ""), page(4, "near", 9_999, "home"),  # followed in time
        page(5, "same", 5, None), page(6, "same", 5, "home"),  # same millisecond, later record
        page(7, "turned", 5, "home"), page(8, "turned", 5, None),  # same millisecond, earlier record
        page(9, "twice", 9_990, None), page(10, "twice", 9_995, None), page(11, "twice", 10_001, "x"),  # across slots
        page(12, "alone", 0, None),
        page(13, None, 0, None),
    ]
    found = visits.user_jumps(spark.createDataFrame(rows, PAGE), 10)
    assert sorted(r[0] for r in found.select("log_id").collect()) == [1, 8, 12]


def test_jumps_of_one_busy_device_equal_brute_force(spark):
    rows = [page(i, "m" if i % 3 else f"m{i}", (i * 7919) % 50_000, None if i % 4 == 0 else "x") for i in range(900)]
    found = visits.user_jumps(spark.createDataFrame(rows, PAGE), 1)
    expected = set()
    for log_id, ts, common, body in rows:
        if body["last_page_id"] is None and not any(
            f[2]["mid"] == common["mid"] and f[3]["last_page_id"] and ts <= f[1] < ts + 1000 and (f[1], f[0]) > (ts, log_id)
            for f in rows
        ):
            expected.add(log_id)
    assert {r[0] for r in found.select("log_id").collect()} == expected


def test_first_new_mark_per_device_stays(spark):
    rows = [
        page(3, "a", 10, None, "1"), page(2, "a", 10, None, "1"), page(1, "a", 11, None, "1"),
        page(4, "b", 5, None, "0"), page(5, "b", 6, None, "1"), page(6, None, 1, None, "1"), page(7, None, 2, None, "1"),
    ]
    found = logs.repair_is_new(spark.createDataFrame(rows, PAGE))
    assert dict(found.select("log_id", "common.is_new").collect()) == {3: "0", 2: "1", 1: "0", 4: "0", 5: "1", 6: "1", 7: "1"}


def test_first_day_visits_under_skew(spark, always_shuffle):
    day = 86_400_000
    rows = [page(i, "m" if i % 2 else f"m{i % 20}", (i % 5) * day + i, None) for i in range(600)]
    found = visits.unique_visits(spark.createDataFrame(rows, PAGE), "first_day")
    first = {}
    for _, ts, common, _ in rows:
        first[common["mid"]] = min(first.get(common["mid"], ts // day), ts // day)
    assert {r[0] for r in found.select("log_id").collect()} == {r[0] for r in rows if r[1] // day == first[r[2]["mid"]]}


def test_orders_are_counted_once_and_alone(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    lines = spark.createDataFrame([(1, 7, 2), (1, 7, 3), (1, 8, 1), (2, 9, 1)], "sku_id long, order_id long, sku_num long")
    rows = stats._product_rows(lines, at, "sku_id", order_sku_num=F.col("sku_num"), order_id=F.col("order_id"))
    found = {r["sku_id"]: (r["order_ct"], r["order_sku_num"], r["paid_order_ct"]) for r in stats.product_stats(rows).collect()}
    assert found == {1: (2, 6, 0), 2: (1, 1, 0)}
