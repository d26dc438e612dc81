"""Dimensions: building them from changes and joining them to facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import years_between
from .joins import balanced_join

def lookup(requests: DataFrame, dim: DataFrame, on: dict[str, str], columns: list[str]) -> DataFrame:
    """Requests with the matching dimension rows, by equality of one or more columns (`request column: dim column`)."""
    if not on:
        raise ValueError("give at least one column to look up by")
    small = dim.select(*{*on.values(), *columns})
    joined = balanced_join(requests, small, list(on.items()), "left")
    return joined.select(*[F.col(f"b.{c}") for c in requests.columns], *[F.col(f"s.{c}").alias(f"dim_{c}") for c in columns])


def enrich(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    columns: dict[str, Column | str],
    dim_key: str = "id",
    spread_by: list[str] | None = None,
    sized_by: DataFrame | None = None,
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Add `columns` (new name: dimension expression) by key. A fact without a match passes with its own values.

    `dim_key` is unique in `dim`. `spread_by` names fact columns that tell rows of one key apart. In a chain of these,
    `counted_in` is the first one's facts.
    """
    key_type = facts.schema[key].dataType
    small = dim.select(
        F.col(dim_key).cast(key_type).alias("_key"),
        *[(F.col(e) if isinstance(e, str) else e).alias(f"_new_{n}") for n, e in columns.items()],
    )
    joined = balanced_join(facts, small, [(key, "_key")], "left", spread_by, None, sized_by, counted_in)
    hit = F.col("s._key").isNotNull()

    def value(name: str) -> Column:
        new = F.col(f"s._new_{name}")
        return F.when(hit, new).otherwise(F.col(f"b.{name}")) if name in facts.columns else new

    kept = [F.col(f"b.{c}") for c in facts.columns if c not in columns]
    return joined.select(*kept, *[value(n).alias(n) for n in columns])


def with_user(facts: DataFrame, users: DataFrame, as_of: dt.date | None = None, **kw) -> DataFrame:
    """Age on the day `as_of` (default: today) and gender."""
    age = years_between(F.to_date("birthday"), F.current_date() if as_of is None else F.lit(as_of))
    return enrich(facts, users, "user_id", {"user_age": age, "user_gender": "gender"}, **kw)


def with_province(facts: DataFrame, provinces: DataFrame, **kw) -> DataFrame:
    columns = {
        "province_name": "name",
        "province_area_code": "area_code",
        "province_iso_code": "iso_code",
        "province_3166_2_code": "iso_3166_2",
    }
    return enrich(facts, provinces, "province_id", columns, **kw)


def with_sku(facts: DataFrame, skus: DataFrame, price: bool = False, **kw) -> DataFrame:
    columns: dict[str, Column | str] = {"sku_name": "sku_name"}
    if price:
        columns["sku_price"] = F.col("price").cast("decimal(16,2)")
    columns |= {c: F.col(c).cast("long") for c in ("spu_id", "tm_id", "category3_id")}
    return enrich(facts, skus, "sku_id", columns, **kw)


def with_spu(facts: DataFrame, spus: DataFrame, **kw) -> DataFrame:
    return enrich(facts, spus, "spu_id", {"spu_name": "spu_name"}, **kw)


def with_trademark(facts: DataFrame, trademarks: DataFrame, **kw) -> DataFrame:
    return enrich(facts, trademarks, "tm_id", {"tm_name": "tm_name"}, **kw)


def with_category3(facts: DataFrame, categories: DataFrame, **kw) -> DataFrame:
    return enrich(facts, categories, "category3_id", {"category3_name": "name"}, **kw)


def flat_skus(skus: DataFrame, spus: DataFrame, trademarks: DataFrame, categories: DataFrame) -> DataFrame:
    """The product dimension with its family, trademark and category names.

    Joining the three small tables to the product dimension once replaces three joins on every fact table.
    """
    flat = skus.select(
        "id", "sku_name", "price", *[F.col(c).cast("long").alias(c) for c in ("spu_id", "tm_id", "category3_id")]
    )
    plain = flat
    for add, table in ((with_spu, spus), (with_trademark, trademarks), (with_category3, categories)):
        flat = add(flat, table, spread_by=["id"], counted_in=plain)
    return flat


def with_flat_sku(facts: DataFrame, flat: DataFrame, price: bool = False, **kw) -> DataFrame:
    names = ["sku_name", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name"]
    columns: dict[str, Column | str] = {n: n for n in names}
    if price:
        columns["sku_price"] = F.col("price").cast("decimal(16,2)")
    return enrich(facts, flat, "sku_id", columns, **kw)
