"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

# A key is hot when it holds more than this share of the rows, so there are at most 1 / HOT_SHARE hot keys in any data.
HOT_SHARE = 1 / 1000

BROADCAST_BYTES = 10 * 2**20


def _estimated_bytes(df: DataFrame) -> int | None:
    """Spark's own estimate; None where the session doesn't tell."""
    plan = getattr(df, "_jdf", None)
    return None if plan is None else int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _row_bytes(df: DataFrame) -> int:
    """The width of a row by which Spark estimates sizes."""
    widths = {"string": 20, "decimal": 16, "integer": 4, "boolean": 1}
    return 8 + sum(widths.get(f.dataType.typeName(), 8) for f in df.schema.fields)


def fits_broadcast(df: DataFrame, rows_of: DataFrame | None = None) -> bool:
    """Whether a table is small enough for a copy on every executor.

    `rows_of` is a plain table with the same rows, for a `df` made by joins, whose estimates Spark multiplies: its size is
    then that of as many rows of the width of `df`.
    """
    size = _estimated_bytes(df if rows_of is None else rows_of)
    if size is None:
        return False
    return size * (1 if rows_of is None else _row_bytes(df) / _row_bytes(rows_of)) <= BROADCAST_BYTES


@contextmanager
def shuffled() -> Iterator[None]:
    """Plans made inside broadcast no table, as if all were large."""
    global BROADCAST_BYTES
    before, BROADCAST_BYTES = BROADCAST_BYTES, -1
    try:
        yield
    finally:
        BROADCAST_BYTES = before


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys with more than `share` of the rows and the number of slices that brings each below it.

    Nulls count as a key. The counts are exact, so every evaluation yields the same set, and at most 1 / share rows
    come out whatever the size of `df`: the result may be broadcast.
    """
    limit = F.lit(share) * df.agg(F.count(F.lit(1))).scalar()
    counts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > limit).select(
        *[f"_k{i}" for i in range(len(keys))], F.ceil(F.col("_n") / limit).cast("int").alias("_slices")
    )


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))]


def spread_hot(
    big: DataFrame,
    small: DataFrame,
    keys: list[tuple[str, str]],
    spread_by: list[str],
    counted_in: DataFrame | None = None,
    share: float = HOT_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """Cut the hot keys of `big` into slices and copy their rows of `small` to each slice.

    Both sides get a `_slice` column to join on beside the keys; all other keys stay whole in slice 0. `spread_by`
    names columns of `big` that tell rows of one key apart; the slice is a hash of them, so a repeated task repeats it.
    """
    hot = F.broadcast(hot_keys(big if counted_in is None else counted_in, [b for b, _ in keys], share))

    def slices(df: DataFrame, names: list[str]) -> DataFrame:
        same = reduce(and_, [df[n].eqNullSafe(hot[f"_k{i}"]) for i, n in enumerate(names)])
        return df.join(hot, same, "left").drop(*[f"_k{i}" for i in range(len(names))])

    slice_of = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int"), F.lit(0))
    cut = slices(big, [b for b, _ in keys]).withColumn("_slice", slice_of).drop("_slices")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))
    copied = slices(small, [s for _, s in keys]).withColumn("_slice", copies).drop("_slices")
    return cut, copied


def balanced_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[tuple[str, str]],
    how: str = "inner",
    spread_by: list[str] | None = None,
    also: Column | None = None,
    sized_by: DataFrame | None = None,
    counted_in: DataFrame | None = None,
    even: bool = False,
) -> DataFrame:
    """Equi-join `big` with `small`; in the result they are called `b` and `s`.

    A `small` that fits is broadcast; `sized_by` is a plain table with the same rows if `small` is made by joins.
    Otherwise both sides are shuffled. `even` says that no key can hold a large part of the rows (an order's lines, a
    device's slot): then the join is left as it is, and adaptive execution splits what is uneven all the same. Else hot
    keys are spread; they are counted in `counted_in`, a plainer table with the keys of `big`, so that what `big` went
    through is not done twice. Streams are joined as they are: their rows per trigger are limited at the source.
    """
    same = [F.col(f"b.{b}") == F.col(f"s.{s}") for b, s in keys]
    if also is not None:
        same.append(also)
    if big.isStreaming or small.isStreaming:
        return big.alias("b").join(small.alias("s"), reduce(and_, same), how)
    if fits_broadcast(small, sized_by):
        return big.alias("b").join(F.broadcast(small).alias("s"), reduce(and_, same), how)
    small = small.hint("merge") if BROADCAST_BYTES < 0 else small
    if even:
        return big.alias("b").join(small.alias("s"), reduce(and_, same), how)
    cut, copied = spread_hot(big, small, keys, spread_by or _hashable(big), counted_in)
    copied = copied.hint("merge") if BROADCAST_BYTES < 0 else copied
    same.append(F.col("b._slice") == F.col("s._slice"))
    return cut.alias("b").join(copied.alias("s"), reduce(and_, same), how)


def interval_join(
    big: DataFrame,
    small: DataFrame,
    key: tuple[str, str],
    times: tuple[str, str],
    lower: str,
    upper: str,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Pairs of equal key whose `big` time lies in [`small` time + lower, `small` time + upper], both ends included.

    The key is an order or the like, of which no one has a large part of the rows. Sides are called `b` and `s` in the
    result. On streams both sides need a watermark on their time column.
    """
    at, base = F.col(f"b.{times[0]}"), F.col(f"s.{times[1]}")
    inside = (at >= base + F.expr(f"interval {lower}")) & (at <= base + F.expr(f"interval {upper}"))
    if not big.isStreaming:
        # Hides the times from the not-null filters Spark would add, which work them out a second time for every row.
        inside = F.coalesce(inside, F.lit(False))
    return balanced_join(big, small, [key], "inner", None, inside, sized_by, even=True)


def coalesce_rows(first: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Fill the nulls of `columns` in `first` from the row of `other` with the same key (unique there)."""
    joined = balanced_join(first, other, [(key, key)], "left", even=True)
    return joined.select(
        *[F.coalesce(F.col(f"b.{c}"), F.col(f"s.{c}")).alias(c) if c in columns else F.col(f"b.{c}") for c in first.columns]
    )
