"""Best-fit packing of token sequences with large-item matching.

Every document is encoded and cut into pieces of at most `capacity` tokens. How many pieces there are of each length is
all that packing depends on, so the plan is made on that histogram (at most `capacity` numbers, whatever the corpus):

1. Pieces above a third of the capacity: at most two fit into a sequence. From the longest down, each is paired with the
   longest one that still fits beside it.
2. The others go, from the longest down, into the smallest gap that holds them; where there is none a sequence begins.

Equal sequences are kept as one entry of the plan with a range of sequence numbers. A piece finds its place from its rank
among the pieces of its length. Ranks come from a rank within a task and the sums over the tasks before.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .batches import parts, released
from .shared import table
from .tokens import encoder

CAPACITY = 1024


@dataclass
class Bins:
    """`count` sequences with the same content, numbered from `base` on."""

    gap: int
    base: int
    count: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, sequence of that rank, pieces for each sequence, offset), by length and rank.

    The pieces of a length from `first rank` to the next row's are dealt to consecutive sequences, so many to each, side
    by side from the offset on. The rows are bounded by the capacity, not by the number of pieces.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    rows: list[tuple[int, int, int, int, int]] = []
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[Bins]] = {}
    order: list[int] = []
    made = 0

    def put(bins: Bins) -> None:
        if bins.gap and bins.count:
            if not gaps.get(bins.gap):
                gaps[bins.gap] = []
                insort(order, bins.gap)
            gaps[bins.gap].append(bins)

    def place(length: int, base: int, each: int, count: int, offset: int) -> None:
        rows.append((length, rank[length], base, each, offset))
        rank[length] += count
        left[length] -= count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left[n]:
            fits = next((m for m in large if left[m] - (m == n) > 0 and m <= capacity - n and m <= n), None)
            if fits is None:
                count = left[n]
                place(n, made, 1, count, 0)
                put(Bins(capacity - n, made, count))
            else:
                count = left[n] // 2 if fits == n else min(left[n], left[fits])
                place(n, made, 1, count, 0)
                place(fits, made, 1, count, n)
                put(Bins(capacity - n - fits, made, count))
            made += count
    for n in sorted((n for n in left if left[n]), reverse=True):
        while left[n]:
            at = bisect_left(order, n)
            if at == len(order):
                new = -(-left[n] // (capacity // n))
                put(Bins(capacity, made, new))
                made += new
                continue
            gap = order[at]
            bins = gaps[gap].pop()
            if not gaps[gap]:
                order.pop(at)
            each = gap // n
            whole = min(bins.count, left[n] // each)
            if whole:
                place(n, bins.base, each, whole * each, capacity - gap)
                put(Bins(gap - each * n, bins.base, whole))
            if whole < bins.count:
                rest = left[n] if left[n] < each else 0
                if rest:
                    place(n, bins.base + whole, rest, rest, capacity - gap)
                    put(Bins(gap - rest * n, bins.base + whole, 1))
                put(Bins(gap, bins.base + whole + bool(rest), bins.count - whole - bool(rest)))
    return sorted(rows)


def cut(docs: DataFrame, path: str, id_column: str, text: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) with the task that made them and their rank in it by length."""
    hidden = "__text"
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias(hidden))

    def work(batches):
        encode, task, seen = encoder(path).ids, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in parts(batch, hidden):
                flat, first = encode(part.column(hidden))
                owner, number, start, length, crc = [], [], [], [], []
                flat = flat.astype("<u4")
                for i in range(part.num_rows):
                    ids = np.append(flat[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                    head = len(ids) % capacity or capacity
                    bounds = [0, *range(head, len(ids) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        owner.append(i), number.append(k), start.append(a), length.append(b - a)
                        crc.append(zlib.crc32(ids[a:b].tobytes()))
                size = np.array(length, np.int64)
                order = np.argsort(size, kind="stable")
                heads = np.flatnonzero(np.diff(size[order], prepend=-1))
                within = np.empty(len(size), np.int64)
                within[order] = np.arange(len(size)) - np.repeat(heads, np.diff(np.append(heads, len(size))))
                rank = within + seen[size]
                seen += np.bincount(size, minlength=capacity + 1)
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
                columns = [part.column("doc_id").take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(size), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(size), task, np.int32)), pa.array(rank)], names=names)

    return source.mapInArrow(released(work), "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long")


def packed(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", end_id: int = 2, capacity: int = CAPACITY
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece of each row of `docs`.

    A document is its ids and `end_id`; only one of more than `capacity` ids is cut, with the shorter piece first. Null and
    empty texts are one piece with the end id alone. Repeated rows are packed each. Other columns are not read.
    """
    pieces = table(cut(docs, path, id_column, text, end_id, capacity), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = np.array(plan(histogram, capacity), np.int64).reshape(-1, 5)
    ranked = pieces.join(offsets, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank")
    )

    def work(batches):
        # One column of numbers that grows with (length, rank): 2^40 ranks for each length.
        key = (rows[:, 0] << 40) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(key, (length << 40) + rank, "right") - 1
            place = rank - rows[at, 1]
            sequence = rows[at, 2] + place // rows[at, 3]
            offset = rows[at, 4] + place % rows[at, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(released(work), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
