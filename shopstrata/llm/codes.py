"""Vectors as short codes: product quantisation in whole numbers, with tries over distinct parts.

A vector is cut into equal parts; each position has a codebook of a few entries, and a part's code is its nearest entry.
The distinct parts of all vectors, with their counts, are sorted as words of a dictionary are: a trie whose paths are their
components. A walk of it, depth first, holds for each prefix the distances so far to all entries; parts with a common beginning
share them, and a leaf takes the least and adds its count and its components to that entry. A subtrie of few leaves is
finished level by level in arrays.

All numbers are integers, so sums don't depend on their order and every run gives the same codes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Leaves of a subtrie that is finished in arrays.
LEAVES = 4096
#: Components may not be larger than this (and vectors not longer than 128), so that distances fit 64 bits.
LARGEST = 1 << 27


def whole_numbers(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and `values`, floor(scale * x) of each component x; vectors that are null or hold null or non-finite
    components are left out. Other columns are not read."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.where(F.col("embedding").isNotNull() & fine)
    floor = lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")
    return rows.select("vec_id", "label", F.transform("embedding", floor).alias("values"))


def _walk(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part and its squared distance; rows: distinct parts in lexicographic order."""
    near, far = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    stack = [(0, len(rows), 0, np.zeros(len(book), np.int64))]
    while stack:
        a, b, depth, sums = stack.pop()
        if b - a <= LEAVES or depth == rows.shape[1]:
            near[a:b], far[a:b] = _subtrie(rows[a:b], book, depth, sums)
            continue
        values = rows[a:b, depth]
        at = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [b - a]]) + a
        # The last child is pushed first, so that children are walked in order.
        for x, y in reversed(list(zip(at[:-1], at[1:]))):
            stack.append((x, y, depth + 1, sums + (rows[x, depth] - book[:, depth]) ** 2))
    return near, far


def _subtrie(rows: np.ndarray, book: np.ndarray, depth: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All leaves below one node. On each level the nodes are the runs of rows with one beginning."""
    fresh = np.zeros(len(rows), bool)
    fresh[:1] = True
    sums, of = sums[None, :], np.zeros(len(rows), np.int64)
    for j in range(depth, rows.shape[1]):
        fresh[1:] |= rows[1:, j] != rows[:-1, j]
        first = np.flatnonzero(fresh)
        sums = sums[of[first]] + (rows[first, j, None] - book[None, :, j]) ** 2
        of = np.cumsum(fresh) - 1
    sums = sums[of]
    near = sums.argmin(1)
    return near, sums[np.arange(len(rows)), near]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling")
    return out


def _distinct_parts(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """part, values, weight: each position's distinct parts and their counts, in lexicographic order."""
    cut = F.posexplode(F.array(*[F.slice("values", p * width + 1, width) for p in range(parts)]))
    rows = vectors.select(cut.alias("part", "values")).groupBy("part", "values").agg(F.count("*").alias("weight"))
    return table(rows.repartitionByRange("part", "values").sortWithinPartitions("part", "values"), "parts")


def _sums(tries: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """For each (part, entry) that is some part's nearest: their count, and their components' sums."""
    width = books.shape[2]

    def work(batches):
        count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            part, weight = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part", "weight"))
            rows = _matrix(batch.column("values"), width)
            for p in np.unique(part):
                own = part == p
                near, _ = _walk(rows[own], books[p])
                np.add.at(count[p], near, weight[own])
                np.add.at(total[p], near, rows[own] * weight[own, None])
        p, k = np.nonzero(count)
        columns = [pa.array(p), pa.array(k), pa.array(count[p, k]), pa.array(total[p, k].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "count", "total"])

    found = tries.select("part", "values", "weight").mapInArrow(work, "part long, entry long, count long, total array<long>")
    sums = [F.sum(F.get("total", F.lit(j))).alias(f"s{j}") for j in range(width)]
    # One row for each entry of each codebook.
    return {(r.part, r.entry): (r.n, [r[f"s{j}"] for j in range(width)]) for r in found.groupBy("part", "entry").agg(F.sum("count").alias("n"), *sums).collect()}


def codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Entries as an array (part, entry, component) from `whole_numbers`; None without a vector that can be cut.

    They start as the parts of the `entries` smallest ids (fewer if there are fewer vectors; ties by components; rows without
    an id come last). Each round takes every part to its nearest entry, the lower one of two, and replaces an entry by
    the floor of its parts' mean; one without parts stays. Vectors count whose length is that of the first one.
    """
    first = vectors.where((F.size("values") > 0) & (F.size("values") % parts == 0)).orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(1).collect()
    if not first:
        return None
    length = len(first[0]["values"])
    alike = vectors.where(F.size("values") == length)
    start = alike.orderBy(F.col("vec_id").asc_nulls_last(), "values").limit(entries).collect()
    books = np.array([r["values"] for r in start], np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2).copy()
    tries = _distinct_parts(alike, length // parts, parts)
    for _ in range(rounds):
        for (p, k), (n, total) in _sums(tries, books).items():
            books[p, k] = [s // n for s in total]
    return books


def encoded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """The columns of `vectors` but `values`, code (two hexadecimal digits for each part) and error (long): the squared distances'
    sum. A vector of another length than the codebooks' has null for both. A batch's distinct parts are tries of their own."""
    parts, _, width = books.shape
    kept = [c for c in vectors.columns if c != "values"]

    def work(batches):
        for batch in batches:
            rows = _matrix(batch.column("values"), parts * width)
            codes, error = np.empty((len(rows), parts), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(parts):
                own = rows[:, p * width : (p + 1) * width]
                order = np.lexsort(own.T[::-1])
                own = own[order]
                fresh = np.ones(len(own), bool)
                fresh[1:] = (own[1:] != own[:-1]).any(1)
                near, far = _walk(own[fresh], books[p])
                back = np.cumsum(fresh) - 1
                codes[order, p] = near[back]
                error[order] += far[back]
            columns = [batch.column(c) for c in kept] + [pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "code", "error"])

    fits = F.size("values") == parts * width
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema if f.name in kept), "code string, error long"])
    done = vectors.where(fits).mapInArrow(work, schema)
    odd = vectors.where(~fits).select(*kept, F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return done.unionByName(odd)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal by part, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error (the errors' sum over equal labels; nulls are one label) and codebooks_sha256.

    embeddings: vec_id, embedding, label. See `whole_numbers` for vectors that are left out and `encoded` for odd lengths;
    repeated rows each have their row and their weight. At most 256 entries; a component is at most 32,768 in size.
    """
    vectors = whole_numbers(embeddings)
    books = codebooks(vectors, parts, entries, rounds)
    if books is None:
        empty = vectors.select("vec_id", "label", F.lit(None).cast("string").alias("code"), *[F.lit(None).cast("long").alias(c) for c in ("error", "label_error")])
        return empty.withColumn("codebooks_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    rows = table(encoded(vectors, books), "codes")
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    both = rows.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return both.select("vec_id", "label", "code", "error", "label_error").withColumn("codebooks_sha256", F.lit(digest(books)))
