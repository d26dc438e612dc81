"""Near duplicates among embeddings by random-hyperplane signs, exact cosines and connected components.

A table's key is the signs of a vector's products with `bits` random hyperplanes. Vectors of one label that agree in the
key of any table are compared exactly, in double precision. The number of bits grows with the logarithm of the largest
label, so that unrelated vectors rarely meet, and the number of tables with it, so that a pair at the threshold is missed
with at most the probability MISSED at any size of the input.

Equal vectors of a label are one class with a count. Pairs are never rows: a bucket is compared in blocks, a link counts in
the first table that has both vectors together, and a block gives each vector's sum of links and a spanning forest.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import table
from .words import _ranges

MISSED = 1e-6
#: Members of a bucket that are compared with each other at once.
BLOCK = 512
SMALL = 24


def plan(largest: int, cosine: float, missed: float = MISSED) -> tuple[int, int]:
    """Bits of a key and number of tables for labels of up to `largest` distinct vectors."""
    bits = min(48, max(8, math.ceil(math.log2(2 * max(largest, 1)))))
    agree = 1 - math.acos(cosine) / math.pi
    return bits, math.ceil(math.log(missed) / math.log1p(-(agree**bits)))


@cache
def planes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng([dim, bits, tables, 20]).standard_normal((dim, bits * tables))


def keys(units: np.ndarray, bits: int, tables: int) -> np.ndarray:
    signs = (units @ planes(units.shape[1], bits, tables) >= 0).reshape(len(units), tables, bits)
    return signs.astype(np.int64) @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _valid(rows: pa.Array) -> list[bytes | None]:
    """A digest of each vector that can be linked, else None."""
    flat = rows.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
    size = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    out = []
    for a, b in zip(ends - size, ends):
        x = values[a:b]
        out.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) and np.isfinite(x).all() and x.any() else None)
    return out


def _digests(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_valid(batch.column("vector")), pa.binary())], names=[*batch.schema.names, "digest"])


def _matrix(rows: pa.Array, dim: int) -> np.ndarray:
    return unit(rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))


def _roots(linked: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The smallest number reachable by each row of a symmetric table of links."""
    root = numbers.copy()
    while True:
        near = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (near == root).all():
            return root
        root = near


def _compare(vectors, ids, counts, left, right, both, at, bits, tables, cosine):
    """Sums of links first met in table `at`, and each vector's smallest id within the block. both: left is right."""
    close = vectors[left] @ vectors[right].T >= cosine
    if both:
        np.fill_diagonal(close, False)
    if not close.any():
        return None
    rows, columns = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
    close, left, right = close[np.ix_(rows, columns)], left[rows], right[columns]
    fresh = close.copy()
    if at:
        a, b = keys(vectors[left], bits, tables), keys(vectors[right], bits, tables)
        for t in range(at):
            fresh &= a[:, t, None] != b[None, :, t]
    sums = [fresh @ counts[right]]
    members = left
    if not both:
        sums.append(fresh.T @ counts[left])
        members = np.concatenate([left, right])
        whole = np.zeros((len(members), len(members)), bool)
        whole[: len(left), len(left) :] = close
        close = whole | whole.T
    return ids[members], np.concatenate(sums), _roots(close, ids[members])


def _groups(batches, bits, tables, cosine):
    for batch in batches:
        lists = batch.column("members")
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(size) - size
        flat = lists.flatten()
        ids, counts, side = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "n", "side"))
        whole = flat.field("vector")
        out = []
        for dim in np.unique(batch.column("dim").to_numpy()).tolist():
            mine = np.flatnonzero(batch.column("dim").to_numpy() == dim)
            places = _ranges(first[mine], size[mine])
            vectors = _matrix(whole.take(pa.array(places)), dim)
            ends = np.cumsum(size[mine])
            group = np.repeat(np.arange(len(mine)), size[mine])
            # Of small groups only those with a close pair are looked at.
            near = size[mine] > SMALL
            for d in range(1, SMALL):
                a = np.flatnonzero(group[d:] == group[:-d])
                a = a[~near[group[a]]]
                if not len(a):
                    break
                for part in np.array_split(a, len(a) // 20000 + 1):
                    hit = np.einsum("ij,ij->i", vectors[part], vectors[part + d]) >= cosine - 1e-9
                    near[group[part[hit]]] = True
            for g in np.flatnonzero(near):
                own = slice(ends[g] - size[mine[g]], ends[g])
                where = places[own]
                s = side[where]
                both = bool((s == 3).all())
                left, right = np.flatnonzero(s & 1), np.flatnonzero(s & 2)
                found = _compare(vectors[own], ids[where], counts[where], left, right, both, batch.column("number")[int(mine[g])].as_py(), bits, tables, cosine)
                if found is not None:
                    out.append(found)
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["rep", "links", "root"])


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.93, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Per row of `vectors`: vec_id, n_links, component_id, kept.

    Two rows are linked if their labels are equal and not null and the cosine is at least `cosine`. Vectors that are null,
    empty, zero or hold null or non-finite components, and rows without id or label, are linked with nothing; their
    component is their own id (kept true). Vectors of different lengths are not linked. Repeated rows are linked with each
    other. Other columns are not read.
    """
    source = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    plain = source.dtypes[2][1]
    found = source.mapInArrow(_digests, f"vec_id long, label {source.dtypes[1][1]}, vector {plain}, digest binary")
    found = table(found, "vectors")
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("digest").isNotNull()
    classes = found.where(able).groupBy("label", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    classes = table(classes.withColumn("dim", F.size("vector")), "vector-classes")
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits, tables = plan(largest, cosine)

    def keyed(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                k = keys(_matrix(part.column("vector"), dim), bits, tables)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(k) + 1, dtype=np.int32) * tables), pa.array(k.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("rep", "label", "dim")), lists], names=["rep", "label", "dim", "keys"])

    rows = classes.select("rep", "label", "dim", "vector").mapInArrow(keyed, f"rep long, label {source.dtypes[1][1]}, dim int, keys array<long>")
    rows = table(rows, "vector-keys").select("rep", "label", "dim", F.posexplode("keys").alias("number", "key"))
    bucket = ["label", "dim", "number", "key"]
    counts = rows.groupBy(*bucket).agg(F.count("*").alias("m")).where("m > 1").select(*bucket, F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(counts, bucket).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    side = F.when(F.col("block") == F.col("other"), 3).when(F.col("block") < F.col("other"), 1).otherwise(2)
    rows = rows.select("rep", *bucket, F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), side.alias("side"))
    rows = rows.join(classes.select("rep", "label", "n", "vector"), ["rep", "label"])
    groups = rows.groupBy(*bucket, "one", "two").agg(F.collect_list(F.struct("rep", "n", "side", "vector")).alias("members"))
    met = groups.select("dim", "number", "members").mapInArrow(lambda b: _groups(b, bits, tables, cosine), "rep long, links long, root long")
    met = table(met.groupBy("rep", "root").agg(F.sum("links").alias("links")), "vector-links")

    labels = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.select("label", "digest", "rep", "n").join(links, "rep", "left").join(labels, "rep", "left")
    named = named.select("label", "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = found.select("vec_id", F.when(able, F.col("label")).alias("label"), F.when(able, F.col("digest")).alias("digest"))
    out = out.join(named, ["label", "digest"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
