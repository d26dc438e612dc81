"""Near duplicates by b-bit MinHash.

1. A text's set of word shingles gives 128 minima. Bands of them find candidates; of each minimum, scrambled, only the low 4 bits are
   kept, 16 to a 64-bit number, and equal ones are counted by xor and bit counts. Corrected for chance (1/16) that count
   estimates the similarity; pairs that are five standard deviations below the threshold are dropped.
2. Candidates that are left are confirmed on the full sets.

Texts with the same set are one class from the start. Within a band's bucket each class is first compared with the smallest
one only, by its best such estimate. Components of these links make most buckets one component. Classes in the others get
2048 minima, and are compared block by block by estimates from these, across components only: first each one's best other is
confirmed, which joins most of what is left, then all others that are near the threshold. So every pair that shares a bucket ends in one component or has been compared, and groups
of copies never expand into their pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .batches import PART_BYTES, parts, released
from .components import components
from .shared import table
from .words import U, VISIBLE, mixed, split, windows

HASHES, WIDE, BITS = 128, 2048, 4
#: A pair at the threshold shares no band with at most this probability.
MISSED = 1e-6
#: Members of a bucket that are compared with each other at once, and texts that are confirmed beside one.
BLOCK, BESIDE = 512, 256
#: Up to so many ids (of 8 bytes) are broadcast to pick rows by; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_XOR = mixed(np.arange(10_501, 10_501 + WIDE, dtype=U))
_TIMES = mixed(np.arange(20_901, 20_901 + WIDE, dtype=U)) | U(1)


@dataclass(frozen=True)
class Likeness:
    """size: words in a shingle. Two sets are alike if below * shared >= above * united."""

    size: int = 5
    above: int = 4
    below: int = 5

    @property
    def rows(self) -> int:
        """Minima in a band: as many as possible, for fewer chance candidates, at the allowed loss."""
        s = self.above / self.below
        return max(r for r in range(1, 17) if r == 1 or (1 - s**r) ** (HASHES // r) <= MISSED)

    def matches(self, hashes: int = HASHES) -> int:
        """Equal low bits that a pair at the threshold has, less five standard deviations."""
        chance = 1 / (1 << BITS)
        p = self.above / self.below * (1 - chance) + chance
        return math.floor(hashes * p - 5 * math.sqrt(hashes * p * (1 - p)))

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if self.below * min(len(a), len(b)) < self.above * max(len(a), len(b)):
            return False
        shared = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
        return self.below * shared >= self.above * (len(a) + len(b) - shared)


def sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes."""
    hashes, first = windows(split(texts, VISIBLE), size)
    return [np.unique(hashes[a:b]) for a, b in zip(first, first[1:])]


def minima(found: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """The minima of each (non-empty) set, a row for each."""
    whole = np.concatenate(found)
    heads = np.cumsum([0, *map(len, found[:-1])])
    out = np.empty((len(found), hashes), U)
    with np.errstate(over="ignore"):
        for k in range(hashes):
            out[:, k] = np.minimum.reduceat((whole ^ _XOR[k]) * _TIMES[k], heads)
    return out


def low_bits(minima_: np.ndarray) -> np.ndarray:
    """The low bits of the scrambled minima, packed.

    A minimum's own low bits depend on its element's low bits alone, so that two elements would agree in all minima or none.
    """
    low = (mixed(minima_) & U((1 << BITS) - 1)).reshape(len(minima_), -1, 64 // BITS)
    return np.bitwise_or.reduce(low << (np.arange(64 // BITS, dtype=U) * U(BITS)), axis=2)


def equal_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the low-bit groups are equal, for all rows of a with all rows of b."""
    words = a.shape[1]
    out = np.full((len(a), len(b)), words * 64 // BITS, np.int32)
    step = max(1, min(words, (1 << 16) // max(1, len(a) * len(b))))
    for k in range(0, words, step):
        x = a[:, None, k : k + step] ^ b[None, :, k : k + step]
        x |= x >> U(2)
        x |= x >> U(1)
        out -= np.bitwise_count(x & U(0x1111111111111111)).sum(axis=2, dtype=np.int32)
    return out


def band_keys(minima_: np.ndarray, rows: int) -> np.ndarray:
    out = []
    with np.errstate(over="ignore"):
        for k in range(HASHES // rows):
            key = np.full(len(minima_), mixed(np.array([k + 1], U))[0])
            for i in range(k * rows, (k + 1) * rows):
                key = mixed(key * U(3) + minima_[:, i])
            out.append(key)
    return np.stack(out, axis=1)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel().view(np.int64)))


def sketches(docs: DataFrame, like: Likeness) -> DataFrame:
    """docs: doc_id, text. Adds n_shingles, digest (of the set), low (packed low bits) and bands."""

    def work(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                found = sets(part.column("text"), like.size)
                full = [i for i, x in enumerate(found) if len(x)]
                low = np.zeros((len(found), HASHES * BITS // 64), U)
                bands = np.zeros((len(found), HASHES // like.rows), U)
                if full:
                    least = minima([found[i] for i in full])
                    low[full], bands[full] = low_bits(least), band_keys(least, like.rows)
                digests = pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in found], pa.binary())
                columns = [part.column("doc_id"), pa.array([len(x) for x in found], pa.int64()), digests, _lists(low), _lists(bands)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "digest", "low", "bands"])

    return docs.mapInArrow(released(work), "doc_id long, n_shingles long, digest binary, low array<long>, bands array<long>")


def _matches(a: str, b: str) -> F.Column:
    """equal_bits() of two packed columns."""
    nibbles = 0x1111111111111111

    def different(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return F.bit_count(z.bitwiseAND(F.lit(nibbles).cast("long")))

    return F.lit(HASHES) - F.aggregate(F.zip_with(a, b, different), F.lit(0), lambda n, x: n + x)


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `docs` with one of the ids (distinct, column doc_id)."""
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def confirm(pairs: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """Of the pairs (a, b; a table) of ids those whose full sets are alike.

    A text that stands in many pairs is taken beside at most about BESIDE others at once, so no group is unbounded.
    """
    few = 2 * pairs.count() <= BROADCAST_IDS // 4  # rows of four columns
    counts = pairs.groupBy("b").agg(F.ceil(F.count("*") / BESIDE).cast("int").alias("chunks"))
    heads = counts.select(F.col("b").alias("doc_id"), "b", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(False).alias("member"))
    chunk = F.pmod(F.xxhash64("a"), F.col("chunks")).cast("int")
    members = pairs.join(F.broadcast(counts) if few else counts, "b").select(F.col("a").alias("doc_id"), "b", chunk.alias("chunk"), F.lit(True).alias("member"))
    rows = heads.unionByName(members)
    if few:
        rows = docs.join(F.broadcast(rows), "doc_id")
    else:
        ids = table(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        rows = rows.join(_only(docs, ids), "doc_id")
    rows = rows.select("b", "chunk", "member", "doc_id", "text")

    def work(batches):
        at, beside = None, []
        for batch in batches:
            for part in parts(batch, "text", PART_BYTES):
                found = sets(part.column("text"), like.size)
                a, b = [], []
                for key, member, doc_id, own in zip(zip(*(part.column(c).to_pylist() for c in ("b", "chunk"))), part.column("member").to_pylist(), part.column("doc_id").to_pylist(), found):
                    if key != at:
                        at, beside = key, []
                    if not member:
                        beside.append(own)
                    elif any(len(x) and len(own) and like.linked(x, own) for x in beside):
                        a.append(doc_id), b.append(key[0])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition("b", "chunk").sortWithinPartitions("b", "chunk", "member").mapInArrow(released(work), "a long, b long")


def _wide(docs: DataFrame, like: Likeness) -> DataFrame:
    """docs: doc_id, text. The packed low bits of WIDE minima as (rep, wide)."""

    def work(batches):
        for batch in batches:
            for part in parts(batch, "text"):
                found = sets(part.column("text"), like.size)
                full = [i for i, x in enumerate(found) if len(x)]
                # Few texts at a time: their minima take 16 KB each, and packing them a multiple of that.
                for at in range(0, len(full), 256):
                    some = full[at : at + 256]
                    low = low_bits(minima([found[i] for i in some], WIDE))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(some)), _lists(low)], names=["rep", "wide"])

    return docs.mapInArrow(released(work), "rep long, wide array<long>")


def _mixed_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Of the buckets (band, number, rep) those with several components, with the largest one and numbers of blocks."""
    rows = shared.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "rep", F.coalesce("component", "rep").alias("component"), "band", "number"
    )
    # A bucket's largest component is compared with the rest, and the rest with itself, in blocks of members.
    counts = rows.groupBy("band", "component").agg(F.count("*").alias("n"))
    mixed_ = counts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("n")).where("top.n < n")
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed_ = mixed_.select("band", F.col("top.component").alias("top"), blocks(F.col("top.n")).alias("tops"), blocks(F.col("n") - F.col("top.n")).alias("others"))
    return table(rows.join(mixed_, "band"), "mixed-buckets")


def _wide_sketches(rows: DataFrame, classes: DataFrame, docs: DataFrame, like: Likeness) -> DataFrame:
    """Wide sketches of the buckets' members, and 32 bits of each of their bands to tell a pair's first one by."""
    ids = table(rows.select(F.col("rep").alias("doc_id")).distinct(), "ids")
    tags = classes.select("rep", F.transform("bands", lambda x: F.shiftright(x, 32).cast("int")).alias("tags"))
    return table(_wide(_only(docs, ids), like).join(tags, "rep"), "wide-sketches")


def _crossing(rows: DataFrame, sketch: DataFrame, like: Likeness, best: bool) -> DataFrame:
    """Pairs of classes of different components that share a bucket and could be alike.

    rows: those of `_mixed_buckets`. best: of each member's pairs in a bucket only the one of the best estimate.
    """
    in_top = F.col("component") == F.col("top")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.when(in_top, F.col("tops")).otherwise(F.col("others"))).cast("int"))
    # side: 1 for the left of a comparison, 2 for the right, 3 for both.
    group = lambda kind, x, y, side: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.alias("side"))
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    block = F.col("block")
    of_top = F.transform(numbers("others"), lambda j: group(0, block, j, F.lit(1)))
    of_rest = F.concat(
        F.transform(numbers("tops"), lambda k: group(0, k, block, F.lit(2))),
        F.transform(numbers("others"), lambda j: group(1, F.least(block, j), F.greatest(block, j), F.when(block == j, 3).when(block < j, 1).otherwise(2))),
    )
    rows = rows.select("rep", "component", "band", "number", F.explode(F.when(in_top, of_top).otherwise(of_rest)).alias("group"))
    rows = rows.join(sketch, "rep")
    members = F.collect_list(F.struct("rep", "component", "group.side", "wide", "tags")).alias("members")
    groups = rows.groupBy("band", "number", "group.kind", "group.x", "group.y").agg(members)
    least = like.matches(WIDE)

    def work(batches):
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for i, number in enumerate(batch.column("number").to_pylist()):
                members = batch.column("members")[i].values
                rep, component, side = (members.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "component", "side"))
                wide, tag = (members.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(rep), -1) for c in ("wide", "tags"))
                left, right = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
                if not (len(left) and len(right)):
                    continue
                equal = equal_bits(wide[left].view(U), wide[right].view(U))
                equal[component[left][:, None] == component[right][None, :]] = -1
                if best:
                    x, y = np.arange(len(left)), equal.argmax(axis=1)
                    x, y = np.append(x, equal.argmax(axis=0)), np.append(y, np.arange(len(right)))
                    good = equal[x, y] >= least
                    x, y = left[x[good]], right[y[good]]
                else:
                    x, y = np.nonzero(equal >= least)
                    x, y = left[x], right[y]
                    first = ~(tag[x, :number] == tag[y, :number]).any(axis=1)
                    x, y = x[first], y[first]
                x, y = rep[x], rep[y]
                found.append(np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)]), axis=1))
            pairs = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return groups.select("members", "number").mapInArrow(released(work), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, like: Likeness = Likeness(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id (the smallest id reachable by links), kept (it is its own).

    Words are the runs of visible characters after lower-casing A-Z. Texts with fewer words than a shingle have the whole
    as one; null texts and texts without words have none and are linked with nothing. A row without an id is linked with
    nothing: its component is null and it is kept. Rows of one id are each classed by their own text. Other columns are
    not read.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = table(sketches(docs, like), "sketches")
    classes = found.where("n_shingles > 0 and doc_id is not null").groupBy("digest")
    classes = table(classes.agg(F.min("doc_id").alias("rep"), F.first("low").alias("low"), F.first("bands").alias("bands")), "classes")

    rows = classes.select("rep", F.posexplode("bands").alias("number", "band"))
    hubs = rows.groupBy("band").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub != last").select("band", "hub")
    shared = table(rows.join(hubs, "band"), "buckets")
    # A class has few bands: its pairs are dealt by it alone, which the join below takes as they are.
    pairs = shared.where("rep != hub").select("rep", "hub").repartition("rep").distinct()
    sides = classes.select("rep", "low"), classes.select(F.col("rep").alias("hub"), F.col("low").alias("hub_low"))
    rated = pairs.join(sides[0], "rep").join(sides[1], "hub").withColumn("matches", _matches("low", "hub_low"))
    best = rated.where(F.col("matches") >= like.matches()).groupBy("rep").agg(F.max(F.struct("matches", -F.col("hub"))).alias("m"))
    first = table(best.select(F.col("rep").alias("a"), (-F.col("m.col2")).alias("b")), "candidates")
    labels = components(table(confirm(first, docs, like), "links"))

    sketch = None
    for best_only in (True, False):
        # Components only grow, so the buckets and members of later rounds are among those of the first.
        buckets = _mixed_buckets(shared, labels)
        shared = buckets.select("rep", "band", "number")
        sketch = _wide_sketches(buckets, classes, docs, like) if sketch is None else sketch
        crossing = table(_crossing(buckets, sketch, like, best_only), "candidates")
        if crossing.isEmpty():
            break
        links = table(confirm(crossing, docs, like), "links")
        labels = components(links.unionByName(labels.select(F.col("id").alias("a"), F.col("component").alias("b"))))

    named = classes.select("digest", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("component", "rep").alias("component_id"))
    out = found.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    full = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    component = F.when(full, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
