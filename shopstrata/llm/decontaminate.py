"""Benchmark decontamination: Wu-Manber search for many word sequences at once.

The symbols are words, as 64-bit hashes, and a block is two of them. For the patterns of one length m, a table has for each
block how far the search may move on: m - 1 words if the block is in no pattern, less if it is nearer a pattern's end. Where
the table says 0, the block selects the patterns that end with it, and these are compared word by word, then byte by byte.
Texts are searched in lanes, so that one array operation moves many places on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import parts, released
from .shared import small_batches
from .words import LETTERS, U, Words, _ranges, mixed, split

WINDOW = 10
LANE = 256
#: Bytes of benchmark text that are sent to the executors at once; a larger benchmark is searched in several such blocks.
BLOCK_BYTES = 16 << 20


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """For each word the hash of the block that ends there."""
    if size == 1:
        return hashes
    with np.errstate(over="ignore"):
        return mixed(np.concatenate([hashes[:1], hashes[1:] * U(5) + hashes[:-1]]))


@dataclass
class Group:
    """Patterns of one length m: their last words' places among the benchmark's words, ordered by their last block."""

    m: int
    ends: np.ndarray
    last: np.ndarray
    shift: np.ndarray
    mask: int


@dataclass
class Patterns:
    item_ids: list[str]
    data: bytes
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    owner: np.ndarray
    groups: list[Group] = field(default_factory=list)

    @staticmethod
    def of(item_ids: list[str], texts: list[str | None], window: int) -> Patterns:
        words = split(pa.array([t or "" for t in texts], pa.string()), LETTERS)
        found = Patterns(item_ids, words.data.tobytes(), words.begin, words.end, words.hash, words.owner())
        sizes = np.minimum(words.counts, window)
        for m in np.unique(sizes[sizes > 0]).tolist():
            items = np.flatnonzero(sizes == m)
            starts = words.first[:-1][items]
            ends = _ranges(starts + m - 1, words.counts[items] - m + 1)
            found.groups.append(found._group(m, ends))
        return found

    def _group(self, m: int, ends: np.ndarray) -> Group:
        size = min(m, 2)
        blocks = _blocks(self.hash, size)
        ends = ends[np.argsort(blocks[ends], kind="stable")]
        inside = np.unique(np.concatenate([blocks[ends - back] for back in range(m - size + 1)])) if len(ends) else blocks[:0]
        # Two to four places for each block. BLOCK_BYTES of text have at most half as many words, so a table has at most
        # twice BLOCK_BYTES bytes.
        mask = (1 << max(12, (2 * len(inside)).bit_length())) - 1
        shift = np.full(mask + 1, m - size + 1, np.int8)
        for back in range(m - size, -1, -1):  # the nearest to the end comes last and stays
            shift[(blocks[ends - back] & U(mask)).astype(np.int64)] = back
        return Group(m, ends, blocks[ends], shift, mask)


def _candidates(words: Words, group: Group) -> np.ndarray:
    """Places of words that end a block whose shift is 0."""
    m, size = group.m, min(group.m, 2)
    blocks = _blocks(words.hash, size)
    lows, highs = words.first[:-1] + m - 1, words.first[1:]
    lanes = np.maximum(0, -(-(highs - lows) // LANE))
    at = np.repeat(lows, lanes) + LANE * _ranges(np.zeros(len(lows), np.int64), lanes)
    to = np.minimum(at + LANE, np.repeat(highs, lanes))
    found = [np.zeros(0, np.int64)]
    while len(at):
        shift = group.shift[(blocks[at] & U(group.mask)).astype(np.int64)]
        found.append(at[shift == 0])
        at = at + np.maximum(shift, 1).astype(np.int64)
        live = at < to
        at, to = at[live], to[live]
    places = np.concatenate(found)
    at = np.minimum(np.searchsorted(group.last, blocks[places]), len(group.last) - 1)
    return places[group.last[at] == blocks[places]]


def occurrences(words: Words, patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (last word of the text's window, number of words, item) where a pattern occurs."""
    out = [(np.zeros(0, np.int64),) * 3]
    for group in patterns.groups:
        places = _candidates(words, group)
        blocks = _blocks(words.hash, min(group.m, 2))[places]
        low, high = np.searchsorted(group.last, blocks), np.searchsorted(group.last, blocks, "right")
        place = np.repeat(places, high - low)
        end = group.ends[_ranges(low, high - low)]
        for back in range(group.m):
            same = words.hash[place - back] == patterns.hash[end - back]
            place, end = place[same], end[same]
        same = np.fromiter((_same_bytes(words, int(p), patterns, int(e), group.m) for p, e in zip(place, end)), bool, len(place))
        out.append((place[same], np.full(int(same.sum()), group.m), patterns.owner[end[same]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _same_bytes(words: Words, place: int, patterns: Patterns, end: int, m: int) -> bool:
    return all(
        words.data[words.begin[place - k] : words.end[place - k]].tobytes() == patterns.data[patterns.begin[end - k] : patterns.end[end - k]]
        for k in range(m)
    )


def marked(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, keep: list[str] | None = None,
) -> DataFrame:
    """The rows of `docs` (or their columns `keep`) with n_words, spans, items, n_hit, n_items, items_sha256, contaminated.

    A window is `window` consecutive words of an item, or all words of an item that has fewer. spans: the ranges of the
    document's words (end exclusive) that lie in an occurrence; n_hit: how many words these are. items: the ids of items
    with an occurring window, sorted as strings. Null and empty texts have no words; an item whose id is null counts as
    ''. Repeated items are one. Columns that have one of the new names are replaced. The benchmark is sent in blocks of
    bounded size, each searched in the same pass over the documents.
    """
    spark = docs.sparkSession
    small_batches(spark)
    new = ["n_words", "spans", "items", "n_hit", "n_items", "items_sha256", "contaminated"]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    hidden = "__text"
    source = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(hidden), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<begin:int,end:int>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_BYTES))
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == k).distinct().orderBy("id", "text").collect()
        patterns = spark.sparkContext.broadcast(Patterns.of([r["id"] for r in rows], [r["text"] for r in rows], window))

        def work(batches, patterns=patterns):
            for batch in batches:
                for part in parts(batch, hidden):
                    yield _search(part, patterns.value, kept, hidden)

        source = source.mapInArrow(released(work), source.schema)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return (
        source.drop(hidden)
        .withColumn("n_hit", hit)
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items").cast("binary"), 256))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )


def _search(part: pa.RecordBatch, patterns: Patterns, kept: list[str], hidden: str) -> pa.RecordBatch:
    words = split(part.column(hidden), LETTERS)
    place, size, item = occurrences(words, patterns)
    steps = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(steps, place - size + 1, 1)
    np.add.at(steps, place + 1, -1)
    before = part.column("spans")
    if len(before.values):
        old = np.repeat(words.first[:-1], before.value_lengths().to_numpy())
        begin, end = (before.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        np.add.at(steps, old + begin, 1)
        np.add.at(steps, old + end, -1)
    inside = np.cumsum(steps[:-1]) > 0
    previous = np.concatenate([[False], inside[:-1]])
    first, some = words.first, np.flatnonzero(words.counts)
    border = np.zeros(len(inside), bool)
    border[first[:-1][some]] = True
    begin = np.flatnonzero(inside & (~previous | border))
    end = np.flatnonzero(inside & (np.append(~inside[1:], True)[: len(inside)] | np.append(border[1:], True)[: len(inside)])) + 1
    owner = np.searchsorted(first, begin, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array((x - first[owner]).astype(np.int32)) for x in (begin, end)], names=["begin", "end"])
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=part.num_rows))]).astype(np.int32)
    found = [set(x or ()) for x in part.column("items").to_pylist()]
    for i, k in set(zip((np.searchsorted(first, place, "right") - 1).tolist(), item.tolist())):
        found[i].add(patterns.item_ids[k])
    columns = [part.column(c) for c in kept] + [
        part.column(hidden),
        pa.array(words.counts.astype(np.int64)),
        pa.ListArray.from_arrays(pa.array(offsets), spans),
        pa.array([sorted(x) for x in found], pa.list_(pa.string())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[*kept, hidden, "n_words", "spans", "items"])
