"""The trie of all conversations' prefixes, by truncation peeling.

A conversation is one row: its path, 20 bytes for each turn (a chained digest of all turns so far, and the words of the last).
The deepest paths are nodes of the deepest level. A level's nodes are emitted with what their subtrees hold, lose their last
turn, and are merged with each other and with the conversations that end one turn higher; those are the nodes of the next
level, up to the root. No node is made before its level, and each once.

Levels are peeled in bands. All paths with one beginning of `low` turns are peeled from their deepest turn up to there in one
task, if they are few bytes; a larger group's deeper part is peeled first, in smaller groups, and a band of one level is an
aggregate of Spark's, which a hot node does not hurt. So a chain of n turns takes log n rounds, and no task holds more than
`GROUP_BYTES` of paths.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .shared import table

DIGEST, ENTRY = 16, 20
#: Bytes of paths below one node that a task peels at once.
GROUP_BYTES = 1 << 20
#: Rows of a batch that a task returns.
BATCH = 8192
ROW = "path binary, n long, conv long, kids long, leaves long, saved long"
NODE = "depth int, key binary, parent binary"
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: array of (digest, words).

    conversations: conv_id, turn, role, text; other columns are not read. Turns are ordered by turn (null first), then role,
    then digest, so repeated rows are turns of their own. A null role or text is empty. Rows without conv_id belong to no
    conversation and are left out. Texts are not shuffled: of a turn go on 32 bytes and its count of words.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    rows = conversations.where("conv_id is not null").select("conv_id", F.struct("turn", role.alias("role"), digest.alias("digest"), words.alias("words")).alias("t"))
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def with_shared_starts(lists: DataFrame, family: int, longest: int) -> DataFrame:
    """Conversation c's first h turns are replaced by those of c - c % family (fewer if it has fewer, none if it is absent);
    h is crc32(c as text) % (longest + 1)."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)).cast("int")
    heads = lists.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, longest).alias("head"))
    rows = lists.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % family).join(heads, "base", "left")
    start = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return rows.select("conv_id", F.concat(start, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def paths(lists: DataFrame) -> DataFrame:
    """conv_id and its path."""

    def work(batches):
        for batch in batches:
            turns = batch.column("turns")
            flat, at = turns.flatten(), turns.offsets.to_pylist()
            digests, words = flat.field("digest").to_pylist(), flat.field("words").to_pylist()
            first, out = at[0], []
            for a, b in zip(at, at[1:]):
                key, path = b"", bytearray()
                for i in range(a - first, b - first):
                    key = hashlib.sha256(key + digests[i]).digest()[:DIGEST]
                    path += key + words[i].to_bytes(ENTRY - DIGEST, "big")
                out.append(bytes(path))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(out, pa.binary())], names=["conv_id", "path"])

    return lists.select("conv_id", "turns").mapInArrow(work, "conv_id long, path binary")


def _depth(path: str = "path") -> Column:
    return F.floor(F.length(path) / ENTRY).cast("int")


def _key(back: int = 0) -> Column:
    """The digest of a path, or of the path without its last `back` turns; empty for the root."""
    at = F.length("path") - ENTRY * (back + 1) + 1
    return F.when(at > 0, F.substring("path", at, F.lit(DIGEST))).otherwise(F.lit(b""))


def nodes(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie of `paths`: depth, key, parent (null: the root), n (members), conv (the smallest), kids,
    leaves, saved, parent_conv, ends_sha256. No conversation gives no rows."""
    conversations = table(conversations, "paths")
    zeros = [F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")]
    ended = table(conversations.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv")).select("path", "n", "conv", *zeros), "ended")
    deepest = ended.agg(F.max(_depth())).first()[0]
    found: list[DataFrame] = []
    up = ended.where(F.length("path") == 0)
    if deepest:
        up = up.unionByName(_peel(ended.where(F.length("path") > 0), 0, deepest, found))
    root = table(_emitted(_merged(up)), "root")
    top = root.first()
    every = reduce(DataFrame.unionByName, found, root)
    above = every.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    below = every.where("depth > 1").join(above, "parent", "left")
    first = every.where("depth <= 1").withColumn("parent_conv", F.when(F.col("depth") == 1, F.lit(top.conv if top else None).cast("long")))
    whole = below.unionByName(first.select(below.columns))
    ends = _ends(conversations.select(_key().alias("key"), "conv_id"))
    return whole.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY)))


def _peel(rows: DataFrame, low: int, high: int, found: list[DataFrame]) -> DataFrame:
    """Peel all levels from `high` to `low` + 1; the tables of their nodes go to `found`. Returns the rows at level `low`."""
    top = F.substring("path", F.lit(ENTRY * low - ENTRY + 1), F.lit(DIGEST)) if low else F.lit(b"")
    rows = rows.withColumn("top", top)
    sizes = rows.groupBy("top").agg(F.sum(F.length("path") - ENTRY * (low - 1)).alias("bytes"))
    large = table(sizes.where(F.col("bytes") > GROUP_BYTES).select("top"), "large")
    whole, part = large.isEmpty(), low == 0
    kept = []
    if whole or not part:
        small = rows if whole else rows.join(large, "top", "left_anti")
        peeled = table(_in_tasks(small, low), "peeled")
        found.append(peeled.where("depth is not null").drop("path"))
        kept.append(peeled.where("depth is null").select("path", "n", "conv", "kids", "leaves", "saved"))
    if not whole:
        hot = (rows if part else rows.join(large, "top", "left_semi")).drop("top")
        if high - low == 1:
            level = table(_merged(hot), "level")
            found.append(_emitted(level))
            kept.append(_stripped(level))
        else:
            middle = low + max(1, (high - low) // 4)
            below = _peel(hot.where(_depth() > middle), middle, high, found)
            kept.append(_peel(below.unionByName(hot.where(_depth() <= middle)), low, middle, found))
    return reduce(DataFrame.unionByName, kept)


def _merged(rows: DataFrame) -> DataFrame:
    """The nodes of one level: equal paths of ended conversations and of what is left of deeper nodes."""
    sums = rows.groupBy("path").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("kids", "leaves", "saved")])
    words = F.when(F.length("path") > 0, F.conv(F.hex(F.substring("path", F.length("path") - 3, F.lit(4))), 16, 10).cast("long")).otherwise(F.lit(0))
    return sums.withColumn("leaves", F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long")).withColumn("saved", F.col("saved") + (F.col("n") - 1) * words)


def _emitted(level: DataFrame) -> DataFrame:
    parent = F.when(F.length("path") > 0, _key(1))
    return level.select(_depth().alias("depth"), _key().alias("key"), parent.alias("parent"), "n", "conv", "kids", "leaves", "saved")


def _stripped(level: DataFrame) -> DataFrame:
    shorter = F.substring("path", F.lit(1), F.length("path") - ENTRY)
    return level.select(shorter.alias("path"), "n", "conv", F.lit(1).cast("long").alias("kids"), "leaves", "saved")


def _in_tasks(rows: DataFrame, low: int) -> DataFrame:
    """Peel each group of rows with one `top` down to level `low`: its nodes, and with depth null the row at that level."""
    fields = f"{NODE}, {ROW}"
    names = [f.split()[0] for f in fields.split(", ")]
    schema = pa.schema([(n, pa.int32() if n == "depth" else pa.binary() if n in ("key", "parent", "path") else pa.int64()) for n in names])

    def work(batches):
        group, now, out = [], None, []
        for batch in batches:
            for top, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                if top != now and group:
                    out += _peeled(group, low)
                    group = []
                    if len(out) >= BATCH:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)
                        out = []
                now = top
                group.append(row)
        out += _peeled(group, low) if group else []
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)

    sorted_rows = rows.select("top", *[f.split()[0] for f in ROW.split(", ")]).repartition("top").sortWithinPartitions("top")
    return sorted_rows.mapInArrow(work, fields)


def _peeled(rows: list[list], low: int) -> list[tuple]:
    """Nodes (depth, key, parent, null, n, conv, kids, leaves, saved) of rows below one node of level `low`, and its own row."""
    ends = defaultdict(list)
    for path, *values in rows:
        ends[len(path) // ENTRY].append((path, values))
    out: list[tuple] = []
    alive: dict[bytes, list] = {}
    for depth in range(max(ends), low - 1, -1):
        key_at = ENTRY * (depth - 1)
        for path, values in ends.pop(depth, ()):
            _merge(alive, path[key_at : key_at + DIGEST] if depth else b"", path, values)
        if depth == low:
            break
        shorter: dict[bytes, list] = {}
        for key, (path, n, conv, kids, leaves, saved) in alive.items():
            leaves = leaves if kids else 1
            saved += (n - 1) * int.from_bytes(path[key_at + DIGEST : key_at + ENTRY], "big")
            parent = path[key_at - ENTRY : key_at - ENTRY + DIGEST] if depth > 1 else b""
            out.append((depth, key, parent, None, n, conv, kids, leaves, saved))
            _merge(shorter, parent, path, [n, conv, 1, leaves, saved])
        alive = shorter
    out += [(None, None, None, path[: ENTRY * low], *values) for path, *values in alive.values()]
    return out


def _merge(alive: dict[bytes, list], key: bytes, path: bytes, values: list) -> None:
    """Paths keep their whole length; their level says how much of them counts."""
    known = alive.get(key)
    if known is None:
        alive[key] = [path, *values]
        return
    n, conv, *sums = values
    known[1] += n
    known[2] = min(known[2], conv)
    for i, x in enumerate(sums, 3):
        known[i] += x


def _ends(ends: DataFrame) -> DataFrame:
    """key and the SHA-256 of its conversations' ids, ascending, comma-joined; the ids pass by and are never held together."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])

    def work(batches):
        now, digest, out = None, None, []
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == now:
                    digest.update(b",%d" % conv)
                    continue
                if digest:
                    out.append({"key": now, "ends_sha256": digest.hexdigest()})
                now, digest = key, hashlib.sha256(b"%d" % conv)
            if len(out) >= BATCH:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if digest:
            out.append({"key": now, "ends_sha256": digest.hexdigest()})
        yield pa.RecordBatch.from_pylist(out, schema)

    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(work, "key binary, ends_sha256 string")
