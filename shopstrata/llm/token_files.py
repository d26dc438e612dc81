"""Token ids in seekable files: independent zstandard frames with a trailing seek table and checksums.

A file holds the ids of consecutive documents as little-endian 32-bit numbers. Its parts, in order:

* data frames, each a zstandard frame with a content checksum of at most FRAME_IDS ids, ended at a
  document's end from FRAME_END ids on; long documents span several;
* a skippable frame (0x184D2A50) with the documents' index: a zstandard frame of all doc_ids, then all lengths, as 64-bit
  numbers (a null doc_id is the smallest number);
* a skippable frame (0x184D2A5E), the seek table: for each data frame its compressed size, its size and the low half of
  the XXH64 of its content; then the number of frames, a descriptor byte (0x80: checksums are there) and 0x8F92EAB1.

Any zstandard program can decompress the whole file; `Reader` decompresses only the frames of the documents asked for.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from .batches import parts
from .shared import folder, small_batches, table
from .tokens import encoder

FRAME_IDS = 1 << 17
#: A frame ends with the document that brings it to so many ids, so that reading one costs few ids of others.
FRAME_END = 1 << 14
INDEX, TABLE, FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
LEVEL = 1
NO_ID = -(1 << 63)


def _at(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Writer:
    """One file. It appears under its name when it is whole, so a task that is run again replaces it."""

    def __init__(self, path: str):
        self.files, self.path = _at(path)
        self.files.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.draft = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.files.open_output_stream(self.draft)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.open_, self.held, self.frames = [], 0, []
        self.doc_ids, self.sizes = [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.sizes.append(len(ids))
        ids = ids.astype("<u4")
        while len(ids):
            part, ids = ids[: FRAME_IDS - self.held], ids[FRAME_IDS - self.held :]
            self.open_.append(part.tobytes())
            self.held += len(part)
            if self.held == FRAME_IDS:
                self._frame()
        if self.held >= FRAME_END:
            self._frame()

    def _frame(self) -> None:
        data = b"".join(self.open_)
        packed = self.zstd.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.open_, self.held = [], 0

    def close(self) -> None:
        if self.held:
            self._frame()
        index = self.zstd.compress(np.array([*self.doc_ids, *self.sizes], "<i8").tobytes())
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        entries = b"".join(struct.pack("<III", *x) for x in self.frames)
        self.out.write(struct.pack("<II", TABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.frames), 0x80, FOOTER))
        self.out.close()
        self.files.move(self.draft, self.path)


class Reader:
    def __init__(self, path: str):
        files, at = _at(path)
        self.file = files.open_input_file(at)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != FOOTER or flags != 0x80:
            raise ValueError(f"{path}: no seek table")
        top = size - 9 - 12 * n - 8
        entries = np.frombuffer(self._read(top + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = entries.T
        self.offsets = np.cumsum(self.packed) - self.packed
        self.first = np.concatenate([[0], np.cumsum(self.sizes // 4)])
        begin = int(self.packed.sum())
        magic, length = struct.unpack("<II", self._read(begin, 8))
        if magic != INDEX or begin + 8 + length != top:
            raise ValueError(f"{path}: broken index")
        numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(self._read(begin + 8, length)), "<i8")
        self.doc_ids, self.lengths = numbers[: len(numbers) // 2], numbers[len(numbers) // 2 :]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self._read(int(self.offsets[k]), int(self.packed[k])), int(self.sizes[k]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k}: wrong checksum")
            self._last = (k, np.frombuffer(data, "<u4"))
        return self._last[1]

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the file."""
        a, b = int(self.starts[i]), int(self.starts[i] + self.lengths[i])
        if a == b:
            return np.zeros(0, "<u4")
        k, out = int(np.searchsorted(self.first, a, "right")) - 1, []
        while a < b:
            to = min(b, int(self.first[k + 1]))
            out.append(self.frame(k)[a - self.first[k] : to - self.first[k]])
            a, k = to, k + 1
        return np.concatenate(out)


def write(
    docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", end_id: int = 1, out: str | None = None
) -> DataFrame:
    """Encode every row of `docs`, append `end_id`, and write the ids in ascending order of `id_column`.

    Returns one row for each file: shard (files follow each other in this order), path, n_docs, n_ids. Null and empty
    texts are the end id alone. Null ids come first, and rows of the same id are ordered by their ids' bytes. A file holds
    a range of ids, as many files as `docs` has partitions. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = out or folder(spark, "token-files")
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shards = max(1, source.rdd.getNumPartitions())
    # The bounds come from the id column alone, so that no text is encoded for them.
    share = [i / shards for i in range(1, shards)]
    found = source.agg(F.percentile_approx("doc_id", share, 100 * shards).alias("b")).first()["b"] if share else None
    bounds = np.unique(np.array(found or [], np.int64))

    def encode(batches):
        ids_of = encoder(path).ids
        for batch in batches:
            for part in parts(batch, "text"):
                flat, first = ids_of(part.column("text"))
                flat = flat.astype("<u4") if flat.dtype != np.uint16 else flat
                end = np.array([end_id], flat.dtype)
                doc_id = part.column("doc_id")
                known = doc_id.fill_null(NO_ID).to_numpy(zero_copy_only=False)
                shard = np.searchsorted(bounds, known, "right").astype(np.int32)
                rows = [np.append(flat[a:b], end).tobytes() for a, b in zip(first, first[1:])]
                wide = pa.array(np.full(part.num_rows, flat.dtype.itemsize, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(shard), doc_id, wide, pa.array(rows, pa.binary())], names=["shard", "doc_id", "width", "ids"])

    def save(batches):
        writer, shard, n = None, None, 0

        def closed():
            writer.close()
            name = f"{out}/part-{shard:08d}.zst"
            columns = [pa.array([shard], pa.int32()), pa.array([name]), pa.array([len(writer.sizes)], pa.int64()), pa.array([sum(writer.sizes)], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "path", "n_docs", "n_ids"])

        for batch in batches:
            for to, doc_id, width, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "width", "ids"))):
                if to != shard:
                    if writer:
                        yield closed()
                    writer, shard = Writer(f"{out}/part-{to:08d}.zst"), to
                writer.add(doc_id, np.frombuffer(ids, "<u2" if width == 2 else "<u4"))
        if writer:
            yield closed()

    encoded = source.mapInArrow(encode, "shard int, doc_id long, width int, ids binary")
    # Each shard is a partition of its own; hashes of their numbers would put several into one.
    sorted_ = encoded.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "ids")
    return table(sorted_.mapInArrow(save, "shard int, path string, n_docs long, n_ids long"), "token-manifest")


def read(files: DataFrame) -> DataFrame:
    """Per document, from the files of `write`: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file, so the running sum is over a short list.
    placed = files.select("shard", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))

    def work(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                reader = Reader(path)
                crc = [zlib.crc32(reader.ids(i).tobytes()) for i in range(len(reader.doc_ids))]
                doc_id = pa.array(reader.doc_ids, mask=reader.doc_ids == NO_ID)
                yield pa.RecordBatch.from_arrays([doc_id, pa.array(reader.starts + start), pa.array(reader.lengths.astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = placed.repartitionById(max(1, files.rdd.getNumPartitions()), F.col("shard"))
    return spread.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ids (doc_id, ids array<int>) of the documents `wanted` (doc_id); of the files only their frames are read.

    The files' indexes are joined with the request, so neither has to fit anywhere.
    """

    def indexes(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                reader = Reader(path)
                n = len(reader.doc_ids)
                yield pa.RecordBatch.from_arrays([pa.array([path] * n, pa.string()), pa.array(np.arange(n)), pa.array(reader.doc_ids, mask=reader.doc_ids == NO_ID)], names=["path", "number", "doc_id"])

    def fetch(batches):
        reader, at = None, None
        for batch in batches:
            for path, number, doc_id in zip(*(batch.column(c).to_pylist() for c in ("path", "number", "doc_id"))):
                if path != at:
                    reader, at = Reader(path), path
                ids = pa.array([reader.ids(number).astype(np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), ids], names=["doc_id", "ids"])

    rows = files.select("path").mapInArrow(indexes, "path string, number long, doc_id long")
    chosen = rows.join(wanted.select(F.col("doc_id").cast("long")).distinct(), "doc_id")
    spread = chosen.select("path", "number", "doc_id").repartition("path").sortWithinPartitions("path", "number")
    return spread.mapInArrow(fetch, "doc_id long, ids array<int>")
