"""Token operators against the library, whole plans against brute force, files against an exact round trip."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopstrata.llm import minhash, packing, token_counts, token_files, tokens, words

WORDS, BYTES = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = [
    "", None, " ", "a", "It's we'll I'M don't 've  ''s", " a\n\nb  c ", "a" * 3000, "ab" * 500, "x<|endoftext|>y <|startoftext|>z",
    "ΣΑΣ İstanbul ſ K", "日本語 テキスト 💡💡", "é", "\0 \x1c x\u0085y z", "1234 5½²", "aaaa aaaaa 'tis",
]
SCHEMA = "doc_id long, text string, n_tokens string, rank int"


def made(seed, count=1500):
    rnd, letters = random.Random(seed), "aAbsStTmMdDrReEvVlL''' \n\t  .,!019éÉßΣσİıñ日本 éあ💡"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_are_the_library_s(path):
    texts = [t or "" for t in ODD] + made(1)
    flat, first = tokens.Encoder(path).ids(pa.array(texts))
    library = Tokenizer.from_file(path)
    for i, t in enumerate(texts):
        assert flat[first[i] : first[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_long_texts_are_cut_where_pre_tokens_end(monkeypatch):
    monkeypatch.setattr(tokens, "LONG", 50)
    texts = ["the cat's  on a mat,  we'll see 12 34 a b c d e f\n\n g h " * 20]
    for path in (WORDS, BYTES):
        flat, _ = tokens.Encoder(path).ids(pa.array(texts))
        assert flat.tolist() == Tokenizer.from_file(path).encode(texts[0], add_special_tokens=False).ids


def test_counts(spark):
    texts = ODD + made(2) + ["same"] * 3
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], SCHEMA)
    rows = {r.doc_id: r for r in token_counts.token_counts(docs, WORDS, limit=100).collect()}
    library = Tokenizer.from_file(WORDS)
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (rows[i].n_tokens, rows[i].n_bytes, rows[i].over_limit, rows[i]["rank"]) == (n, len((t or "").encode()), n > 100, 7), t
    assert token_counts.token_counts(docs.limit(0), WORDS).count() == 0


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 100)
    texts = ODD + made(3, 200)
    docs = spark.createDataFrame([((i * 37) % 1009 if i else None, t, "x", 7) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    files = token_files.write(docs, WORDS, end_id=1)
    library, ids = Tokenizer.from_file(WORDS), {}
    for i, t in enumerate(texts):
        ids[(i * 37) % 1009 if i else None] = [*library.encode(t or "", add_special_tokens=False).ids, 1]
    found = {r.doc_id: r for r in token_files.read(files).collect()}
    start = 0
    for doc_id in sorted(ids, key=lambda x: -1 if x is None else x):
        r = found.pop(doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids[doc_id]), zlib.crc32(np.array(ids[doc_id], "<u4").tobytes()))
        start += r.n_tokens
    assert not found
    wanted = spark.createDataFrame([(37,), (74,), (5000,)], "doc_id long")
    assert {r.doc_id: r.ids for r in token_files.read_documents(files, wanted).collect()} == {37: ids[37], 74: ids[74]}
    assert token_files.read(token_files.write(docs.limit(0), WORDS)).count() == 0


def test_files_are_zstandard_and_hold_checksums(tmp_path):
    path = f"{tmp_path}/x.zst"
    writer = token_files.Writer(path)
    rows = [np.arange(n, dtype="<u4") for n in (3, 0, 300_000, 5)]
    for i, ids in enumerate(rows):
        writer.add(i, ids)
    writer.close()
    data = open(path, "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert plain == b"".join(x.tobytes() for x in rows)
    reader = token_files.Reader(path)
    assert [reader.ids(i).tolist() for i in range(4)] == [x.tolist() for x in rows]
    at = int(reader.offsets[1]) + 40
    with open(path, "r+b") as file:
        file.seek(at)
        file.write(bytes([data[at] ^ 255]))
    with pytest.raises(Exception):
        token_files.Reader(path).ids(2)


def dealt(rows, lengths):
    """Places of the pieces of a plan, each checked against the others."""
    bins = defaultdict(list)
    for i, (length, rank, base, each, offset) in enumerate(rows):
        end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == length else lengths[length]
        for r in range(rank, end):
            bins[base + (r - rank) // each].append((offset + (r - rank) % each * length, length))
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_plans_are_gapless_and_tight(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 64, 1024])
    lengths = {n: rnd.randrange(1, 60) for n in rnd.sample(range(1, capacity + 1), min(capacity, rnd.randrange(1, 40)))}
    bins = dealt(packing.plan(lengths, capacity), lengths)
    assert sum(len(x) for x in bins.values()) == sum(lengths.values())
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    # Best fit by decreasing size, one piece at a time, as the measure.
    gaps = []
    for n in sorted((n for n, c in lengths.items() for _ in range(c)), reverse=True):
        fits = [g for g in gaps if g >= n]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - n)
    assert len(bins) <= len(gaps) * 1.03 + 1


def test_packing(spark):
    texts = ODD + made(4, 300) + ["word " * 3000, "word " * 1023, "word " * 1022] + ["same"] * 5
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(texts)], SCHEMA).repartition(6)
    rows = packing.packed(docs, BYTES, end_id=2, capacity=256).collect()
    library, whole, bins = Tokenizer.from_file(BYTES), {}, defaultdict(list)
    for i, t in enumerate(texts):
        whole[i] = [*library.encode(t or "", add_special_tokens=False).ids, 2]
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        ids = whole[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        assert r.length == 256 or r.piece == 0
        bins[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, whole.values()))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(map(len, whole.values())) // 256) * 1.05 + 1
    assert packing.packed(docs.where(F.lit(False)), BYTES).count() == 0


def thue_morse(n, a="a", b="b"):
    """A word of n letters and its complement: their sums of letters times powers of any odd base agree modulo 2^64."""
    word = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in word), "".join((b, a)[x] for x in word)


@pytest.mark.parametrize("size", [512, 1024, 4096])
def test_words_whose_sums_cancel_out(spark, size):
    one, other = thue_morse(size)
    texts = [one, other, f"a {one} b", f"a {other} b", one + one, other + one]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    counted = token_counts.token_counts(df, WORDS, keep=["doc_id"])
    for path in (WORDS, BYTES):
        library = Tokenizer.from_file(path)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        flat, first = tokens.Encoder(path).ids(pa.array(texts))
        assert [flat[a:b].tolist() for a, b in zip(first, first[1:])] == want
        if path == WORDS:
            assert [r.n_tokens for r in counted.orderBy("doc_id").collect()] == [len(x) for x in want]
    assert len(set(words.split(pa.array([one, other]), words.VISIBLE).hash.tolist())) == 2
    near = minhash.near_duplicates(df, minhash.Likeness(size=3, above=85, below=100))
    assert {r.doc_id: r.component_id for r in near.collect()} == {i: i for i in range(len(texts))}


def test_frequent_pre_tokens_stay_remembered(monkeypatch):
    """Of more pre-tokens than a worker remembers, those asked for again stay; whatever was forgotten is made again."""
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    rng, made_of = np.random.default_rng(3), []

    def make(strings):
        made_of.extend(strings)
        size = np.array([len(s) for s in strings])
        return np.concatenate([np.full(n, int(s)) for n, s in zip(size, strings)]), size

    found = tokens.Remembered(make, np.uint32)
    for step in range(60):
        asked = np.concatenate([np.arange(1, 21), rng.integers(100, 100_000, 30)]).astype(np.uint64)
        asked = np.concatenate([asked, asked[::-2]])
        rows = found.rows(words.mixed(asked), lambda i: str(asked[i]))
        for value, row in zip(asked.tolist(), rows.tolist()):
            ids = found.flat[found.at[row] : found.at[row] + found.size[row]].tolist()
            assert ids == [value] * len(str(value))
        assert len(found.keys) == len(found.row) == len(found.again) <= 100 + 50
    assert all(made_of.count(str(n)) == 1 for n in range(1, 21))
    # More that are asked for again than may stay: it starts anew.
    for step in range(10):
        many = np.arange(200, dtype=np.uint64) + np.uint64(1)
        rows = found.rows(words.mixed(many), lambda i: str(many[i]))
        assert found.flat[found.at[rows]].tolist() == many.tolist()
